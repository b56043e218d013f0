"""Output sets that change together: staged run folders and the manifests that readers resolve.

A versioned run writes its tables to ``<out_dir>/runs/<run>/`` and, when all
of them are there, adds ``<out_dir>/manifests/<number>.json``: written under
another name and renamed, so it appears whole or not at all. Readers take the
manifest with the highest number. A run that dies between two writes leaves a
folder that no manifest names, and everyone keeps reading the set before it;
two runs that finish together cannot both take a number.

A manifest lists each table's row count and fingerprint, observed while the
table was written, so that what is read back can be compared with what was
computed (:func:`verify_outputs`). Folders without manifests are flat:
``<out_dir>/<name>.parquet``.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fingerprint import fingerprint
from .sinks import hadoop_fs, output_path

MANIFESTS, RUNS = "manifests", "runs"


def _under(out_dir: str, *parts: str) -> str:
    return "/".join([out_dir.rstrip("/"), *parts])


def manifest_numbers(spark: SparkSession, out_dir: str) -> list[int]:
    """Numbers of the published sets, ascending; a flat or new folder has none."""
    fs, folder = hadoop_fs(spark, _under(out_dir, MANIFESTS))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[: -len(".json")].isdigit())


def read_manifest(spark: SparkSession, out_dir: str, number: int | None = None) -> dict | None:
    """The manifest of that number, by default the current one; None where nothing was published as a set."""
    numbers = manifest_numbers(spark, out_dir)
    if not numbers:
        return None
    fs, at = hadoop_fs(spark, _under(out_dir, MANIFESTS, f"{number or numbers[-1]:08d}.json"))
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def new_run(out_dir: str) -> tuple[str, str]:
    """(name, folder) of a run that is yet to be published."""
    run = uuid.uuid4().hex[:12]
    return run, _under(out_dir, RUNS, run)


def publish_set(spark: SparkSession, out_dir: str, run: str, tables: dict[str, dict]) -> int:
    """Makes the run's tables the current set; ``tables`` has rows and fingerprint by name. Returns its number."""
    number = (manifest_numbers(spark, out_dir) or [0])[-1] + 1
    fs, final = hadoop_fs(spark, _under(out_dir, MANIFESTS, f"{number:08d}.json"))
    _, draft = hadoop_fs(spark, _under(out_dir, MANIFESTS, f"draft-{run}"))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"run": run, "tables": tables}, sort_keys=True).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another run published set {number} of {out_dir} meanwhile; run {run} is not published")
    return number


def discard_run(spark: SparkSession, out_dir: str, run: str) -> None:
    fs, folder = hadoop_fs(spark, _under(out_dir, RUNS, run))
    fs.delete(folder, True)


def prune_runs(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Deletes published sets but the last ``keep``, manifests first; returns the runs deleted."""
    if keep < 1:
        raise ValueError("the current set must stay")
    gone = []
    for number in manifest_numbers(spark, out_dir)[:-keep]:
        run = read_manifest(spark, out_dir, number)["run"]
        fs, at = hadoop_fs(spark, _under(out_dir, MANIFESTS, f"{number:08d}.json"))
        fs.delete(at, False)
        discard_run(spark, out_dir, run)
        gone.append(run)
    return gone


def current_folder(spark: SparkSession, out_dir: str) -> str:
    """The folder that holds ``<name>.parquet`` of the current set; the folder itself if it is flat."""
    manifest = read_manifest(spark, out_dir)
    return out_dir if manifest is None else _under(out_dir, RUNS, manifest["run"])


def verify_outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    """Per table of the current set: rows and fingerprint as read back, and whether they equal those observed when it was written."""
    manifest = read_manifest(spark, out_dir)
    if manifest is None:
        raise ValueError(f"{out_dir} holds no published set")
    folder = _under(out_dir, RUNS, manifest["run"])
    rows = []
    for name, noted in sorted(manifest["tables"].items()):
        found = fingerprint(spark.read.parquet(output_path(folder, name)).select(*noted["columns"]))
        same = (F.col("rows") == noted["rows"]) & (F.col("fingerprint") == noted["fingerprint"])
        rows.append(found.select(F.lit(name).alias("output"), "rows", "fingerprint", same.alias("as_written")))
    return reduce(DataFrame.unionByName, rows)
