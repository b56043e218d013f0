"""Per-stage report of one query from Spark's event log (no UI, no REST).

Usage:
    python tools/stage_report.py <query-name | job> [sf_dir] [--hot]

Runs the catalog query (``noop`` write) or the whole job with event logging
into a fresh scratch folder, then prints for every stage: tasks, wall time,
shuffle read and write, and the slowest task against the median one, the
skew indicator. ``--hot`` moves a third of all movements onto one product
and store before the ledger, to show how its stages behave under skew.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from stockledger.config import ADAPTER_PERIOD, build_session  # noqa: E402
from stockledger.operators import ledger  # noqa: E402
from stockledger.plans.catalog import queries  # noqa: E402
from stockledger.plans.job import run_job  # noqa: E402
from stockledger.sources.adapter import driver_tables  # noqa: E402


def _events(log_dir: str):
    import zstandard

    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        raw = open(path, "rb")
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            yield json.loads(line)


def report(log_dir: str) -> list[dict]:
    stages: dict[int, dict] = {}
    tasks: dict[int, list[float]] = {}
    for e in _events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerTaskEnd" and e.get("Task Info"):
            info = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
        elif kind == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value", 0) for a in si.get("Accumulables", [])}
            stages[si["Stage ID"]] = {
                "stage": si["Stage ID"],
                "tasks": si["Number of Tasks"],
                "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                "shuffle_read": int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0))
                + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0)),
                "shuffle_write": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0)),
                "name": si["Stage Name"].split(" at ")[0][:40],
            }
    rows = []
    for sid, st in sorted(stages.items()):
        t = tasks.get(sid, [0])
        st["max_task_ms"] = max(t)
        st["median_task_ms"] = statistics.median(t)
        rows.append(st)
    return rows


def _hot(t):
    hot_pid = t.products.filter("ProductRootCode IS NOT NULL").orderBy("ProductId").first().ProductId
    hot = (F.abs(F.hash("ProductId", "Date", "Quantity")) % 3) == 0
    return t.movements.select(
        F.when(hot, F.lit(0).cast("long")).otherwise(F.col("StoreId")).alias("StoreId"),
        F.when(hot, F.lit(hot_pid)).otherwise(F.col("ProductId")).alias("ProductId"),
        "Date",
        "Quantity",
    ).repartition(16)  # many map tasks, as many input files would give


def main(argv):
    hot = "--hot" in argv
    args = [a for a in argv if a != "--hot"]
    name = args[0] if args else "interval_stock"
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="stockledger-stages-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    spark = build_session(
        "local[8]",
        8,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        },
    )
    if name == "job":
        run_job(driver_tables(spark, sf_dir), os.path.join(scratch, "out"), ADAPTER_PERIOD)
    elif hot:
        t = driver_tables(spark, sf_dir)
        led = ledger.stock_ledger(_hot(t), t.products, ADAPTER_PERIOD)
        ledger.interval_stock(led, ADAPTER_PERIOD).write.format("noop").mode("overwrite").save()
    else:
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    rows = report(log_dir)
    print(f"{'stage':>5} {'tasks':>5} {'ms':>6} {'max/med task ms':>16} {'shuffle rd':>11} {'shuffle wr':>11}  name")
    for r in rows:
        print(
            f"{r['stage']:>5} {r['tasks']:>5} {r['ms']:>6} "
            f"{r['max_task_ms']:>7}/{r['median_task_ms']:<8.0f} "
            f"{r['shuffle_read']:>11} {r['shuffle_write']:>11}  {r['name']}"
        )


if __name__ == "__main__":
    main(sys.argv[1:])
