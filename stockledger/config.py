"""Period parameters, session construction and the shared checkpoint folder."""

from __future__ import annotations

import datetime as dt
import math
import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Period:
    """The analysed period.

    ``opening``: balances of earlier movements collapse onto this day.
    ``closing``: last day of the period; later movements are ignored and the
    last interval of every key ends here.
    ``years``: the years every KPI reports (a full spine, zero-filled).
    ``days_per_year``: divisor of the mean stock; the fixed 365 of the
    original job, or ``"calendar"`` for 365/366 by year.
    """

    opening: dt.date
    closing: dt.date
    years: tuple[int, ...] = field(default=())
    days_per_year: int | str = 365

    def __post_init__(self):
        if self.closing < self.opening:
            raise ValueError("closing must not be before opening")
        if not self.years:
            object.__setattr__(
                self, "years", tuple(range(self.opening.year, self.closing.year + 1))
            )


# Fixed values of the original job: its period and reporting years.
RETAIL_PERIOD = Period(dt.date(2019, 1, 1), dt.date(2020, 12, 31), (2019, 2020))

# Period used with the driver tables (FIXTURES.md §4): shipments span
# 1995-2001, so the opening collapse and the closing cut both have work.
ADAPTER_PERIOD = Period(dt.date(1999, 1, 1), dt.date(2000, 12, 31), (1999, 2000))


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "stockledger",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, bench and local runs; on a cluster, pass no master.

    AQE stays on so that the runtime plan coalesces small shuffle
    partitions, splits skewed join partitions and can still turn a
    sort-merge join into a broadcast one when a stage turns out small.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect client (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the session (``spark.checkpoint.dir``, or the context's
    checkpoint dir). Only when neither is set -- tests and local runs -- a
    private folder under the system temp dir is created and registered.
    """
    sc = _context(spark)
    if sc is None:  # Spark Connect: the folder must come from the session
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is needed")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset runtime conf
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="stockledger-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# Fixed default: target input bytes per shuffle partition when sizing them.
BYTES_PER_PARTITION = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths``: a distributed listing, no content read."""
    from pyspark.sql import functions as F

    total = 0
    for path in paths:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select("length")
        )
        total += files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return int(total)


def size_shuffle_partitions(
    spark: SparkSession,
    paths,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    *,
    max_partitions: int = 100_000,
    force: bool = False,
) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the input size, unless the user set it.

    About one partition per ``bytes_per_partition`` of input, never below the
    default parallelism and at most ``max_partitions``: the ledger's first
    shuffle carries the pruned, map-side-combined movements (well under the
    raw input), AQE coalesces the smaller shuffles later in the job, and
    shuffle bookkeeping grows with map tasks x partitions.
    """
    sc = _context(spark)
    user_set = sc.getConf().contains("spark.sql.shuffle.partitions") if sc is not None else True
    if not force and user_set:  # on Connect the submit-time settings are not visible: keep them
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(input_bytes(spark, paths) / bytes_per_partition)
    floor = sc.defaultParallelism if sc is not None else 1
    n = max(floor, min(max_partitions, wanted))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
