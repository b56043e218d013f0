"""One batch run of the whole job: read, ledger, KPIs, unpriced branch, write.

Everything expensive is computed once and cut from its lineage by a
written table:

* the ledger: ``interval_stock`` is written first and read back; daily
  stock and both rotations read the written table (R7);
* the KPI pre-aggregates (:class:`~stockledger.operators.kpi.Measures`):
  one pass over sales and one over inbound movements, written to the
  shared checkpoint folder and read back; all six KPI outputs are algebra
  on those small tables.

So a run scans movements twice (ledger, inbound cube) plus once for the
store list, and sales once plus once for the store list, however many
outputs it writes. A versioned run counts the contract's null dates on the
scans of the store list, and nothing is published before the counts are
known; a run into a flat folder, which cannot take tables back, counts them
first, with one more scan of each table. A lost executor costs at most the
tasks of the stage it was running, never a recompute from the raw facts.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import RETAIL_PERIOD, Period, scratch_path
from ..functions.fingerprint import fingerprint_aggregates
from ..operators import kpi, ledger, unpriced, validate
from ..operators.kpi import FAMILY, STORE
from ..schema import OUTPUT_SCHEMAS, OUTPUTS, check_schema
from ..sources.published import current_folder, manifest_numbers, new_run, publish_set
from ..sources.readers import read_outputs
from ..sources.sinks import output_footprint, output_path, path_exists, register_views, write_output
from ..sources.tables import RetailTables


@dataclass
class JobResult:
    out_dir: str
    outputs: dict[str, str]
    #: The folder of a versioned run's tables, and the number of its set.
    run_dir: str | None = None
    number: int | None = None

    def footprint(self, spark: SparkSession) -> DataFrame:
        return output_footprint(spark, self.run_dir or self.out_dir)

    def register(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Expose every written output to SQL under its output name (IO6)."""
        frames = {name: spark.read.parquet(path).select(*OUTPUT_SCHEMAS[name].names) for name, path in self.outputs.items()}
        register_views(frames)
        return frames


def publish(df: DataFrame, out_dir: str, name: str, partition_by=None, seen: dict | None = None) -> str:
    """Write a published table after checking it against its declared schema.

    With ``seen``, the rows and the fingerprint of what is written are observed
    on the way to the files and noted there.
    """
    schema = OUTPUT_SCHEMAS[name]
    check_schema(df.drop(*(partition_by or [])), schema, name)
    if seen is None:
        return write_output(df, out_dir, name, partition_by)
    noted = Observation(f"written-{name}")
    path = write_output(df.observe(noted, *fingerprint_aggregates(schema)), out_dir, name, partition_by)
    seen[name] = {"columns": schema.names, "rows": noted.get["rows"], "fingerprint": noted.get["fingerprint"]}
    return path


def written(spark: SparkSession, run_dir: str):
    """A ``store(df, name)`` that writes ``df`` under ``run_dir`` and reads it back."""

    def store(df: DataFrame, name: str) -> DataFrame:
        return spark.read.parquet(write_output(df, run_dir, name))

    return store


def _concurrently(pool: ThreadPoolExecutor, tasks: dict[str, Callable[[], object]]) -> dict:
    """Submit independent Spark jobs from pool threads; wait for all, re-raise the first error."""
    futures = {name: pool.submit(fn) for name, fn in tasks.items()}
    return {name: f.result() for name, f in futures.items()}


def run_job(
    tables: RetailTables,
    out_dir: str,
    period: Period = RETAIL_PERIOD,
    *,
    root_fanout: bool = True,
    known_products_only: bool = False,
    daily: bool = True,
    parallel_jobs: int = 4,
    allow_violations: bool = False,
    versioned: bool = False,
) -> JobResult:
    """Compute and write every published output under ``out_dir``.

    ``versioned`` writes to a run folder of its own and publishes all tables
    at once by a manifest (:mod:`~stockledger.sources.published`); otherwise
    the tables of a flat folder are replaced one by one.

    Repeated product ids would multiply the figures and null-dated movements
    would drop out of them, so either raises before anything is written,
    unless ``allow_violations``. A folder that holds a daily table of an earlier
    run is refused with ``daily=False``: new intervals beside old days would
    not belong together.

    Intermediate tables go to a fresh folder of the session's shared
    checkpoint dir. ``daily=False`` skips the (keys x days) daily table; no
    KPI reads it. daily_stock is written partitioned by year, so readers of
    one year prune the rest.

    Writes that do not depend on each other are submitted as concurrent
    Spark jobs (``parallel_jobs`` threads): the daily table alongside the
    KPI pre-aggregates, then the six KPI outputs together. Each write is
    still one atomic, retryable job; only the submission overlaps.
    """
    if versioned:
        return _versioned_job(
            tables, out_dir, period, root_fanout=root_fanout, known_products_only=known_products_only, daily=daily,
            parallel_jobs=parallel_jobs, allow_violations=allow_violations,
        )
    spark = tables.spark
    if manifest_numbers(spark, out_dir):
        raise ValueError(f"{out_dir} holds versioned sets; a flat run would not be read")
    if not daily and path_exists(spark, output_path(out_dir, "daily_stock")):
        raise ValueError(f"{out_dir} holds daily_stock of an earlier run, which this run would not replace")
    if not allow_violations:
        _refuse(validate.gate(tables.products, tables.sales, tables.movements))
    store = written(spark, scratch_path(spark, "measures"))
    stores = kpi.store_universe(
        tables.sales, tables.movements, tables.products, known_products_only=known_products_only, master_fits=tables.products_fit_broadcast()
    )
    outs = _write_outputs(
        tables, out_dir, period, store, lambda: store(stores, "stores"), root_fanout=root_fanout, daily=daily, parallel_jobs=parallel_jobs, seen=None
    )
    return JobResult(out_dir, outs)


def _refuse(counts: dict[str, int]) -> None:
    broken = {rule: n for rule, n in counts.items() if n}
    if broken:
        raise ValueError(f"the inputs break the contract: {broken}; see validate.contract_violations")


def _versioned_job(tables: RetailTables, out_dir: str, period: Period, *, known_products_only: bool, allow_violations: bool, **how) -> JobResult:
    """The job into a run folder; its tables become the current set together, or not at all."""
    spark = tables.spark
    repeated = {"unique_product_id": tables.repeated_products()}
    store = written(spark, scratch_path(spark, "measures"))
    dates = {name: Observation(f"{name}-dates") for name in ("movements", "sales")}
    undated = F.count_if(F.col("Date").isNull()).alias("n")
    stores = store(
        kpi.store_universe(
            tables.sales.observe(dates["sales"], undated), tables.movements.observe(dates["movements"], undated), tables.products,
            known_products_only=known_products_only, master_fits=tables.products_fit_broadcast(),
        ),
        "stores",
    )
    if not allow_violations:
        _refuse(repeated | {f"{name}_date_not_null": seen.get["n"] for name, seen in dates.items()})
    run, run_dir = new_run(out_dir)
    seen: dict[str, dict] = {}
    outs = _write_outputs(tables, run_dir, period, store, lambda: stores, seen=seen, **how)
    return JobResult(out_dir, outs, run_dir, publish_set(spark, out_dir, run, seen))


def _write_outputs(
    tables: RetailTables, out_dir: str, period: Period, store, stores: Callable[[], DataFrame], *, root_fanout: bool, daily: bool, parallel_jobs: int, seen: dict | None
) -> dict[str, str]:
    """Writes every output under ``out_dir``; ``store`` keeps intermediate tables, ``stores`` gives the written store list."""
    spark, fits = tables.spark, tables.products_fit_broadcast()
    p, s, m = tables.products, tables.sales, tables.movements
    outs: dict[str, str] = {}

    # Written in (root, store, start) order within each file, so Parquet
    # min/max statistics let per-key lookups skip row groups. The window
    # already emits that order, so the planner adds no sort for it.
    led = ledger.stock_ledger(m, p, period, master_fits=fits)
    iv = ledger.interval_stock(led, period).sortWithinPartitions(*ledger.KEY, "StartDate")
    outs["interval_stock"] = publish(iv, out_dir, "interval_stock", seen=seen)
    intervals = spark.read.parquet(outs["interval_stock"])

    lazy = kpi.Measures.build(s, m, p, period, master_fits=fits)
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        pending_daily = None
        if daily:
            # A year-partitioned write sorts each task's rows by year anyway;
            # sorting by (year, key, day) in that same pass keeps every file in
            # key order (smaller, and per-key lookups skip row groups).
            # The expansion multiplies rows ~41x and the scan packs small files
            # into few tasks, so the intervals are spread for its output.
            d = (
                ledger.daily_stock(intervals, ledger.daily_partitions(intervals))
                .withColumn("Anio", F.year("Date"))
                .sortWithinPartitions("Anio", *ledger.KEY, "Date")
            )
            pending_daily = pool.submit(publish, d, out_dir, "daily_stock", ["Anio"], seen)
        parts = {name: (lambda n=name: store(getattr(lazy, n), n)) for name in ("sales", "inbound", "families")}
        stored = _concurrently(pool, parts | {"stores": stores})
        measures = kpi.Measures(period=period, **stored)

        kpis: dict[str, Callable[[], str]] = {}
        for level, prefix in ((STORE, "store"), (FAMILY, "family")):
            frames = {
                f"{prefix}_benefits": kpi.benefit(measures, level),
                f"{prefix}_rotation": kpi.rotation(
                    measures, intervals, p, level, root_fanout=root_fanout, master_fits=fits
                ),
                f"{prefix}_benefits_v2": unpriced.adjusted_benefit(measures, level),
            }
            for name, df in frames.items():
                kpis[name] = lambda df=df, name=name: publish(df, out_dir, name, seen=seen)
        outs.update(_concurrently(pool, kpis))
        if pending_daily is not None:
            outs["daily_stock"] = pending_daily.result()
    return outs


def published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """An output of the current set, or of a flat folder."""
    return spark.read.parquet(output_path(current_folder(spark, out_dir), name))


def run_checks(
    tables: RetailTables,
    out_dir: str,
    period: Period = RETAIL_PERIOD,
    *,
    root_fanout: bool = True,
    check_daily: bool = True,
) -> DataFrame:
    """Validate a published output folder against the inputs (V1-V8), every key.

    Writes two intermediate tables, then returns a lazy frame with one row per
    check: ``(check, n_checked, n_violations)``. The daily-table
    checks are skipped when the run wrote no daily table. ``check_daily=False``
    skips only V3, the one check that shuffles the whole daily table (the
    largest output); the rotation checks read it through map-side-combined
    sums either way.
    """
    spark = tables.spark
    fits = tables.products_fit_broadcast()
    p, s, m = tables.products, tables.sales, tables.movements
    names = [n for n in OUTPUTS if n != "daily_stock"]
    outs = read_outputs(spark, out_dir, names)
    iv = outs["interval_stock"]
    rooted = ledger.attach_root(m, p, master_fits=fits)
    store = written(spark, scratch_path(spark, "checks"))
    facts = store(validate.kpi_facts(s, m, p, period, master_fits=fits), "kpi_facts")
    checks = [
        validate.check_contract(p, s, m, master_fits=fits, raw_products=tables.raw_products),
        validate.check_positive(iv),
        validate.check_interval_balance(iv, rooted),
        validate.check_benefit(outs["store_benefits"], facts, STORE),
        validate.check_benefit(outs["family_benefits"], facts, FAMILY),
    ]
    if path_exists(spark, output_path(current_folder(spark, out_dir), "daily_stock")):
        daily = read_outputs(spark, out_dir, ["daily_stock"])["daily_stock"]
        sums = store(validate.daily_stock_days(daily, period), "daily_stock_days")
        if check_daily:
            checks.append(validate.check_daily_expansion(iv, daily))
        checks += [
            validate.check_rotation(outs["store_rotation"], s, p, sums, STORE, period, master_fits=fits, facts=facts),
            validate.check_rotation(
                outs["family_rotation"], s, p, sums, FAMILY, period, root_fanout=root_fanout, master_fits=fits, facts=facts
            ),
        ]
    return reduce(DataFrame.unionByName, checks)
