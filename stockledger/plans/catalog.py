"""Catalog of named queries over a folder of driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
whole ``part``, ``lineitem`` and ``orders`` tables of that folder. The same
names key the DuckDB oracles in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ADAPTER_PERIOD, Period, scratch_path
from ..functions.fingerprint import fingerprint
from ..operators import kpi, ledger, unpriced, validate
from ..operators.kpi import FAMILY, STORE
from ..schema import OUTPUTS
from ..sources.adapter import driver_tables
from ..sources.readers import read_outputs
from ..sources.sinks import register_views
from ..sources.tables import RetailTables
from .job import run_job, written

# Stock band of the interval sample (L3). The original used 8000-10000 on
# its own data; on the driver tables 300-400 lies in the upper quartile of
# interval stocks and holds about an eighth of the intervals.
BAND = (300, 400)


class Plan:
    """Lazily built frames of one run over one folder, shared by the queries."""

    def __init__(self, spark: SparkSession, sf_dir: str, period: Period = ADAPTER_PERIOD):
        self.period = period
        self.t: RetailTables = driver_tables(spark, sf_dir)
        self.fits = self.t.products_fit_broadcast()

    # inputs
    @property
    def products(self) -> DataFrame:
        return self.t.products

    @property
    def sales(self) -> DataFrame:
        return self.t.sales

    @property
    def movements(self) -> DataFrame:
        return self.t.movements

    def kept(self) -> Plan:
        """The same tables with the sales written once, for queries that read them several times: each reading joins lines and orders anew."""
        store = written(self.t.spark, scratch_path(self.t.spark, "retail"))
        self.t = replace(self.t, sales=store(self.t.sales, "sales"))
        return self

    # ledger
    def rooted(self) -> DataFrame:
        return ledger.attach_root(self.movements, self.products, master_fits=self.fits)

    def ledger(self) -> DataFrame:
        return ledger.stock_ledger(self.movements, self.products, self.period, master_fits=self.fits)

    def intervals(self) -> DataFrame:
        return ledger.interval_stock(self.ledger(), self.period)

    def daily(self) -> DataFrame:
        return ledger.daily_stock(self.intervals())

    # KPIs
    def measures(self) -> kpi.Measures:
        return kpi.Measures.build(
            self.sales, self.movements, self.products, self.period, master_fits=self.fits
        )

    def benefit(self, level: str) -> DataFrame:
        return kpi.benefit(self.measures(), level)

    def rotation(self, level: str) -> DataFrame:
        return kpi.rotation(self.measures(), self.intervals(), self.products, level, master_fits=self.fits)

    def unpriced_cost(self, level: str) -> DataFrame:
        return unpriced.unpriced_cost(self.measures(), level)

    def adjusted(self, level: str) -> DataFrame:
        return unpriced.adjusted_benefit(self.measures(), level)

    # published tables with the damage that the oracle knows of
    def emptied(self) -> DataFrame:
        return self.intervals().withColumn("Stock", F.when(F.col(STORE) % 5 == 0, F.lit(0).cast("long")).otherwise(F.col("Stock")))

    def shifted(self) -> DataFrame:
        return self.intervals().withColumn("Stock", F.col("Stock") + F.when(F.col(STORE) % 5 == 0, 1).otherwise(0))

    def damaged_days(self, daily: DataFrame) -> DataFrame:
        """Day 15 of stores divisible by 5 is lost, day 20 of the stores after them doubled, day 25 of the next has one unit more."""
        store, day = F.col(STORE) % 5, F.day("Date")
        copies = F.when((store == 1) & (day == 20), 2).when((store == 0) & (day == 15), 0).otherwise(1)
        more = F.when((store == 2) & (day == 25), 1).otherwise(0)
        return daily.withColumn("Stock", F.col("Stock") + more).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")

    def damaged(self, published: DataFrame, level: str) -> DataFrame:
        """One more in even years of every fifth store, or of families whose names have a length divisible by 5."""
        measure = published.columns[-1]
        hit = (F.col(STORE) if level == STORE else F.length(FAMILY)) % 5 == 0
        return published.withColumn(measure, F.col(measure) + F.when(hit & (F.col("Anio") % 2 == 0), 1).otherwise(0))

    def judged(self, judge, figure: str, level: str, damage: bool) -> DataFrame:
        self.kept()
        published = self.benefit(level) if figure == "benefit" else self.rotation(level)
        published = self.damaged(published, level) if damage else published
        if figure == "benefit":
            return judge(published, self.benefit_facts(), level)
        days = validate.daily_stock_days(self.daily(), self.period)
        return judge(published, self.sales, self.products, days, level, self.period, master_fits=self.fits)

    def days_judged(self, judge, damage: bool) -> DataFrame:
        """``judge`` of the intervals, written once, and their days, in tasks sized for the days."""
        intervals = written(self.t.spark, scratch_path(self.t.spark, "intervals"))(self.intervals(), "interval_stock")
        tasks = ledger.daily_partitions(intervals, ledger.DAILY_BYTES_PER_TASK // 4)  # the masks are wider than days
        daily = ledger.daily_stock(intervals, tasks)
        return judge(intervals, self.damaged_days(daily) if damage else daily, tasks)

    def kpi_facts(self) -> DataFrame:
        return validate.kpi_facts(self.sales, self.movements, self.products, self.period, master_fits=self.fits)

    def benefit_facts(self) -> DataFrame:
        return validate.benefit_facts(
            self.sales, self.movements, self.products, self.period, master_fits=self.fits
        )


def footprint(p: Plan) -> DataFrame:
    """Run the whole job into a fresh folder of the shared checkpoint dir; report its size (IO7)."""
    spark = p.products.sparkSession
    res = run_job(p.kept().t, scratch_path(spark, "job-output"), p.period)
    return res.footprint(spark)


def published_roundtrip(p: Plan) -> DataFrame:
    """Every table of a published set as SQL reads it: rows, fingerprint, and whether the size report lists it (IO4-IO7).

    The whole job publishes a set, which is read back through its manifest and
    registered as views.
    """
    spark = p.products.sparkSession
    out = scratch_path(spark, "published")
    res = run_job(p.kept().t, out, p.period, versioned=True)
    register_views(read_outputs(spark, out))
    sizes = res.footprint(spark).where("output IS NOT NULL").select("output", (F.col("bytes") > 0).alias("listed"))
    seen = [fingerprint(spark.sql(f"SELECT * FROM {name}")).select(F.lit(name).alias("output"), "*") for name in OUTPUTS]
    return reduce(DataFrame.unionByName, seen).join(F.broadcast(sizes), "output", "left").select(
        "output", "rows", "fingerprint", F.coalesce("listed", F.lit(False)).alias("listed")
    )


def from_files(p: Plan) -> RetailTables:
    """The retail tables written as files, with columns the readers must leave out and dates as timestamps, and read by the readers (IO1-IO3)."""
    spark = p.products.sparkSession
    folder = scratch_path(spark, "retail-files")
    dated = lambda df: df.select(F.lit("x").alias("Note"), "Quantity", F.col("Date").cast("timestamp").alias("Date"), "ProductId", STORE)
    frames = {"products": p.t.raw_products.withColumn("Note", F.lit("x")), "sales": dated(p.sales), "movements": dated(p.movements)}
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{folder}/{name}.parquet"
        df.write.parquet(paths[name])
    return RetailTables.from_parquet(spark, paths["products"], paths["sales"], paths["movements"])


def inputs_roundtrip(p: Plan) -> DataFrame:
    """Rows and fingerprint of each retail table as its reader gives it (IO1-IO3)."""
    t = from_files(p)
    tables = {"products": t.products, "sales": t.sales, "movements": t.movements}
    return reduce(DataFrame.unionByName, [fingerprint(df).select(F.lit(name).alias("input"), "*") for name, df in tables.items()])


def files_rotation(p: Plan) -> DataFrame:
    """Store rotation of tables that the readers read from files."""
    t = from_files(p)
    fits = t.products_fit_broadcast()
    measures = kpi.Measures.build(t.sales, t.movements, t.products, p.period, master_fits=fits)
    intervals = ledger.interval_stock(ledger.stock_ledger(t.movements, t.products, p.period, master_fits=fits), p.period)
    return kpi.rotation(measures, intervals, t.products, STORE, master_fits=fits)


def _money(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else c for c in df.columns])


def _q(build: Callable[[Plan], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Plan(spark, sf_dir))

    run.__doc__ = build.__doc__
    return run


def _kpi_checks() -> dict[str, Callable[[Plan], DataFrame]]:
    """V4-V7: the check, the check over damaged figures, and the rows it finds there."""
    out: dict[str, Callable[[Plan], DataFrame]] = {}
    kinds = {"benefit": (validate.check_benefit, validate.benefit_violations), "rotation": (validate.check_rotation, validate.rotation_violations)}
    for figure, (check, rows) in kinds.items():
        for name, level in (("store", STORE), ("family", FAMILY)):
            out[f"check_{name}_{figure}"] = lambda p, a=check, f=figure, v=level: p.judged(a, f, v, False)
            out[f"check_{name}_{figure}_damaged"] = lambda p, a=check, f=figure, v=level: p.judged(a, f, v, True)
            out[f"{name}_{figure}_violations"] = lambda p, a=rows, f=figure, v=level: p.judged(a, f, v, True)
    return out


def _queries() -> dict[str, Callable[[Plan], DataFrame]]:
    y_first = lambda p: int(min(p.period.years))
    y_last = lambda p: int(max(p.period.years))
    return {
        # ledger (J1, A1, W1, B1-B3, J11, L3, A13)
        "attach_root": lambda p: p.rooted(),
        "net_movements": lambda p: ledger.net_movements(p.rooted()),
        "running_stock": lambda p: ledger.running_stock(ledger.net_movements(p.rooted())),
        "opening_collapse": lambda p: p.ledger(),
        "interval_stock": lambda p: p.intervals(),
        "daily_stock": lambda p: p.daily(),
        "stock_as_of": lambda p: ledger.stock_as_of(
            p.rooted(), p.intervals().select(*ledger.KEY, F.col("StartDate").alias("AsOf"))
        ),
        "interval_band": lambda p: ledger.interval_band(p.intervals(), *BAND),
        "latest_interval": lambda p: ledger.latest_interval(p.intervals()),
        # universes and spine
        "store_universe": lambda p: kpi.store_universe(p.sales, p.movements),
        "family_universe": lambda p: kpi.family_universe(p.products),
        "store_year_spine": lambda p: p.measures().spine(STORE),
        # measures (A3-A6)
        "store_sales_value": lambda p: _money(kpi.sales_value(p.measures(), STORE), "TotalVentas"),
        "family_sales_value": lambda p: _money(
            kpi.sales_value(p.measures(), FAMILY), "TotalVentas"
        ),
        "store_inbound_cost": lambda p: _money(
            kpi.inbound_cost(p.measures(), STORE), "TotalCostos"
        ),
        "family_inbound_cost": lambda p: _money(
            kpi.inbound_cost(p.measures(), FAMILY), "TotalCostos"
        ),
        "store_units_sold": lambda p: kpi.units_sold(p.measures(), STORE),
        "family_units_sold": lambda p: kpi.units_sold(p.measures(), FAMILY),
        "store_mean_stock": lambda p: kpi.mean_stock(p.intervals(), p.products, STORE, p.period),
        "family_mean_stock": lambda p: kpi.mean_stock(p.intervals(), p.products, FAMILY, p.period, master_fits=p.fits),
        "family_mean_stock_dedup": lambda p: kpi.mean_stock(
            p.intervals(), p.products, FAMILY, p.period, root_fanout=False, master_fits=p.fits
        ),
        # KPIs (B5-B8) and their top-3 reports (L1, L2)
        "store_benefits": lambda p: p.benefit(STORE),
        "family_benefits": lambda p: p.benefit(FAMILY),
        "store_rotation": lambda p: p.rotation(STORE),
        "family_rotation": lambda p: p.rotation(FAMILY),
        "top_store_benefits": lambda p: kpi.top_k(p.benefit(STORE), STORE, "Beneficio", y_last(p)),
        "top_family_benefits": lambda p: kpi.top_k(
            p.benefit(FAMILY), FAMILY, "Beneficio", y_first(p)
        ),
        "top_store_rotation": lambda p: kpi.top_k(p.rotation(STORE), STORE, "Rotacion", y_first(p)),
        "top_family_rotation": lambda p: kpi.top_k(
            p.rotation(FAMILY), FAMILY, "Rotacion", y_last(p)
        ),
        # unpriced branch
        "unpriced_products": lambda p: _money(
            unpriced.unpriced_products(p.products), "RetailPrice", "SupplierPrice"
        ),
        "unpriced_by_family": lambda p: unpriced.unpriced_by_family(p.products),
        "unpriced_total": lambda p: unpriced.unpriced_total(p.measures()),
        "store_cost_unpriced": lambda p: p.unpriced_cost(STORE),
        "family_cost_unpriced": lambda p: p.unpriced_cost(FAMILY),
        "store_benefits_v2": lambda p: p.adjusted(STORE),
        "family_benefits_v2": lambda p: p.adjusted(FAMILY),
        "store_cost_label": lambda p: unpriced.labelled(p.unpriced_cost(STORE), STORE, "TotalCosto"),
        "store_benefit_label": lambda p: unpriced.labelled(
            p.adjusted(STORE), STORE, "TotalBeneficio"
        ),
        "family_benefit_label": lambda p: unpriced.labelled(
            p.adjusted(FAMILY), FAMILY, "TotalBeneficio"
        ),
        # validation jobs (V1-V8)
        "check_positive": lambda p: validate.check_positive(p.intervals()),
        "check_interval_balance": lambda p: validate.check_interval_balance(
            p.intervals(), p.rooted()
        ),
        "check_daily_expansion": lambda p: p.days_judged(validate.check_daily_expansion, False),
        "check_contract": lambda p: validate.check_contract(
            p.products, p.sales, p.movements, master_fits=p.fits, raw_products=p.t.raw_products
        ),
        "contract_violations": lambda p: validate.contract_violations(
            p.products, p.sales, p.movements, master_fits=p.fits, raw_products=p.t.raw_products
        ),
        # the same checks over damaged tables, and the rows they find
        "check_positive_damaged": lambda p: validate.check_positive(p.emptied()),
        "positive_violations": lambda p: validate.positive_violations(p.emptied()),
        "check_interval_balance_damaged": lambda p: validate.check_interval_balance(p.shifted(), p.rooted()),
        "balance_violations": lambda p: validate.balance_violations(p.shifted(), p.rooted()),
        "daily_violations": lambda p: p.days_judged(validate.daily_violations, True),
        "check_daily_expansion_damaged": lambda p: p.days_judged(validate.check_daily_expansion, True),
        **_kpi_checks(),
        "kpi_facts": lambda p: _money(p.kpi_facts(), "SalesValue", "InboundCost"),
        # sinks: whole job, then the size of what it wrote (IO5, IO7); no oracle
        "output_footprint": footprint,
        "published_roundtrip": published_roundtrip,
        "inputs_roundtrip": inputs_roundtrip,
        "files_store_rotation": files_rotation,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(build) for name, build in _queries().items()}
