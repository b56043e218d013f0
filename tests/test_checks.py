"""V3-V8 siblings and their plans: damaged days against a plain-Python count, scans a table, no windows over days."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from fixtures import facts_df, products_df
from stockledger.config import ADAPTER_PERIOD as P
from stockledger.config import scratch_path
from stockledger.operators import ledger, validate
from stockledger.plans import catalog
from stockledger.plans.job import run_checks, run_job
from stockledger.sources.adapter import driver_tables
from stockledger.sources.tables import RetailTables

IV = "ProductRootCode long, StoreId long, StartDate date, EndDate date, Stock long"
DAY = "ProductRootCode long, StoreId long, Date date, Stock long"


def scans(df, path):
    return len(re.findall(rf"FileScan parquet.*?{path}\b", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture(scope="module")
def files(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths in plans
    yield retail_files(spark)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def retail_files(spark):
    t = driver_tables(spark, SF001)
    folder = scratch_path(spark, "retail")
    for name in ("products", "sales", "movements"):
        getattr(t, name).write.parquet(f"{folder}/{name}")
    return folder, RetailTables.from_parquet(spark, *(f"{folder}/{n}" for n in ("products", "sales", "movements")))


def intervals_and_days(rng):
    start, intervals, days = dt.date(2019, 1, 20), [], []
    for root, store in ((1, 1), (1, None), (2, 1), (3, 7)):
        at = start + dt.timedelta(rng.randrange(20))
        for _ in range(rng.randrange(1, 7)):
            end = at + dt.timedelta(rng.choice([0, 0, 1, 5, 40]))
            intervals.append((root, store, at, end, rng.randrange(1, 4)))
            days += [(root, store, at + dt.timedelta(i), intervals[-1][4]) for i in range((end - at).days + 1)]
            at = end + dt.timedelta(rng.choice([1, 1, 9]))
    return intervals, days


def damage(rng, days):
    out = []
    for root, store, day, stock in days:
        fate = rng.random()
        if fate < 0.06:
            continue
        out.append((root, store, day, stock + (1 if fate < 0.12 else 0)))
        out += [out[-1]] * (rng.randrange(1, 3) if 0.12 < fate < 0.18 else 0)
        if 0.18 < fate < 0.22:
            out.append((root, store, day + dt.timedelta(400), stock))
        if 0.22 < fate < 0.24:
            out.append((root, store, None, stock))
        if 0.24 < fate < 0.27:
            out.append((root, store, day, 99))
    return out


def brute(intervals, days):
    expected = {(r, s, a + dt.timedelta(i)): q for r, s, a, b, q in intervals for i in range((b - a).days + 1)}
    held = Counter(days)
    dated = {d[:3] for d in held}
    rows = [("missing", *k, None, q, 0) for k, q in expected.items() if k not in dated]
    for (r, s, day, q), n in held.items():
        if day is None:
            rows.append(("undated", r, s, None, q, None, n))
            continue
        if expected.get((r, s, day)) != q:
            rows.append(("wrong_stock" if (r, s, day) in expected else "stray", r, s, day, q, expected.get((r, s, day)), 0))
        if n > 1:
            rows.append(("repeated", r, s, day, q, None, n - 1))
    return sorted(map(repr, rows))


@pytest.mark.parametrize("seed", range(6))
def test_daily_violations_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    intervals, days = intervals_and_days(rng)
    iv, clean = spark.createDataFrame(intervals, IV), spark.createDataFrame(days, DAY)
    assert validate.daily_violations(iv, clean).count() == 0
    bad = damage(rng, days)
    rows = validate.daily_violations(iv, spark.createDataFrame(bad, DAY)).collect()
    assert sorted(repr(tuple(r)) for r in rows) == brute(intervals, bad)
    # the check counts the same days: rows to many or wrong, and intervals that lack a day
    counted = validate.check_daily_expansion(iv, spark.createDataFrame(bad, DAY)).first()["n_violations"]
    surplus = sum(r["Problem"] in ("wrong_stock", "stray") for r in rows) + sum(r["Extra"] for r in rows)
    held = Counter(bad)
    short = sum(any((r, s, a + dt.timedelta(i), q) not in held for i in range((b - a).days + 1)) for r, s, a, b, q in intervals)
    assert counted == surplus + short


def test_daily_violations_window_no_days(spark):
    rng = random.Random(1)
    intervals, days = intervals_and_days(rng)
    plan = validate.daily_violations(spark.createDataFrame(intervals, IV), spark.createDataFrame(days, DAY))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_contract_violations_read_each_table_once(spark, files):
    folder, t = files
    for fits in (True, False):
        df = validate.contract_violations(t.products, t.sales, t.movements, raw_products=t.raw_products, master_fits=fits)
        df.collect()  # the final plan shows the reused exchange
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert scans(df, f"{folder}/sales") >= 1
        assert len(re.findall(rf"FileScan parquet.*?{folder}/sales\b", plan)) == 1
        assert len(re.findall(rf"FileScan parquet.*?{folder}/movements\b", plan)) == 1
        assert len(re.findall(rf"FileScan parquet.*?{folder}/products\b", plan)) == 1 and "ReusedExchange" in plan


def test_contract_violations_list_every_rule(spark):
    products = products_df(spark, [(1, 1, "A", 1, 1), (1, None, "A", 2, 1), (1, 1, "A", 2, 1), (2, None, "B", 1, 1)])
    raw = products.withColumn("RetailPrice", F.lit(0.1234567890123456789).cast("decimal(30,19)"))
    mv = facts_df(spark, [(1, 1, "2019-01-01", 1), (None, 9, None, 2), (1, None, "2019-01-02", None)])
    sales = facts_df(spark, [(1, 1, None, 1), (None, None, None, None)])
    got = Counter(r["rule"] for r in validate.contract_violations(products, sales, mv, raw_products=raw).collect())
    assert got == {
        "unique_product_id": 2, "product_root_not_null": 2, "price_digits_kept": 4, "unknown_product_movements": 2,
        "movements_date_not_null": 1, "movements_storeid_not_null": 1, "movements_productid_not_null": 1, "movements_quantity_not_null": 1,
        "sales_date_not_null": 2, "sales_storeid_not_null": 1, "sales_productid_not_null": 1, "sales_quantity_not_null": 1,
    }
    checked = {r["check"]: r["n_violations"] for r in validate.check_contract(products, sales, mv, raw_products=raw).collect()}
    assert {k: n for k, n in checked.items() if n} == got


def test_run_checks_reads_sales_twice(spark, files, monkeypatch):
    from stockledger.plans import job

    folder, t = files
    out = scratch_path(spark, "twice")
    run_job(t, out, P)
    plans, whole = [], job.write_output
    monkeypatch.setattr(job, "write_output", lambda df, d, name, p=None: (plans.append(df), whole(df, d, name, p))[1])
    checks = run_checks(t, out, P)
    assert sum(scans(df, f"{folder}/sales") for df in [*plans, checks]) == 2
    rows = {r["check"]: (r["n_checked"], r["n_violations"]) for r in checks.collect()}
    assert all(rows[f"{level}_{figure}"][0] and not rows[f"{level}_{figure}"][1] for level in ("storeid", "family") for figure in ("benefit", "rotation"))


def test_units_from_facts_equal_units_from_sales(spark, files):
    _, t = files
    facts = validate.kpi_facts(t.sales, t.movements, t.products, P)
    iv = ledger.interval_stock(ledger.stock_ledger(t.movements, t.products, P), P)
    days = validate.daily_stock_days(ledger.daily_stock(iv), P)
    from stockledger.operators import kpi

    m = kpi.Measures.build(t.sales, t.movements, t.products, P)
    for level in (kpi.STORE, kpi.FAMILY):
        rot = kpi.rotation(m, iv, t.products, level).withColumn("Rotacion", F.col("Rotacion") + F.when(F.col("Anio") == 2000, 1).otherwise(0))
        a = validate.rotation_violations(rot, t.sales, t.products, days, level, P)
        b = validate.rotation_violations(rot, None, t.products, days, level, P, facts=facts)
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < a.count()


def test_daily_rows_are_reduced_before_lists_are_made(spark):
    """The aggregate that lists intervals sorts its input: it gets masks, not a row for each day."""
    intervals = spark.createDataFrame([(1, 1, dt.date(2000, 1, 1), dt.date(2000, 3, 1), 5)], IV)
    days = spark.createDataFrame([(1, 1, dt.date(2000, 1, 1), 5)], DAY)
    plan = validate.check_daily_expansion(intervals, days)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("collect_list"):]
    assert "Aggregate" in below[below.index("Union"):]


def test_daily_masks_of_sized_tasks(spark):
    """With a number of tasks, months are dealt once to that many, nothing is joined on them, and the rows are the same."""
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    intervals = [(r, s, day(0), day(40), 5) for r in (1, 2, None) for s in (1, 2)] + [(1, 1, day(41), day(50), 7)]
    days = [(r, s, day(n), q + (n == 7)) for r, s, a, b, q in intervals for n in range((a - day(0)).days, (b - day(0)).days + 1) if n % 11]
    days += [(1, 1, None, 5), (1, 1, None, 6), (9, 9, day(3), 1), days[0], days[0]]
    iv, daily = spark.createDataFrame(intervals, IV), spark.createDataFrame(days, DAY)
    listed = [sorted(map(str, validate.daily_violations(iv, daily, n).collect())) for n in (None, 1, 7)]
    assert listed[0] and listed[0] == listed[1] == listed[2]
    counts = [validate.check_daily_expansion(iv, daily, n).collect() for n in (None, 1, 7)]
    assert counts[0] == counts[1] == counts[2]
    plan = validate.daily_violations(iv, daily, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join " not in plan and "RepartitionByExpression" in plan


def test_checks_read_the_sales_join_once(spark):
    """The check reads written sales rows: lines and orders are not joined anew by each of its steps."""
    for name in ("check_store_rotation", "check_store_rotation_damaged", "store_rotation_violations"):
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan
