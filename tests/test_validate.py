"""Validation jobs: zero violations on clean data, and seeded faults are caught."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockledger.config import ADAPTER_PERIOD as P
from stockledger.operators import kpi, ledger, validate
from stockledger.operators.kpi import FAMILY, STORE
from stockledger.sources.adapter import driver_tables

from fixtures import facts_df, products_df

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark):
    t = driver_tables(spark, SF)
    rooted = ledger.attach_root(t.movements, t.products)
    iv = ledger.interval_stock(ledger.stock_ledger(t.movements, t.products, P), P).cache()
    yield t, rooted, iv
    iv.unpersist()


def _v(df):
    r = df.first()
    return r.n_checked, r.n_violations


def _bump(df, col, cond):
    return df.withColumn(col, F.when(cond, F.col(col) + 1).otherwise(F.col(col)))


def test_interval_faults(world):
    t, rooted, iv = world
    one = (F.col("ProductRootCode") == iv.first().ProductRootCode) & (F.col("StoreId") == iv.first().StoreId) & (F.col("StartDate") == iv.first().StartDate)
    assert _v(validate.check_interval_balance(iv, rooted))[1] == 0
    assert _v(validate.check_interval_balance(_bump(iv, "Stock", one), rooted))[1] == 1
    neg = iv.withColumn("Stock", F.when(one, F.lit(-1).cast("long")).otherwise(F.col("Stock")))
    assert _v(validate.check_positive(neg))[1] == 1


def test_daily_faults(world):
    _, _, iv = world
    daily = ledger.daily_stock(iv)
    n = iv.count()
    assert _v(validate.check_daily_expansion(iv, daily)) == (n, 0)
    first = daily.orderBy("ProductRootCode", "StoreId", "Date").first()
    hit = (F.col("ProductRootCode") == first.ProductRootCode) & (F.col("StoreId") == first.StoreId) & (F.col("Date") == first.Date)
    assert _v(validate.check_daily_expansion(iv, daily.filter(~hit)))[1] == 1  # missing day
    assert _v(validate.check_daily_expansion(iv, _bump(daily, "Stock", hit)))[1] == 2  # bad stock: stray + short
    stray = daily.limit(1).withColumn("Date", F.lit(dt.date(1990, 1, 1)))
    assert _v(validate.check_daily_expansion(iv, daily.unionByName(stray)))[1] == 1
    twice = daily.filter(hit)
    assert _v(validate.check_daily_expansion(iv, daily.unionByName(twice).unionByName(twice)))[1] == 2
    assert validate.daily_violations(iv, daily.unionByName(twice)).count() == 1


@pytest.mark.parametrize("level", [STORE, FAMILY])
def test_kpi_faults(world, level):
    t, _, iv = world
    m = kpi.Measures.build(t.sales, t.movements, t.products, P)
    ben = kpi.benefit(m, level)
    facts = validate.benefit_facts(t.sales, t.movements, t.products, P)
    assert _v(validate.check_benefit(ben, facts, level))[1] == 0
    bad = ben.withColumn("Beneficio", F.when(F.col("Anio") == 1999, F.col("Beneficio") + 1).otherwise(F.col("Beneficio")))
    n_1999 = ben.filter("Anio = 1999").count()
    assert _v(validate.check_benefit(bad, facts, level))[1] == n_1999
    rot = kpi.rotation(m, iv, t.products, level)
    sd = validate.daily_stock_days(ledger.daily_stock(iv), P)
    assert _v(validate.check_rotation(rot, t.sales, t.products, sd, level, P))[1] == 0
    bad = rot.withColumn("Rotacion", F.col("Rotacion") * 1.01 + 0.01)
    n = rot.count()
    assert _v(validate.check_rotation(bad, t.sales, t.products, sd, level, P))[1] == n


def test_contract_faults(spark):
    """M3: duplicate id, null date, null store, unknown product, timestamp dates."""
    products = products_df(spark, [(1, 1, "A", 1, 1), (1, 1, "A", 2, 1), (2, None, "B", 1, 1)])
    mv = facts_df(spark, [(1, 1, "2019-01-01", 1), (1, 1, None, 2), (None, 2, "2019-01-02", 3), (1, 9, "2019-01-03", 4)])
    sales = facts_df(spark, [(1, 1, "2019-01-01", 1)])
    got = {r.check: (r.n_checked, r.n_violations) for r in validate.check_contract(products, sales, mv).collect()}
    assert got["unique_product_id"] == (3, 1)
    assert got["movements_date_not_null"] == (4, 1)
    assert got["movements_storeid_not_null"] == (4, 1)
    assert got["unknown_product_movements"] == (4, 1)
    assert got["product_root_not_null"] == (3, 1)
    assert got["sales_date_not_null"] == (1, 0)


def test_timestamp_dates_are_cast(spark):
    from stockledger import schema as S

    raw = spark.createDataFrame(
        [(1, 1, dt.datetime(2019, 1, 1, 23, 30), 5)], "StoreId long, ProductId long, Date timestamp, Quantity long"
    )
    df = S.conform(raw, S.MOVEMENTS)
    assert dict(df.dtypes)["Date"] == "date"  # S25
    assert df.first().Date == dt.date(2019, 1, 1)
