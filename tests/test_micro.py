"""Micro fixtures with known answers, one or more per rule S1-S26 (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from stockledger.config import RETAIL_PERIOD as P
from stockledger.operators import kpi, ledger, unpriced
from stockledger.operators.kpi import FAMILY, STORE

from fixtures import (
    M1_DAYS, M1_INTERVALS, M1_MOVEMENTS, M1_PRODUCTS,
    M2_INTERVALS, M2_MOVEMENTS, M2_PRODUCTS, M2_SALES, M2_TABLE,
    facts_df, products_df,
)


@pytest.fixture(scope="module")
def m1(spark):
    return products_df(spark, M1_PRODUCTS), facts_df(spark, M1_MOVEMENTS)


@pytest.fixture(scope="module")
def m2(spark):
    return (
        products_df(spark, M2_PRODUCTS),
        facts_df(spark, M2_SALES),
        facts_df(spark, M2_MOVEMENTS),
    )


def _intervals(products, movements):
    led = ledger.stock_ledger(movements, products, P)
    return ledger.interval_stock(led, P)


def test_m1_intervals(m1):
    products, movements = m1
    got = {tuple(r) for r in _intervals(products, movements).collect()}
    assert got == M1_INTERVALS  # S2: nothing for the null root


def test_m1_daily_counts(m1):
    products, movements = m1
    daily = ledger.daily_stock(_intervals(products, movements))
    got = {r[0]: r[1] for r in daily.groupBy("ProductRootCode").count().collect()}
    assert got == M1_DAYS


def test_m1_broadcast_and_shuffle_join_agree(m1):
    products, movements = m1
    a = ledger.interval_stock(ledger.stock_ledger(movements, products, P, master_fits=True), P)
    b = ledger.interval_stock(ledger.stock_ledger(movements, products, P, master_fits=False), P)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_m2_intervals(m2):
    products, _, movements = m2
    assert {tuple(r) for r in _intervals(products, movements).collect()} == M2_INTERVALS


def _by_key(df, level, col):
    return {(r[level], r["Anio"]): r[col] for r in df.collect()}


@pytest.mark.parametrize("level", [STORE, FAMILY])
def test_m2_kpis(m2, level):
    products, sales, movements = m2
    iv = _intervals(products, movements)
    m = kpi.Measures.build(sales, movements, products, P)
    ben = _by_key(kpi.benefit(m, level), level, "Beneficio")
    cost = _by_key(unpriced.unpriced_cost(m, level), level, "TotalCosto")
    adj = _by_key(unpriced.adjusted_benefit(m, level), level, "TotalBeneficio")
    rot = _by_key(kpi.rotation(m, iv, products, level), level, "Rotacion")
    units = _by_key(kpi.units_sold(m, level), level, "UnidadesVendidas")
    sdays = _by_key(kpi.mean_stock(iv, products, level, P), level, "StockDays")
    want = {k: v for k, v in M2_TABLE.items() if (level == STORE) == isinstance(k[0], int)}
    assert set(ben) == set(want)  # S14: full spine; S15: store 3 listed
    for k, (b, c, a, u, sd, r) in want.items():
        assert ben[k] == pytest.approx(b)
        assert cost[k] == pytest.approx(c)
        assert (adj.get(k) is None) if a is None else adj[k] == pytest.approx(a)  # S18
        if k[0] is not None:  # a null entity's spine row matches no measure (S17)
            assert units.get(k, 0) == u  # S19
            assert sdays.get(k, 0) == sd  # S20, S22
        assert rot[k] == pytest.approx(r, abs=1e-8)  # S21


def test_m2_measures_materialized_agree(m2, spark):
    from stockledger.config import scratch_path
    from stockledger.plans.job import written

    products, sales, movements = m2
    lazy = kpi.Measures.build(sales, movements, products, P)
    stored = lazy.materialize(written(spark, scratch_path(spark, "m2-measures")))
    for level in (STORE, FAMILY):
        a, b = unpriced.adjusted_benefit(lazy, level), unpriced.adjusted_benefit(stored, level)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_m2_known_products_only_drops_store_3(m2):
    products, sales, movements = m2
    sp = kpi.store_universe(sales, movements, products, known_products_only=True)
    assert {r[0] for r in sp.collect()} == {1, 2}


def test_m2_root_fanout_off(m2):
    products, _, movements = m2
    iv = _intervals(products, movements)
    ms = kpi.mean_stock(iv, products, FAMILY, P, root_fanout=False)
    got = _by_key(ms, FAMILY, "StockDays")
    assert got[("A", 2019)] == 32820 and got[("A", 2020)] == 29280


def test_calendar_days_per_year(m2):
    from stockledger.config import Period

    products, _, movements = m2
    iv = _intervals(products, movements)
    cal = Period(P.opening, P.closing, P.years, days_per_year="calendar")
    ms = _by_key(kpi.mean_stock(iv, products, STORE, cal), STORE, "StockMedio")
    assert ms[(1, 2020)] == pytest.approx(31544 / 366)
    assert ms[(1, 2019)] == pytest.approx(32820 / 365)


def test_labels_sort_as_text(spark):
    df = spark.createDataFrame([(8, 2019, 1.0), (13, 2019, 2.0)], "StoreId long, Anio int, v double")
    got = [r[0] for r in unpriced.labelled(df, STORE, "v").collect()]
    assert got == ["2019 - 13", "2019 - 8"]  # S24


def test_unpriced_listing(m2):
    products, _, _ = m2
    assert [r.ProductId for r in unpriced.unpriced_products(products).collect()] == [3]
    by_fam = {r.Family: r.Cantidad for r in unpriced.unpriced_by_family(products).collect()}
    assert by_fam == {"B": 1}


def test_top_k_orders_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, 2019, 5.0), (2, 2019, 7.0), (3, 2019, 7.0), (4, 2019, 1.0), (5, 2020, 99.0)],
        "StoreId long, Anio int, Beneficio double",
    )
    got = [(r.StoreId, r.Beneficio) for r in kpi.top_k(df, STORE, "Beneficio", 2019).collect()]
    assert got == [(2, 7.0), (3, 7.0), (1, 5.0)]


def test_stock_as_of_matches_definition(m1):
    products, movements = m1
    rooted = ledger.attach_root(movements, products)
    pts = movements.sparkSession.createDataFrame(
        [(1, 1, "2019-03-01"), (1, 1, "2018-01-01"), (4, 1, "2019-02-10"), (4, 1, "2030-01-01")],
        "ProductRootCode long, StoreId long, AsOf string",
    ).withColumn("AsOf", F.to_date("AsOf"))
    got = {(r[0], str(r[2])): r[3] for r in ledger.stock_as_of(rooted, pts).collect()}
    assert got == {
        (1, "2019-03-01"): 6,
        (1, "2018-01-01"): None,  # nothing on or before: SUM over no rows
        (4, "2019-02-10"): 0,
        (4, "2030-01-01"): 7,
    }


def test_daily_partitions_sized_for_output(m1):
    products, movements = m1
    iv = _intervals(products, movements)
    days = sum(M1_DAYS.values())
    assert ledger.daily_partitions(iv, bytes_per_task=ledger.DAILY_ROW_BYTES * 100) == -(-days // 100)
    assert ledger.daily_partitions(iv) == 1
    spread = ledger.daily_stock(iv, partitions=4)
    assert spread.rdd.getNumPartitions() == 4
    assert spread.exceptAll(ledger.daily_stock(iv)).count() == 0
