"""Every catalog query against its DuckDB oracle on the sf0.001 driver tables."""

import math

import duckdb
import pytest

from conftest import SF001
from pyspark.sql import functions as F

from stockledger import schema as S
from stockledger.plans import catalog
from stockledger.plans.catalog import BAND, queries
from stockledger.plans.oracle import HOLED, oracle_queries
from stockledger.sources.adapter import adapt_sales, driver_tables
from stockledger.sources.tables import RetailTables
from stockledger.plans.oracle_sql import oracle_sql

SQL = oracle_sql()
QUERIES = queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("part", "lineitem", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_but_the_footprint():
    assert set(QUERIES) - set(SQL) == {"output_footprint"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols = sorted(df.columns)
    got = _rows(df.select(*cols).collect())
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == cols
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = _rows(con.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall())
    assert got == want


HOLED_SQL = oracle_queries(band=BAND, holes=HOLED)


def holed(t):
    """Unknown products, sales of returned lines only, and a store without sales in 1999."""
    returned = F.col("l_returnflag") == "R"
    gone = (F.col("StoreId") == 7) & (F.year("Date") == 1999)
    lines = t.spark.read.parquet(f"{SF001}/lineitem.parquet").filter(returned)
    sales = adapt_sales(lines, t.spark.read.parquet(f"{SF001}/orders.parquet")).filter(~gone)
    return RetailTables(t.products.filter("ProductId % 97 <> 0"), S.conform(sales, S.SALES), t.movements)


@pytest.mark.parametrize("name", ["attach_root", "interval_stock", "store_universe", "store_benefits", "family_benefits", "store_rotation",
                                  "family_rotation", "store_units_sold", "family_units_sold", "store_benefits_v2", "check_contract", "contract_violations"])
def test_holed_tables_match_the_oracle(spark, con, name, monkeypatch):
    monkeypatch.setattr(catalog, "driver_tables", lambda s, d: holed(driver_tables(s, d)))
    df = QUERIES[name](spark, SF001)
    cols = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    assert _rows(df.select(*cols).collect()) == _rows(con.sql(f"SELECT {quoted} FROM ({HOLED_SQL[name]})").fetchall())


def test_damaged_tables_are_found(spark):
    for name in QUERIES:
        if name.endswith("_damaged"):
            assert QUERIES[name](spark, SF001).first().n_violations > 0, name


def test_fixture_counts(spark):
    """Counts measured for FIXTURES.md §4 at sf0.001."""
    iv = QUERIES["interval_stock"](spark, SF001)
    assert iv.count() == 954
    daily = QUERIES["daily_stock"](spark, SF001)
    assert daily.count() == 38817
    assert daily.groupBy().sum("Stock").first()[0] == 9678869
    assert QUERIES["opening_collapse"](spark, SF001).count() == 1828


def test_checks_find_nothing_on_clean_data(spark):
    for name in ("check_positive", "check_interval_balance", "check_daily_expansion",
                 "check_store_benefit", "check_family_benefit", "check_store_rotation",
                 "check_family_rotation"):
        row = QUERIES[name](spark, SF001).first()
        assert row.n_violations == 0 and row.n_checked > 0, name
