"""The driver contract in __spark_entry__.py."""

import duckdb

import __spark_entry__ as E
from conftest import SF001
from stockledger.plans import catalog
from stockledger.plans.oracle_sql import oracle_sql as _oracle_sql


def test_entry_runs_the_flagship_query(spark):
    df = E.entry(spark)
    assert df.dtypes == [("StoreId", "bigint"), ("Anio", "int"), ("Rotacion", "double")]
    assert df.count() == 22  # 11 stores (incl. store 99, which has no sales) x 2 years


def test_keys_line_up():
    assert set(E.oracle_sql()) <= set(E.queries())
    q, sql = catalog.queries(), _oracle_sql()
    assert set(sql) <= set(q) <= set(E.queries())
    assert set(q) - set(sql) == {"output_footprint"}
    assert len(q) == 67


def test_every_oracle_parses():
    con = duckdb.connect()
    for t in ("part", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name, sql in _oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")
        assert "limit" not in sql.lower() or name in {
            "interval_band", "top_store_benefits", "top_family_benefits",
            "top_store_rotation", "top_family_rotation",
        }, name
