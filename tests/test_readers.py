"""Readers: declared schema over loosely typed Parquet, and the job from retail files."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from stockledger.config import RETAIL_PERIOD as P, scratch_path
from stockledger.operators import kpi
from stockledger.operators.kpi import STORE
from stockledger.sources.readers import read_movements, read_products
from stockledger.sources.tables import RetailTables


@pytest.fixture(scope="module")
def retail_dir(spark):
    d = scratch_path(spark, "retail-inputs")
    spark.createDataFrame(
        [(1, 10, "A", 10.5, 4.1234567891), (2, 10, "A", None, 0.1), (3, None, "B", 7.0, None)],
        "ProductId int, ProductRootCode int, Family string, RetailPrice double, SupplierPrice double",
    ).write.parquet(os.path.join(d, "products.parquet"))
    spark.createDataFrame(
        [(1, 1, dt.datetime(2019, 3, 1, 18, 0), 2), (1, 3, dt.datetime(2020, 1, 1), 1)],
        "StoreId int, ProductId int, Date timestamp, Quantity int",
    ).write.parquet(os.path.join(d, "sales.parquet"))
    spark.createDataFrame(
        [(1, 1, dt.datetime(2018, 12, 31, 23, 59), 5), (1, 1, dt.datetime(2019, 2, 1), 3),
         (1, 2, dt.datetime(2019, 2, 1), 10), (1, 3, dt.datetime(2020, 5, 5), 4)],
        "StoreId int, ProductId int, Date timestamp, Quantity int",
    ).write.parquet(os.path.join(d, "stock_movements.parquet"))
    return d


def test_declared_types(spark, retail_dir):
    p = read_products(spark, os.path.join(retail_dir, "products.parquet"))
    m = read_movements(spark, os.path.join(retail_dir, "stock_movements.parquet"))
    assert dict(p.dtypes) == {
        "ProductId": "bigint", "ProductRootCode": "bigint", "Family": "string",
        "RetailPrice": "decimal(25,15)", "SupplierPrice": "decimal(25,15)",
    }
    assert dict(m.dtypes)["Date"] == "date" and dict(m.dtypes)["Quantity"] == "bigint"
    assert p.filter("ProductId = 1").first().SupplierPrice == Decimal("4.1234567891")


def test_missing_column_is_reported(spark):
    bad = spark.createDataFrame([(1, 2)], "ProductId long, Family long")
    from stockledger import schema as S

    with pytest.raises(ValueError, match="RetailPrice"):
        S.conform(bad, S.PRODUCTS)


def test_costs_keep_fractional_prices(spark, retail_dir):
    t = RetailTables.from_parquet(
        spark,
        *(os.path.join(retail_dir, f"{n}.parquet") for n in ("products", "sales", "stock_movements")),
    )
    m = kpi.Measures.build(t.sales, t.movements, t.products, P)
    cost = {(r.StoreId, r.Anio): r.TotalCostos for r in kpi.inbound_cost(m, STORE).collect()}
    assert cost[(1, 2019)] == Decimal("12.3703703673")  # 3 x 4.1234567891; the 2018 row is not in a year
    ben = {(r.StoreId, r.Anio): r.Beneficio for r in kpi.benefit(m, STORE).collect()}
    assert ben[(1, 2019)] == pytest.approx(2 * 10.5 - 12.370368)
    assert ben[(1, 2020)] == pytest.approx(7.0)  # product 3 priced, no supplier price: no cost


def test_command_line_on_retail_files(spark, retail_dir):
    from stockledger.__main__ import main

    out = scratch_path(spark, "retail-out")
    main([
        "--products", os.path.join(retail_dir, "products.parquet"),
        "--sales", os.path.join(retail_dir, "sales.parquet"),
        "--movements", os.path.join(retail_dir, "stock_movements.parquet"),
        "--out", out, "--validate",
    ])
    iv = {tuple(r) for r in spark.read.parquet(os.path.join(out, "interval_stock.parquet")).collect()}
    assert iv == {
        (10, 1, dt.date(2019, 1, 1), dt.date(2019, 1, 31), 5),
        (10, 1, dt.date(2019, 2, 1), dt.date(2020, 12, 31), 18),
    }


def test_shuffle_partitions_sized_from_input(spark):
    from stockledger.config import input_bytes, size_shuffle_partitions

    path = "/root/testdata/sf0.01/lineitem.parquet"
    size = os.path.getsize(path)
    assert input_bytes(spark, [path]) == size
    old = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffle_partitions(spark, [path]) == int(old)  # set by the session: kept
    try:
        n = size_shuffle_partitions(spark, [path], bytes_per_partition=size // 40, force=True)
        assert n == max(spark.sparkContext.defaultParallelism, 41)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
