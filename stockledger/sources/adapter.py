"""Driver tables (part, lineitem, orders) seen as retail tables.

The mapping is FIXTURES.md §4; the DuckDB text of the same mapping lives in
``plans.oracle`` and both sides must agree row for row.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .tables import RetailTables

# Fixed values of the mapping (FIXTURES.md §4).
NULL_ROOT_MOD = 53           # p_partkey % 53 = 0: no root code
ROOT_WIDTH = 20              # root = floor(p_partkey / 20)
NULL_FAMILY_MOD, NULL_FAMILY_REM = 59, 5   # p_partkey % 59 = 5: no family
UNPRICED_MOD = 41            # p_partkey % 41 = 0: no retail price
SUPPLIER_FACTOR = "0.4123456789"  # supplier price = retail price x this: 12 decimals
STORE_MOD = 10               # store = l_suppkey % 10
# movements of every 97th product at supplier remainder 3 belong to store 99, which has no sales
ODD_PRODUCT_MOD, ODD_STORE, ODD_SUPP_REM = 97, 99, 3
RETURN_FLAG = "R"            # returned lines: outbound x 2 in movements
CENTS = T.DecimalType(12, 2)  # retail prices of the mapping are whole cents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def adapt_products(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    retail = F.col("p_retailprice").cast(CENTS)
    return part.select(
        key.cast("long").alias("ProductId"),
        F.when(key % NULL_ROOT_MOD == 0, F.lit(None))
        .otherwise(F.floor(key / ROOT_WIDTH).cast("long"))
        .alias("ProductRootCode"),
        F.when(key % NULL_FAMILY_MOD == NULL_FAMILY_REM, F.lit(None))
        .otherwise(F.col("p_type"))
        .alias("Family"),
        F.when(key % UNPRICED_MOD == 0, F.lit(None)).otherwise(retail).alias("RetailPrice"),
        (retail * F.lit(SUPPLIER_FACTOR).cast("decimal(11,10)")).alias("SupplierPrice"),
    )


def adapt_movements(lineitem: DataFrame) -> DataFrame:
    store = F.col("l_suppkey") % STORE_MOD
    qty = F.col("l_quantity").cast("long")
    return lineitem.select(
        F.when(
            (F.col("l_partkey") % ODD_PRODUCT_MOD == 0) & (store == ODD_SUPP_REM),
            F.lit(ODD_STORE).cast("long"),
        )
        .otherwise(store)
        .alias("StoreId"),
        F.col("l_partkey").alias("ProductId"),
        F.col("l_shipdate").cast("date").alias("Date"),
        F.when(F.col("l_returnflag") == RETURN_FLAG, -qty * 2).otherwise(qty).alias("Quantity"),
    )


def adapt_sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    store = F.col("l_suppkey") % STORE_MOD
    lines = lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity")
    heads = orders.select("o_orderkey", "o_orderdate")
    return (
        lines.join(heads, lines.l_orderkey == heads.o_orderkey)
        .select(
            store.alias("StoreId"),
            F.col("l_partkey").alias("ProductId"),
            F.col("o_orderdate").cast("date").alias("Date"),
            F.col("l_quantity").cast("long").alias("Quantity"),
        )
    )


def driver_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    """Retail view of ``sf_dir``'s part, lineitem and orders tables."""
    lineitem = _table(spark, sf_dir, "lineitem")
    raw = adapt_products(_table(spark, sf_dir, "part"))
    return RetailTables(
        S.conform(raw, S.PRODUCTS),
        S.conform(adapt_sales(lineitem, _table(spark, sf_dir, "orders")), S.SALES),
        S.conform(adapt_movements(lineitem), S.MOVEMENTS),
        raw_products=raw,
    )
