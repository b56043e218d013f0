"""Declared schemas of the retail inputs and outputs, and conformance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prices are read with 15 decimals, enough for any Double of everyday size, and
# the contract counts prices that lose digits all the same. A quantity of up to
# 12 digits times a price is a Decimal(38,15) without rounding, and sums of
# Decimal do not depend on partitioning or task order.
PRICE = T.DecimalType(25, 15)
QUANTITY = T.DecimalType(12, 0)
MONEY = T.DecimalType(38, 15)

PRODUCTS = T.StructType(
    [
        T.StructField("ProductId", T.LongType(), False),
        T.StructField("ProductRootCode", T.LongType(), True),
        T.StructField("Family", T.StringType(), True),
        T.StructField("RetailPrice", PRICE, True),
        T.StructField("SupplierPrice", PRICE, True),
    ]
)

SALES = T.StructType(
    [
        T.StructField("StoreId", T.LongType(), True),
        T.StructField("ProductId", T.LongType(), True),
        T.StructField("Date", T.DateType(), True),
        T.StructField("Quantity", T.LongType(), True),
    ]
)

# Same shape as sales; Quantity is signed: inbound > 0, outbound < 0.
MOVEMENTS = T.StructType(list(SALES.fields))

INTERVAL_STOCK = T.StructType(
    [
        T.StructField("ProductRootCode", T.LongType(), True),
        T.StructField("StoreId", T.LongType(), True),
        T.StructField("StartDate", T.DateType(), True),
        T.StructField("EndDate", T.DateType(), True),
        T.StructField("Stock", T.LongType(), True),
    ]
)

DAILY_STOCK = T.StructType(
    [
        T.StructField("ProductRootCode", T.LongType(), True),
        T.StructField("StoreId", T.LongType(), True),
        T.StructField("Date", T.DateType(), True),
        T.StructField("Stock", T.LongType(), True),
    ]
)

# Fixed values of the original job: the published tables and their columns
# (the year column is spelled Anio throughout).
STORE_BENEFITS = T.StructType(
    [
        T.StructField("StoreId", T.LongType()),
        T.StructField("Anio", T.IntegerType()),
        T.StructField("Beneficio", T.DoubleType()),
    ]
)
FAMILY_BENEFITS = T.StructType(
    [
        T.StructField("Family", T.StringType()),
        T.StructField("Anio", T.IntegerType()),
        T.StructField("Beneficio", T.DoubleType()),
    ]
)
STORE_ROTATION = T.StructType(
    [
        T.StructField("StoreId", T.LongType()),
        T.StructField("Anio", T.IntegerType()),
        T.StructField("Rotacion", T.DoubleType()),
    ]
)
FAMILY_ROTATION = T.StructType(
    [
        T.StructField("Family", T.StringType()),
        T.StructField("Anio", T.IntegerType()),
        T.StructField("Rotacion", T.DoubleType()),
    ]
)
STORE_BENEFITS_V2 = T.StructType(
    [
        T.StructField("StoreId", T.LongType()),
        T.StructField("Anio", T.IntegerType()),
        T.StructField("TotalBeneficio", T.DoubleType()),
    ]
)
FAMILY_BENEFITS_V2 = T.StructType(
    [
        T.StructField("Family", T.StringType()),
        T.StructField("Anio", T.IntegerType()),
        T.StructField("TotalBeneficio", T.DoubleType()),
    ]
)
OUTPUT_SCHEMAS = {
    "interval_stock": INTERVAL_STOCK,
    "daily_stock": DAILY_STOCK,
    "store_benefits": STORE_BENEFITS,
    "family_benefits": FAMILY_BENEFITS,
    "store_rotation": STORE_ROTATION,
    "family_rotation": FAMILY_ROTATION,
    "store_benefits_v2": STORE_BENEFITS_V2,
    "family_benefits_v2": FAMILY_BENEFITS_V2,
}
OUTPUTS = tuple(OUTPUT_SCHEMAS)


def _cast(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    # A timestamp where a date is expected becomes its calendar day.
    return c.cast(dtype).alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, cast to its types.

    Missing columns raise at analysis time with the column name; extra
    columns are pruned here, so the Parquet scan reads only what is used.
    """
    present = {f.name.lower() for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ValueError(f"input lacks columns {missing}; has {df.columns}")
    return df.select([_cast(f.name, f.dataType) for f in schema.fields])


def worth(quantity: str, price: str) -> Column:
    """Quantity x price, exact; a quantity of more than 12 digits raises."""
    return F.col(quantity).cast(QUANTITY) * F.col(price)


def minus(a, b) -> Column:
    """Difference of two money sums with all 15 decimals; missing sums count as 0."""
    zero = F.lit(0).cast(MONEY)
    narrow = T.DecimalType(37, 15)  # one digit less, so that the difference keeps its scale
    return F.coalesce(a, zero).cast(narrow) - F.coalesce(b, zero).cast(narrow)


def check_schema(df: DataFrame, schema: T.StructType, name: str = "") -> DataFrame:
    """Raise unless ``df`` has exactly ``schema``'s columns and types, in order.

    Analysis only, no job: a guard before publishing a table.
    """
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise ValueError(f"output {name or '?'} has {got}, expected {want}")
    return df
