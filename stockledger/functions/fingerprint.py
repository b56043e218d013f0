"""Order-free fingerprints of whole tables, which any SQL engine with md5 can repeat.

A row's text is every value's length and text in column order, a dash for
null; a table's fingerprint is the sum of the first 60 bits of the rows' md5
sums. It counts repeated rows and does not depend on row order, partitions or
files. Doubles count to six decimals: their floor, then the rest in
millionths, both exact in IEEE arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLION = 1_000_000


def _text(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        x = c.cast("double")
        whole = F.floor(x)
        rest = F.floor((x - whole.cast("double")) * MILLION + 0.5)
        return F.when(F.isnan(x), "nan").otherwise(F.concat(whole.cast("string"), F.lit("+"), rest.cast("string")))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"no fingerprint of nested column {name}")
    return c.cast("string")


def row_text(schema: T.StructType) -> Column:
    """The text of a row that its fingerprint hashes."""
    values = [_text(f.name, f.dataType) for f in schema.fields]
    # one concatenation of all columns' parts, not one a column
    parts = ((F.coalesce(F.length(v).cast("string"), F.lit("-")), F.when(v.isNull(), "").otherwise(":"), F.coalesce(v, F.lit(""))) for v in values)
    return F.concat(F.lit(""), *(part for column in parts for part in column))


def fingerprint_aggregates(schema: T.StructType) -> list[Column]:
    """``rows`` and ``fingerprint`` (a decimal string) as aggregates, for ``agg`` or ``observe``."""
    first = F.conv(F.substring(F.md5(row_text(schema)), 1, 15), 16, 10).cast("long")
    # halves of 30 bits add up as longs, a decimal sum a row costs far more
    high, low = (F.coalesce(F.sum(half), F.lit(0)).cast("decimal(20,0)") for half in (F.shiftright(first, 30), first.bitwiseAND(F.lit((1 << 30) - 1))))
    return [F.count(F.lit(1)).alias("rows"), (high * F.lit(1 << 30).cast("decimal(10,0)") + low).cast("decimal(38,0)").cast("string").alias("fingerprint")]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``fingerprint`` of ``df``."""
    return df.agg(*fingerprint_aggregates(df.schema))
