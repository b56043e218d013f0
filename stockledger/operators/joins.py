"""Join helpers: broadcast a side only when a measured bound says it fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed default: largest measured in-memory size we broadcast (64 MiB).
# Override per session with ``stockledger.broadcast.maxBytes``.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024

_FIXED_WIDTH = (
    T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType,
    T.FloatType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType,
)


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("stockledger.broadcast.maxBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_LIMIT


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of ``df``'s in-memory size as a hash relation, in bytes.

    One aggregate job over the (column-pruned) frame: the row count and the
    longest value of every string column. Each row is charged a fixed-width
    slot per column, its longest strings, and a hash-table entry.
    """
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(df.schema.fields):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            aggs.append(F.coalesce(F.max(F.octet_length(F.col(f.name))), F.lit(0)).alias(f"__l{i}"))
        elif not isinstance(f.dataType, (*_FIXED_WIDTH, T.DecimalType)):
            aggs.append(F.lit(1 << 20).alias(f"__l{i}"))  # nested: refuse cheaply
    row = df.agg(*aggs).first()
    return relation_bytes(row["__n"], len(df.columns), sum(int(v) for k, v in row.asDict().items() if k != "__n"))


def relation_bytes(rows: int, columns: int, longest: int) -> int:
    """Bytes of ``rows`` rows: null bits, a slot a column, the longest strings together, and a hash-table entry each."""
    return rows * (8 + 8 * columns + longest + 32)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (limit if limit is not None else broadcast_limit(df))


def maybe_broadcast(df: DataFrame, fits: bool) -> DataFrame:
    """Broadcast ``df`` when its measured size ``fits``; otherwise pin a sort-merge join.

    Beyond the bound the ``merge`` hint keeps the planner from broadcasting
    it anyway on a file-size estimate (compressed Parquet understates the
    in-memory size). The join is then a shuffle join, and AQE's skew-join
    handling splits a hot join key across tasks.
    """
    return F.broadcast(df) if fits else df.hint("merge")
