"""Helpers the operators share: written intermediate tables and vectorised word hashing."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.config import scratch_path

U64 = np.uint64
#: Bytes of text that one vectorised step hashes; bounds a Python worker's memory.
STEP_BYTES = 1 << 21
_P = 0x9E3779B97F4A7C15 & ~7 | 5  # odd multiplier of maximal order modulo 2**64
_MIX = (U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    Cuts the lineage at a table that every executor can read, so a lost
    executor costs a re-read, not a recomputation.
    """
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written`` and the path, for a table that is to go again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``written_at`` that nothing reads any more; without a JVM at hand (Spark Connect) it stays for the folder's clean-up."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * _MIX[0]
    x ^= x >> U64(27)
    x = x * _MIX[1]
    return x ^ (x >> U64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(salt * 1_000_003)) * U64(0x9E3779B97F4A7C15)) | U64(1)


class WordHasher:
    """Words of many texts as 64-bit hashes, a few numpy passes over the bytes.

    A word is a maximal run of bytes not in ``separators``; ``fold`` maps A-Z
    to a-z first. A word's hash is a polynomial over its bytes taken from one
    running sum, divided by the power of its start.
    """

    def __init__(self, separators: bytes = b" \t\n\x0b\x0c\r", fold: bool = True):
        self.sep = np.zeros(256, bool)
        self.sep[list(separators)] = True
        value = seeds(256, 7)
        if fold:
            value[65:91] = value[97:123]
        self.value = value
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        inverse = pow(_P, -1, 1 << 64)
        power = np.full(n, _P, U64)
        back = np.full(n, inverse, U64)
        power[0] = back[0] = 1
        self.power, self.back = np.multiply.accumulate(power), np.multiply.accumulate(back)

    def words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start byte, end byte) per word and the number of words before each text and the end.

        ``data`` holds the texts' bytes without gaps, ``bounds`` the texts' ends with a leading 0.
        """
        n = len(data)
        if n == 0:
            empty = np.zeros(0, np.int64)
            return np.zeros(0, U64), empty, empty, np.zeros(len(bounds), np.int64)
        if n > len(self.power):
            self._grow(1 << int(n).bit_length())
        inside = ~self.sep[data]
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        running = np.zeros(n + 1, U64)
        np.cumsum(self.value[data] * self.power[:n], out=running[1:])
        hashes = mix((running[ends] - running[starts]) * self.back[starts])
        return hashes, starts, ends, np.searchsorted(starts, bounds)


def text_steps(column: pa.Array, step_bytes: int = STEP_BYTES):
    """(first row, last row, bytes, bounds) of runs of rows holding about ``step_bytes`` of text; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + step_bytes, "right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, last, data[offsets[row]: offsets[last]], offsets[row: last + 1] - offsets[row]
        row = last


def release_memory() -> None:
    """Gives back the free memory of a worker, which may wait idle for other tasks beside the heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def released(run):
    """``run`` for mapInArrow; afterwards the worker's free memory is given back."""

    def wrapped(batches):
        yield from run(batches)
        release_memory()

    return wrapped


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow list column from flat values and row ends with a leading 0."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def ascii_lower(text):
    """``text`` (a Column) with A-Z as a-z and every other character as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, upper, lower)).otherwise(F.lower(text))


def rows_of(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
