"""Operator 12, vector code compression by ball k-means.

Vectors become whole numbers (``floor(scale * component)``) and are cut into
equal consecutive parts; every part position has a codebook of a few entries,
trained by k-means, and a vector's code is the list of its parts' nearest
entries. All arithmetic is exact on integers, so the result does not depend on
partitions or the order of rows.

A round compares a part with few entries only. The parts held by an entry form
its ball, whose radius is its farthest part; only entries within two radii are
its neighbours. Sorted by their distance from the entry, the neighbours' half
distances cut the ball into a stable core, whose parts cannot be nearer to any
other entry and are skipped, and annular rings: a part in the t-th ring can
only be nearer to the first t neighbours. Both limits are kept where distances
are equal, since ties go to the lower index. A task takes the balls of the rows
in its hands, which are never larger than the whole ones.

Every round reads the vectors with their last codes, writes them with the new
ones to the shared checkpoint folder, and adds its sums per part and entry as
the task's last rows, so one pass makes both. The driver gets one number for
each component of each entry. The table of the round before goes once the new one is written.
Rounds after one that moves no entry would repeat it and are left out.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped; the first entries are the vectors of the smallest ids
(null ids last, equal ids by their numbers); with fewer rows than entries,
every row starts one; an entry without parts stays; an empty table gives an
empty result; repeated rows are coded one by one. Vectors of different lengths,
lengths that the parts do not divide, and components too large for exact
64-bit distances are refused with an error. A vector of many megabytes is held
whole by its task, with the others of its batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.common import discard, lists, written_at

#: Bytes of integer components handled at once; bounds a worker's memory.
STEP_BYTES = 1 << 22


def nearest_entries(points: np.ndarray, entries: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each point's nearest entry, ties to the lower index; ``guess`` is any assignment, best the last."""
    between = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
    order = np.argsort(between, axis=1, kind="stable")
    ranked = np.take_along_axis(between, order, axis=1)
    best, found = ((points - entries[guess]) ** 2).sum(axis=1), guess.copy()
    start = best.copy()
    for i in range(len(entries)):
        members = np.flatnonzero(guess == i)
        if not len(members):
            continue
        radius = start[members].max()
        neighbours = int(np.searchsorted(ranked[i], 4 * radius, "right"))  # the entry itself among them
        if neighbours < 2:
            continue
        ring = np.searchsorted(ranked[i, :neighbours], 4 * start[members], "right")
        members, ring = members[ring > 1], ring[ring > 1]  # beyond the stable core
        for t in range(neighbours):
            j = order[i, t]
            if j == i:
                continue
            near = members[ring > t]
            if not len(near):
                break
            away = ((points[near] - entries[j]) ** 2).sum(axis=1)
            nearer = (away < best[near]) | ((away == best[near]) & (j < found[near]))
            best[near[nearer]], found[near[nearer]] = away[nearer], j
    return found, best


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


@dataclass
class Coded:
    """``rows``: the id, the carried columns, ``codes`` (one byte a part) and ``error``; ``codebooks``: parts x entries x components."""

    rows: DataFrame
    codebooks: np.ndarray

    def code(self) -> Column:
        """Two hex digits a part."""
        return F.lower(F.hex("codes"))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


class Codebooks:
    """Trains codebooks: ``parts`` positions of ``entries`` entries each, ``rounds`` rounds."""

    def __init__(self, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096):
        if not 1 <= entries <= 256:
            raise ValueError("a code is one byte a part: 1 to 256 entries")
        self.parts, self.entries, self.rounds, self.scale = parts, entries, rounds, scale

    def fit(self, vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", carry: Sequence[str] = ()) -> Coded:
        """Trains on all rows of ``vectors`` and codes them."""
        spark, v = vectors.sparkSession, F.col(vector_col)
        names = [f"carried_{i}" for i in range(len(carry))]
        kept = vectors.where(v.isNotNull() & F.forall(v, _finite)).select(
            F.col(id_col).alias("id"), *(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)), v.cast("array<double>").alias("v")
        )
        length = self._length(kept)
        numbers = F.transform("v", lambda x: F.floor(x * float(self.scale)).cast("int"))
        table, path = written_at(kept.select("id", *names, numbers.alias("x"), F.lit(bytes(self.parts)).alias("codes")), "vector-numbers")
        first = table.orderBy(F.col("id").asc_nulls_last(), "x").limit(self.entries).select("x").collect()
        books = np.array([r["x"] for r in first], np.int64).reshape(len(first), self.parts, length // self.parts).swapaxes(0, 1).copy()
        for round_ in range(self.rounds + 1):
            before = path
            table, path = written_at(self._assign(table, books), f"vector-codes-{round_}")
            discard(spark, before)
            if round_ == self.rounds or not len(first):
                break
            moved = self._moved(table, books)
            if np.array_equal(moved, books):
                break
            books = moved
        rows = table.where("part is null").select(
            F.col("id").alias(id_col), *(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)), "codes", "error"
        )
        return Coded(rows, books)

    def _length(self, kept: DataFrame) -> int:
        size = F.size("v")
        found = kept.agg(
            F.min(size).alias("least"), F.max(size).alias("most"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")
        ).first()
        if found["most"] is None:
            return 0
        if found["least"] != found["most"] or found["most"] % self.parts:
            raise ValueError(f"vectors of {found['least']} to {found['most']} components cannot be cut into {self.parts} equal parts")
        reach = 2 * (abs(found["largest"] or 0.0) * self.scale + 1)
        if reach >= 1 << 31 or 4 * max(1, found["most"] // self.parts) * reach**2 >= 1 << 62:
            raise ValueError(f"components up to {found['largest']} leave no room for exact distances")
        return found["most"]

    def _assign(self, table: DataFrame, books: np.ndarray) -> DataFrame:
        """``table`` with the codes by ``books``, each task's sums per part and entry as its last rows."""
        carried = [f for f in table.schema.fields if f.name == "id" or f.name.startswith("carried_")]
        names = [f.name for f in carried]
        parts, entries, size = books.shape
        schema = T.StructType([
            *carried, T.StructField("x", T.ArrayType(T.IntegerType())), T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType()),
            T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType())),
        ])
        at_once = max(1, STEP_BYTES // (8 * max(1, parts * size)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
            types = None
            for whole in batches:
                types = types or {n: whole.schema.field(n).type for n in names}
                for at in range(0, whole.num_rows, at_once):
                    batch = whole.slice(at, at_once)
                    rows = batch.num_rows
                    x = np.array(batch.column("x").flatten()).astype(np.int64).reshape(rows, parts, size)
                    guess = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(rows, parts)
                    codes, error = np.empty((rows, parts), np.uint8), np.zeros(rows, np.int64)
                    for p in range(parts):
                        found, away = nearest_entries(x[:, p], books[p], guess[:, p].astype(np.int64))
                        codes[:, p] = found
                        error += away
                        counts[p] += np.bincount(found, minlength=entries)
                        for i in np.unique(found):
                            sums[p, i] += x[found == i, p].sum(axis=0)
                    coded = pa.array([c.tobytes() for c in codes], pa.binary())
                    empty = [pa.nulls(rows, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(n) for n in names), batch.column("x"), coded, pa.array(error), *empty],
                        names=[*names, "x", "codes", "error", "part", "entry", "n", "total"],
                    )
            if types is None or not counts.any():
                return
            p, i = np.nonzero(counts)
            blank = [pa.nulls(len(p), t) for t in (*types.values(), pa.list_(pa.int32()), pa.binary(), pa.int64())]
            totals = lists(sums[p, i].ravel(), np.arange(len(p) + 1) * size)
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array(p.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(counts[p, i]), totals],
                names=[*names, "x", "codes", "error", "part", "entry", "n", "total"],
            )

        source = table.where("part is null") if "part" in table.columns else table
        return source.select(*names, "x", "codes").mapInArrow(run, schema)

    @staticmethod
    def _moved(table: DataFrame, books: np.ndarray) -> np.ndarray:
        """The entries' next places: floor of the mean of their parts; entries without parts stay."""
        whole = lambda c: F.sum(c.cast("decimal(38,0)"))
        sums = table.where("part is not null").select("part", "entry", "n", F.posexplode("total").alias("at", "total"))
        moved = books.copy()
        for r in sums.groupBy("part", "entry", "at").agg(whole(F.col("n")).alias("n"), whole(F.col("total")).alias("total")).collect():
            moved[r["part"], r["entry"], r["at"]] = int(r["total"]) // int(r["n"])
        return moved
