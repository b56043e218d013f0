"""Approximate nearest neighbours with a hash-prefix forest (operator 3).

Vectors of equal value are one *class*, kept with its smallest ids. Inner
products become angles by one more coordinate: x -> (x, sqrt(M^2 - |x|^2)) with
M the largest norm, q -> (q, 0). Each of ``trees`` trees gives a class a string
of ``bits`` signs of random projections; a tree is its strings in order.

The sorted arrays are cut into blocks by leading bits, and blocks that hold
more than ``rows`` classes into chunks by a hash, so a group is bounded
whatever the data. Queries are dealt to the groups that can hold matches.

1. Descent: in a few trees a query meets the strings around its own place (the
   longest common prefixes) and so a first k-th score.
2. Synchronous ascent: all trees together shorten the prefix until a vector as
   near as that score shares a prefix of that length in some tree with
   probability ``target`` (the chance that a random projection parts two
   vectors is their angle / pi). Every class with such a prefix is a candidate.
   Where neighbours are near, prefixes stay long and candidates few; for
   vectors without structure the ascent goes far up, which their recall needs.
3. Candidates are scored inside their groups; each group returns its best, and
   scores are the inner products of the original vectors in double precision.

A query whose descent finds fewer than k others ascends to the root, so it
gets all candidates there are.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components take no part, nor do those whose length is not the most
frequent one (of equally frequent lengths, the larger). Rows with a null id
take no part. Repeated rows of one id count once. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.common import written

_MARGIN = 1e-4  # of single-precision scores, relative to the largest possible one


def planes(trees: int, bits: int, dims: int) -> np.ndarray:
    """Fixed random directions, one row for each tree and bit."""
    return np.random.default_rng(20_240_607).standard_normal((trees * bits, dims)).astype(np.float32)


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vec) that take part, and their number of components."""
    vec = F.col(vector_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = rows.where(F.col(id_col).isNotNull() & vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), vec.alias("vec")
    )
    row = good.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d")).alias("m")).first()
    dims = row["m"]["d"] if row["m"] else 0
    return good.where(F.size("vec") == dims), dims


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """(cls, vec, ids): distinct vectors, named by their smallest id, with their k + 1 smallest ids."""
    named = vectors.withColumn("h", F.xxhash64("vec"))
    rank = F.row_number().over(Window.partitionBy("h", "vec").orderBy("id"))
    few = named.distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return few.groupBy("h", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("cls"), "vec", "ids")


def hashed(vectors: DataFrame, largest: float, dims: int, trees: int, bits: int, query: bool) -> DataFrame:
    """``vectors(cls, vec)`` with ``codes``: one string of bits, as a number, a tree."""
    directions = planes(trees, bits, dims + 1)
    weight = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
            rest = np.zeros(n) if query else np.sqrt(np.maximum(largest**2 - (v * v).sum(axis=1), 0))
            full = np.column_stack([v, rest]).astype(np.float32)
            codes = np.empty((n, trees), np.int64)
            for t in range(trees):
                codes[:, t] = ((full @ directions[t * bits: (t + 1) * bits].T) > 0) @ weight
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * trees), pa.array(codes.reshape(-1)))],
                names=["cls", "vec", "codes"],
            )

    return vectors.select("cls", "vec").mapInArrow(run, "cls long, vec array<double>, codes array<long>")


def best_of(names: np.ndarray, vectors: np.ndarray, query: np.ndarray, approx: np.ndarray, k: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The k best of ``names`` by exact score, ties to the smaller name; ``approx`` may be off by the margin."""
    if len(names) > k:
        kth = np.partition(approx, len(approx) - k)[len(approx) - k]
        near = np.flatnonzero(approx >= kth - _MARGIN * scale)
        names, vectors = names[near], vectors[near]
    score = (vectors * query).sum(axis=1)
    order = np.lexsort((names, -score))[:k]
    return names[order], score[order]


def _groups(index: DataFrame, queries: DataFrame, trees: int, block_bits: int, bits: int, rows: int, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index rows and query rows dealt to (tree, block, chunk); ``queries`` carry ``prefix``, the bits that must agree."""
    tree = F.posexplode(F.slice("codes", 1, trees)).alias("tree", "code")
    shift = bits - block_bits
    held = index.select("cls", "vec", tree).withColumn("block", F.shiftright("code", shift))
    held = held.join(sizes, ["tree", "block"]).withColumn("chunk", F.pmod(F.xxhash64("cls"), "chunks"))
    asked = queries.select("cls", "vec", "prefix", tree)
    free = F.greatest(F.lit(block_bits) - F.col("prefix"), F.lit(0))  # leading bits of the block that may differ
    width = F.call_function("shiftleft", F.lit(1).cast("long"), free)
    base = F.shiftright("code", shift)
    low = base - base % width
    asked = asked.withColumn("block", F.explode(F.sequence(low, low + width - 1)))
    asked = asked.join(sizes, ["tree", "block"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return held, asked


_FOUND = "query long, cls long, score double"


def _descend(held: DataFrame, asked: DataFrame, around: int, k: int) -> DataFrame:
    """The best of the strings around each query's own place in its groups."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c, s = [], [], []
        if left.num_rows and right.num_rows:
            code, name, vec = _arrays(left)
            order = np.argsort(code, kind="stable")
            code, name, vec = code[order], name[order], vec[order]
            q_code, q_name, q_vec = _arrays(right)
            at = np.searchsorted(code, q_code)
            for i, p in enumerate(at):
                part = slice(max(p - around, 0), p + around)
                names, scores = best_of(name[part], vec[part], q_vec[i], vec[part] @ q_vec[i], k, 1.0)
                q.append(np.full(len(names), q_name[i]))
                c.append(names)
                s.append(scores)
        return _result(q, c, s)

    return _cogroup(held, asked, run)


def _ascend(held: DataFrame, asked: DataFrame, bits: int, k: int) -> DataFrame:
    """The best of all strings that share each query's prefix."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c, s = [], [], []
        if left.num_rows and right.num_rows:
            code, name, vec = _arrays(left)
            order = np.argsort(code, kind="stable")
            code, name, vec = code[order], name[order], vec[order]
            single = vec.astype(np.float32)
            largest = math.sqrt(float((vec * vec).sum(axis=1).max()))
            q_code, q_name, q_vec = _arrays(right)
            prefix = right.column("prefix").to_numpy().astype(np.int64)
            low = (q_code >> (bits - prefix)) << (bits - prefix)
            begin = np.searchsorted(code, low)
            end = np.searchsorted(code, low + (np.int64(1) << (bits - prefix)) - 1, "right")
            same = np.lexsort((end, begin))  # queries with one slice are scored together
            cuts = np.flatnonzero(np.diff(begin[same], prepend=-1) | np.diff(end[same], prepend=-1))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(same)), strict=True):
                for some in np.array_split(same[lo:hi], -(-(hi - lo) // 128)):
                    part = slice(begin[some[0]], end[some[0]])
                    if part.stop <= part.start:
                        continue
                    approx = q_vec[some].astype(np.float32) @ single[part].T
                    for row, i in zip(approx, some, strict=True):
                        scale = largest * math.sqrt(float(q_vec[i] @ q_vec[i]))
                        names, scores = best_of(name[part], vec[part], q_vec[i], row, k, scale)
                        q.append(np.full(len(names), q_name[i]))
                        c.append(names)
                        s.append(scores)
        return _result(q, c, s)

    return _cogroup(held, asked, run)


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vec = table.column("vec").combine_chunks()
    flat = vec.flatten().to_numpy(zero_copy_only=False)
    return table.column("code").to_numpy(), table.column("cls").to_numpy(), flat.reshape(table.num_rows, -1)


def _result(q: list, c: list, s: list) -> pa.Table:
    def flat(x, kind):
        return pa.array(np.concatenate(x) if x else np.zeros(0), kind)

    return pa.table({"query": flat(q, pa.int64()), "cls": flat(c, pa.int64()), "score": flat(s, pa.float64())})


def _cogroup(held: DataFrame, asked: DataFrame, run) -> DataFrame:
    keys = ["tree", "block", "chunk"]
    return held.select(*keys, "code", "cls", "vec").groupBy(*keys).cogroup(asked.select(*keys, "code", "cls", "vec", "prefix").groupBy(*keys)).applyInArrow(run, _FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cls"))
    return found.dropDuplicates(["query", "cls"]).withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def nearest(
    rows: DataFrame, is_query: Column, *, k: int = 20, trees: int = 16, bits: int = 32, rows_per_group: int = 16_384, target: float = 0.93,
    around: int = 64, descent_trees: int = 8, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, id, score of each query's k nearest rows other than itself, by inner product.

    ``is_query`` is a condition over the input's columns; the queries are searched against all rows.
    """
    good, dims = valid_vectors(rows, id_col, vector_col)
    picked = rows.where(is_query).select(F.col(id_col).cast("long").alias("id"))
    classes = written(classes_of(good, k), "classes")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(norm)).alias("m")).first()
    n, largest = stats["n"], stats["m"] or 0.0
    block_bits = min(bits, max(0, math.ceil(math.log2(max(n, 1) / rows_per_group))))
    index = written(hashed(classes, largest, dims, trees, bits, query=False), "index")
    asked = written(good.join(picked.distinct(), "id").select("id", "vec").distinct(), "queries")
    # queries of equal vectors are searched once, under their smallest id
    query_class = asked.groupBy("vec").agg(F.min("id").alias("cls"))
    hashed_queries = written(hashed(query_class, largest, dims, trees, bits, query=True), "query-strings")
    sizes = (
        index.select(F.posexplode("codes").alias("tree", "code")).groupBy("tree", F.shiftright("code", bits - block_bits).alias("block"))
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_group)).cast("long").alias("chunks"))
    )
    sizes = written(sizes, "group-sizes")

    own_block = hashed_queries.withColumn("prefix", F.lit(bits))
    first = written(_merged(_descend(*_groups(index, own_block, descent_trees, block_bits, bits, rows_per_group, sizes), around, k + 1), k + 1), "descent")
    # from the (k + 1)-th score, the query's own class among them, to the length of prefix that the target needs
    reached = first.groupBy("query").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("kth"))
    cosine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("kth") / (F.lit(largest) * F.sqrt(norm))))
    agree = F.lit(1.0) - F.acos(cosine) / F.lit(math.pi)
    per_tree = 1.0 - (1.0 - target) ** (1.0 / trees)  # chance that one tree must give
    length = F.when(agree >= 1.0, F.lit(bits)).otherwise(F.floor(F.lit(math.log(per_tree)) / F.log(agree)))
    length = F.when(F.col("found") > k, F.greatest(F.lit(0), F.least(F.lit(bits), length))).otherwise(F.lit(0))
    ascent = hashed_queries.join(reached, hashed_queries["cls"] == reached["query"], "left").withColumn("prefix", F.coalesce(length, F.lit(0)).cast("int"))
    ascent = ascent.select("cls", "vec", "codes", "prefix")
    best = _ascend(*_groups(index, ascent, trees, block_bits, bits, rows_per_group, sizes), bits, k + 1)
    best = written(_merged(best.union(first), k + 1), "ascent")

    ids = best.join(classes.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("vec_id"))
    # a class of queries: everything each of its members may need
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    short = ids.withColumn("rank", rank).where(F.col("rank") <= k + 1).select("query", "score", "vec_id")
    member = asked.join(query_class, "vec").select(F.col("id").alias("query_id"), F.col("cls").alias("query"))
    last = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        member.join(short, "query").where("vec_id <> query_id").withColumn("rank", last).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
