import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from stockledger.llm.ann import nearest
from stockledger.llm.catalog import op3_nearest_neighbours

SF01 = SF001.replace("0.001", "0.01")
ROW = "vec_id long, embedding array<double>, cls long, rank int, score double, ids string, codes int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0.5, "x", 3) for i, v in rows], ROW)


def brute(rows, queries, k):
    out = {}
    for q, v in rows:
        if q in queries:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_recall_of_the_registered_query(spark):
    rows = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect())
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = {}
    for r in op3_nearest_neighbours(spark, SF01).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    vectors = dict(rows)
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        order = [found[r] for r in sorted(found)]
        assert order == sorted(order, key=lambda x: (-x[1], x[0]))
        for i, s in order:
            assert abs(s - float(np.dot(np.array(vectors[i], float), np.array(vectors[q], float)))) < 1e-12
        hits += len({i for i, _ in order} & {i for i, _ in want[q]})
    assert hits >= 0.95 * 20 * len(want)


def test_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(30)]  # equal vectors
    odd = [(200, None), (201, []), (202, [0.0] * 5), (203, [1.0, None, 2.0, 3.0, 4.0]), (204, [float("nan")] + [1.0] * 4), (205, [float("inf")] + [1.0] * 4), (206, [1.0, 2.0]), (None, [1.0] * 5)]
    got = {}
    for r in nearest(table(spark, rows + odd + rows[:1]), F.col("vec_id") % 10 == 0, k=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    want = brute(rows, {i for i, _ in rows if i % 10 == 0}, 7)
    assert set(got) == set(want)
    for q, found in want.items():
        assert sorted(got[q]) == [(n, i, round(s, 9)) for n, (i, s) in enumerate(found, 1)]


def test_blocks_and_chunks_do_not_change_small_results(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((4, 8))
    rows = [(i, (centre[i % 4] + 0.05 * rng.standard_normal(8)).tolist()) for i in range(400)]
    got = {}
    for r in nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, rows_per_group=50).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 5)
    assert sum(len(got[q] & {i for i, _ in f}) for q, f in want.items()) >= 0.9 * 5 * len(want)


def test_few_or_no_rows(spark):
    one = nearest(table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in one] == [(0, 1, 1, 0.5)]
    assert nearest(table(spark, [(0, [1.0, 0.0])]), F.lit(True)).collect() == []
    assert nearest(table(spark, []), F.lit(True)).collect() == []
