import math

import numpy as np
import pytest
from helpers import seeded

from stockledger.llm import catalog, vector_codes
from stockledger.llm.vector_codes import Codebooks, nearest_entries

SCHEMA = "vec_id long, embedding array<float>, label int, x string, part string, id string, codes string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *"vwxyz") for i, v, label in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """([(id, codes, error)], codebooks) by comparing every part with every entry."""
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = len(kept[0][1]) // parts if kept else 0
    cut = [(i, [v[p * size: (p + 1) * size] for p in range(parts)]) for i, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * size: (p + 1) * size] for _, v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda part, book: min((far(part, c), j) for j, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, v in cut:
                held[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(h) for c in zip(*h, strict=True)] if h else c for h, c in zip(held, books[p], strict=True)]
    out = []
    for i, v in cut:
        found = [nearest(v[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    return out, books


def vectors(n, seed=7, dim=16, spread=0.3):
    rng = seeded(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(9)]
    return [(i * 3 % 1000, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(n)]


def cases():
    grid = [(i, [float((i * k) % 3) for k in range(16)], 1) for i in range(60)]  # many ties
    same = [(5, [0.5] * 16, 2)] * 40 + [(4, [-0.25] * 16, None)] * 3
    odd = [
        (1, None, 1), (2, [None, *[1.0] * 15], 1), (3, [float("nan"), *[1.0] * 15], 1), (4, [float("inf")] * 16, 1), (None, [0.3] * 16, None), (7, [-0.0001] * 16, 3),
    ]
    return {"clusters": vectors(300), "flat": vectors(150, spread=3), "ties": grid, "copies": same, "odd": [*odd, *vectors(40)], "few": vectors(5)}


@pytest.mark.parametrize("name", cases())
def test_equals_brute_force(spark, name):
    rows = cases()[name]
    want, books = brute(rows)
    coded = Codebooks().fit(frame(spark, rows).repartition(3))
    got = coded.rows.select("vec_id", coded.code().alias("code"), "error").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert coded.codebooks.tolist() == books


def test_label_errors(spark, tmp_path):
    rows = cases()["odd"]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = catalog.op12_vector_codes(spark, str(tmp_path)).collect()
    total = sum(e for _, _, e in brute(rows)[0])
    assert len(got) == 42 and sum({r["label_error"] for r in got}) == total == sum(r["error"] for r in got)
    assert len({r["codebooks_sha256"] for r in got}) == 1


def test_empty_table_and_empty_vectors(spark):
    assert Codebooks().fit(frame(spark, [])).rows.collect() == []
    coded = Codebooks().fit(frame(spark, [(1, [], 1), (2, [], 1)]))
    assert [(r["vec_id"], bytes(r["codes"]), r["error"]) for r in coded.rows.orderBy("vec_id").collect()] == [(1, bytes(8), 0), (2, bytes(8), 0)]


def test_refused_vectors(spark):
    for rows in ([(1, [1.0] * 16, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 12, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(ValueError, match="components"):
            Codebooks().fit(frame(spark, rows))


def test_any_guess_gives_the_nearest_entry():
    rng = np.random.default_rng(2)
    for spread in (2, 20, 1000):
        entries = rng.integers(-spread, spread, (12, 3))
        points = rng.integers(-spread, spread, (500, 3))
        away = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        for guess in (np.zeros(500, int), away.argmin(axis=1), rng.integers(0, 12, 500)):
            found, best = nearest_entries(points, entries, guess)
            assert (found == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_vectors_longer_than_a_step(spark, monkeypatch):
    rng = seeded()
    monkeypatch.setattr(vector_codes, "STEP_BYTES", 10_000)
    rows = [(i, [rng.random() for _ in range(1600)], 1) for i in range(20)]
    want, _ = brute(rows, rounds=1)
    coded = Codebooks(rounds=1).fit(frame(spark, rows))
    got = coded.rows.select("vec_id", coded.code(), "error").collect()
    assert sorted(map(tuple, got)) == sorted(want)
