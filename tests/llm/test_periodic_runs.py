import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from helpers import documents, prose, seeded

from stockledger.llm import catalog
from stockledger.llm.periodic_runs import AT_ONCE, Grammar, collapse_runs, runs


def brute_runs(w, min_length=6, min_exponent=4):
    """(start, period, length) of all runs of a word list, period by period."""
    found = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_exponent * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(i, j) + 1
    return sorted((s, q, n) for (s, n), q in found.items())


def brute(doc_id, text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, q, length in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        len(found), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
        sha("".join(f"{s},{length},{q}\n" for s, q, length in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def corpus():
    rng = seeded()
    made = [None, "", " \n\t", "one", "a " * 5, "a " * 6, "a\x0bb\x0c" * 40, "a b a b a b a", "a b a b a b a b", "é" * 7 + " é" * 9, "a\xa0a " * 8, "same same", "same same"]
    for _ in range(150):
        w = prose(rng, rng.randrange(1, 80), rng.choice([2, 3, 300])).split()
        part = w[: rng.randrange(1, 12)]
        made.append(rng.choice([" ", "\n", "  "]).join(w[:20] + part * rng.randrange(1, 9) + w[20:]))
    return made


def test_equals_brute_force(spark, tmp_path):
    cases = list(enumerate(corpus()))
    documents(spark, cases).write.parquet(f"{tmp_path}/documents.parquet")
    rows = catalog.op11_periodic_runs(spark, str(tmp_path)).collect()
    got = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"]) for r in rows}
    assert len(rows) == len(cases) and got == {i: brute(i, t) for i, t in cases}
    assert sum(r["n_runs"] > 0 for r in rows) > 60 and sum(r["n_runs"] > 1 for r in rows) > 3


def test_runs_over_small_alphabets():
    rng = seeded(3)
    for _ in range(400):
        exponent = rng.choice([2, 3, 4, 5])
        length = max(exponent, rng.choice([2, 6, 9]))
        texts = [[rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(50))] for _ in range(rng.randrange(1, 5))]
        words, sizes = np.array([x for t in texts for x in t], np.int64), np.array([len(t) for t in texts])
        assert runs(words, sizes, length, exponent).tolist() == [[i, *r] for i, t in enumerate(texts) for r in brute_runs(t, length, exponent)]


def test_more_candidates_than_one_step_holds():
    words = np.append(np.zeros(100_000, np.int64), [1, 2, 1, 2, 1, 2, 1, 2])
    assert sum(len(words) // (2 * q) for q in range(1, len(words) // 4)) > AT_ONCE
    assert runs(words, np.array([len(words)]), 6, 4).tolist() == [[0, 0, 1, 100_000], [0, 100_000, 2, 8]]


def test_extensions_equal_comparison_word_by_word():
    rng = np.random.default_rng(5)
    for size, letters in ((200, 1), (300, 2), (500, 3), (400, 50)):
        part = rng.integers(0, letters, size)
        w = np.concatenate([part, part[: size // 2], part, rng.integers(0, letters, 50)])
        grammar = Grammar(np.concatenate([[0], w + 2, [1]]), 2)
        a = rng.integers(1, len(w) + 1, 2000)
        b = rng.integers(1, len(w) + 1, 2000)
        a, b = a[a != b], b[a != b]
        marked = np.concatenate([[0], w + 2, [1]])
        for back in (False, True):
            way = -1 if back else 1
            for x, y, n in zip(a.tolist(), b.tolist(), grammar.extend(a, b, back).tolist(), strict=True):
                assert all(marked[x + way * k] == marked[y + way * k] for k in range(n))
                assert marked[x + way * n] != marked[y + way * n]


def test_grammar_derives_its_sequence_and_is_small():
    w = np.tile(np.arange(7), 4000) + 2
    grammar = Grammar(np.concatenate([[0], w, [1]]), 2)
    assert grammar.width[-3:].tolist() == [1, len(w), 1] and len(np.unique(grammar.symbol)) < 200


def test_empty_table_and_settings(spark):
    assert collapse_runs(documents(spark, [])).collect() == []
    row = collapse_runs(documents(spark, ["x a b a b y"]), min_length=2, min_exponent=2).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 4, 2)] and row["collapsed"] == "x a b y" and row["n_words"] == 6


def test_very_long_text(spark):
    rng = seeded()
    text = prose(rng, 100_000, 5000) + " " + "again and again " * 50_000
    row = collapse_runs(documents(spark, [text])).first()
    assert (100_000, 150_000, 3) in [(r["start"], r["length"], r["period"]) for r in row["runs"]]
    assert row["n_words"] == 250_000
