import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import UPPER, documents, seeded
from pyspark.sql import functions as F

from stockledger.llm.common import U64
from stockledger.llm.quality_rules import FrequentTerms, Rules, apply_rules, divergence

RULES = Rules(min_words=5, judged_chars=60, judged_words=12, common_share=0.02, char_limit=0.2, word_limit=0.3)


def base(text, rules):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7))
    repeated = {j for i in range(len(w) - 7) if windows[tuple(w[i: i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(w) < rules.min_words or 100 * len(repeated) > rules.repeat_percent * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed


def char_class(c):
    for i, kind in enumerate(("[a-z]", "[A-Z]", "[0-9]", r"[#*$%&|<>]", "[\x20\x09-\x0d]")):
        if re.match(kind, c):
            return i
    return 5 if ord(c) < 128 else 6


def histograms(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))
    return Counter(map(char_class, text or "")), Counter(words)


def distance(own, ref):
    n = max(1, sum(own.values()))
    bins = list(ref)
    total = 0
    for k in bins:
        p, q = own.get(k, 0) / n, ref[k]
        m = (p + q) / 2
        total += (p * math.log2(p / m) if p else 0) + (q * math.log2(q / m) if q else 0)
    return math.sqrt(max(0, max(0, total / 2) - (len(bins) - 1) / (8 * n * math.log(2))))


def brute(docs, rules):
    """{id: (base..., kept)} of (id, text, lang)."""
    judged = {i: base(t, rules) for i, t, _ in docs}
    refs = {}
    for lang in {x for i, _, x in docs if x is not None and not judged[i][5]}:
        chars, words = Counter(), Counter()
        for i, t, x in docs:
            if x == lang and not judged[i][5]:
                c, w = histograms(t)
                chars += c
                words += w
        n = sum(words.values())
        common = {w: k / n for w, k in words.items() if k >= rules.common_share * n}
        refs[lang] = ({k: chars.get(k, 0) / sum(chars.values()) for k in range(7)}, common | {None: 1 - sum(common.values())})
    out = {}
    for i, t, lang in docs:
        chars, words = histograms(t)
        best = None
        for ref in [lang] if lang in refs else sorted(refs):
            held = {k: n for k, n in words.items() if k in refs[ref][1]}
            held[None] = sum(words.values()) - sum(held.values())
            x = distance(chars, refs[ref][0]), distance(held, refs[ref][1])
            if best is None or sum(x) < sum(best):
                best = x
        ok = not judged[i][5]
        if best and sum(chars.values()) >= rules.judged_chars:
            ok &= best[0] <= rules.char_limit
        if best and sum(words.values()) >= rules.judged_words:
            ok &= best[1] <= rules.word_limit
        out[i] = (*judged[i], ok)
    return out


def corpus():
    rng = seeded()
    speech = {"xx": "the of and to a in is it".split(), "yy": "der die und das ist ein zu er".split()}
    made = []
    for i in range(60):
        lang = rng.choice(list(speech))
        words = [rng.choice(speech[lang]) if rng.random() < 0.5 else "w" + "".join(rng.choice("abcdeé") for _ in range(5)) for _ in range(rng.randrange(8, 90))]
        lines = "\n".join(" ".join(words[j: j + 9]).capitalize() + "." for j in range(0, len(words), 9))
        made.append((lines, rng.choice([lang, lang, None, "zz"]) if i % 7 == 0 else lang))
    junk = [
        " ".join(f"w{i}$$$ ###" for i in range(40)), "same same " * 60, "A B C D E F G H I. " * 5 + "and so on", "LA!! SE!! QUE!! " + " ".join(f"WORD{i}!!" for i in range(50)),
        "one\ntwo\none\n \n \nthree one two four", "the of and\x0bto\x0ca in", "tin " * 7, "é" * 300 + " a b c d e", "x" * 5000,
    ]
    made += [(t, "xx") for t in junk] + [(None, "xx"), ("", None), (" \n\t ", "yy"), (None, None)] + [made[0], made[0]]
    return [(i, t, x) for i, (t, x) in enumerate(made)]


def run(spark, docs, rules=RULES):
    df = documents(spark, [(i, t) for i, t, _ in docs]).drop("lang")
    langs = spark.createDataFrame([(i, x) for i, _, x in docs], "doc_id long, lang string")
    return apply_rules(df.join(langs, "doc_id"), rules)


def test_equals_brute_force(spark):
    docs = corpus()
    rows = run(spark, docs).collect()
    want = brute(docs, RULES)
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in rows}
    assert len(rows) == len(docs) and got == want
    assert any(not r["base_failed"] and not r["kept"] for r in rows) and sum(r["kept"] for r in rows) > 30


def test_partitions_and_order_do_not_matter(spark):
    docs = corpus()
    key = lambda df: sorted(map(repr, df.drop("char_distance", "word_distance").collect()))
    assert key(run(spark, docs)) == key(run(spark, docs[::-1])) == key(run(spark, docs).repartition(1))


def test_short_texts_are_not_judged_by_histograms(spark):
    docs = corpus()
    for r in run(spark, docs, Rules(min_words=0, repeat_percent=1000, char_limit=0, word_limit=0)).collect():
        if not r["kept"]:
            assert r["char_distance"] or r["word_distance"]
        if r["char_distance"] is None and r["word_distance"] is None:
            assert r["kept"]


def test_empty_table_and_no_language(spark):
    assert run(spark, []).collect() == []
    docs = [(0, "a b c d e f g h", None), (1, None, None)]
    assert {r["doc_id"]: r["kept"] for r in run(spark, docs).collect()} == {0: True, 1: False}


def test_common_terms_survive_the_counters():
    rng = np.random.default_rng(3)
    found = FrequentTerms(50)
    stream = np.concatenate([rng.integers(0, 100_000, 40_000), np.repeat(np.arange(5), 1500)]).astype(U64)
    rng.shuffle(stream)
    for part in np.array_split(stream, 37):
        found.add(part)
        assert len(found.keys) <= 50
    exact = Counter(stream.tolist())
    held = dict(zip(found.keys.tolist(), found.counts.tolist(), strict=True))
    for k, n in exact.items():
        assert n - len(stream) / 50 <= held.get(k, 0) <= n
    assert found.total == len(stream) and set(range(5)) <= set(held)


def test_divergence_bounds():
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    assert divergence(p, np.array([0.0, 1.0])) == pytest.approx([1.0, 0.311278], abs=1e-6)
    assert divergence(p, np.array([1.0, 0.0]))[0] == 0


def test_very_long_text(spark):
    rng = seeded()
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300_000))
    r = run(spark, [(0, text, "xx"), (1, "a b c", "xx")]).where(F.col("doc_id") == 0).first()
    assert r["n_words"] == 300_000 and r["kept"] and r["n_dup_lines"] == 0
