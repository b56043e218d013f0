import math
import os
from collections import Counter

import pytest
from helpers import documents, prose, seeded, space_words
from pyspark.sql import functions as F

from stockledger.config import checkpoint_dir
from stockledger.llm import lm_scoring
from stockledger.llm.lm_scoring import score


def brute(texts, targets, bits, prior):
    words = [space_words(t) for t in texts]
    counts = Counter(w for ws in words for w in ws)
    size = 1 << bits
    assert len(counts) <= size - 2  # the cut-off order is by hash, so brute force keeps every word
    encoded = [[f"={w}" for w in ws] for ws in words]
    models = []
    for own in (targets, range(len(texts))):
        pair, context, single = Counter(), Counter(), Counter()
        for i in own:
            for u, v in zip(["<s>", *encoded[i]], encoded[i], strict=False):
                pair[u, v] += 1
                context[u] += 1
                single[v] += 1
        models.append((pair, context, single, sum(single.values())))
    out = []
    for ws in encoded:
        total = [0.0, 0.0]
        for k, (pair, context, single, n) in enumerate(models):
            for u, v in zip(["<s>", *ws], ws, strict=False):
                total[k] -= math.log2((pair[u, v] + prior * (single[v] + 1) / (n + size)) / (context[u] + prior))
        out.append([t / len(ws) if ws else None for t in total])
    return out


def test_losses_against_brute_force(spark):
    rng = seeded()
    texts = [prose(rng, rng.randrange(1, 60), 100) for _ in range(60)] + [None, "", " \n", "w1", "W1", "w2 " * 5000, "w3 w4", "w3 w4"]
    targets = [*range(0, 30), 60, 66]
    labels = spark.createDataFrame([(i, 1) for i in targets] + [(0, 1), (None, 1), (999, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in score(documents(spark, texts), labels, bits=8).collect()}
    assert len(got) == len(texts)
    for i, (target, background) in enumerate(brute(texts, targets, 8, 50.0)):
        r = got[i]
        assert (r["n_tokens"], r["is_target"]) == (len(space_words(texts[i])), i in targets)
        if target is None:
            assert (r["loss_target"], r["loss_background"], r["score"]) == (None, None, None)
        else:
            assert r["loss_target"] == pytest.approx(target, abs=1e-4)
            assert r["loss_background"] == pytest.approx(background, abs=1e-4)
            assert r["score"] == pytest.approx(r["loss_target"] - r["loss_background"], abs=1e-9)


def test_other_words_share_one_symbol_and_repeated_rows_are_scored(spark):
    rng = seeded()
    texts = [(i // 2, prose(rng, 30, 5000)) for i in range(40)]
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = score(documents(spark, texts), labels, bits=4).collect()
    assert len(rows) == 40 and sum(r["is_target"] for r in rows) == 2
    assert all(0 < r["loss_background"] < 20 for r in rows)


def test_no_targets_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    row = score(documents(spark, ["a b", "a c"]), none, bits=4).first()
    assert row["loss_target"] == pytest.approx(4)  # uniform over 16 symbols
    assert score(documents(spark, []), none).collect() == []


def test_target_text_scores_below_other_text(spark):
    rng = seeded()
    good, other = [prose(rng, 40, 50) for _ in range(40)], [prose(rng, 40, 50).replace("w", "v") for _ in range(40)]
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    mean = score(documents(spark, good + other), labels, bits=8).groupBy((F.col("doc_id") < 40).alias("good")).agg(F.avg("score").alias("s"))
    by = {r["good"]: r["s"] for r in mean.collect()}
    assert by[True] < by[False] - 1


@pytest.mark.parametrize("most", [1 << 18, 50, 1])
def test_every_word_has_its_own_symbol(spark, most):
    """More words than any bounded vocabulary of the query held, against brute force, however few pairs are sent."""
    rng = seeded()
    texts = [prose(rng, 120, 50 if i % 2 else 5000) for i in range(80)] + [None, " ", "w1 w2", "w1 w2", "once-only words here"]
    targets = [*range(0, 30), 82]
    words = [space_words(t) for t in texts]
    size = len({w for ws in words for w in ws})
    assert size > 2500
    labels = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    got = {r["doc_id"]: r for r in score(documents(spark, texts), labels, most=most).collect()}
    assert len(got) == len(texts)
    for own, name in ((targets, "loss_target"), (range(len(texts)), "loss_background")):
        pair, context, single = Counter(), Counter(), Counter()
        for i in own:
            for u, v in zip([None, *words[i]], words[i], strict=False):
                pair[u, v] += 1
                context[u] += 1
                single[v] += 1
        n = sum(single.values())
        for i, ws in enumerate(words):
            each = [-math.log2((pair[u, v] + 50.0 * (single[v] + 1) / (n + size)) / (context[u] + 50.0)) for u, v in zip([None, *ws], ws, strict=False)]
            assert got[i]["n_tokens"] == len(ws)
            assert got[i][name] == (pytest.approx(sum(each) / len(ws), abs=1e-9) if ws else None)


@pytest.mark.parametrize("limit", [None, "1"])
def test_only_word_counts_are_written_and_texts_are_dealt_once(spark, limit):
    """Nearly all pairs differ: no table of them is written, and the texts cross one shuffle for questions and answers, however the targets are joined."""
    rng = seeded()
    texts = [prose(rng, 300, 600) for _ in range(200)] + [None, ""]
    labels = spark.createDataFrame([(i,) for i in range(0, 200, 3)], "doc_id long")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    if limit:
        spark.conf.set("stockledger.broadcast.maxBytes", limit)
    try:
        out = score(documents(spark, texts), labels)
        assert len(out.collect()) == len(texts)
    finally:
        spark.conf.unset("stockledger.broadcast.maxBytes")
    made = set(os.listdir(folder)) - before
    assert {name.rsplit("-", 1)[0] for name in made} == {"words"}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("Exchange hashpartitioning(step") == 3  # texts, answers, and the texts named again where they are reused


def test_many_steps_and_buckets(spark, monkeypatch):
    """Steps and buckets of a few words give what one of each gives; rows with the same id and text and rows without an id stay."""
    rng = seeded()
    texts = [(i // 2 if i % 7 else None, prose(rng, rng.randrange(0, 60), 300)) for i in range(120)] + [(5, "same text")] * 6 + [(7, None), (None, None)]
    labels = spark.createDataFrame([(i,) for i in (0, 1, 5, 9, 20, 21)], "doc_id long")

    def found(most):
        return sorted(tuple(-1.0 if x is None else round(float(x), 9) for x in r) for r in score(documents(spark, texts), labels, most=most).collect())

    whole = found(1 << 18)
    assert len(whole) == len(texts)
    monkeypatch.setattr(lm_scoring, "_STEP", 100)
    monkeypatch.setattr(lm_scoring, "_BUCKET", 150)
    assert found(1 << 18) == whole and found(20) == whole
