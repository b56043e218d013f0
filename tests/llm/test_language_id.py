from conftest import SF001
from helpers import CLASHING, documents
from pyspark.sql import functions as F

from stockledger.llm.catalog import op1_language_id
from stockledger.llm.language_id import Model, Vectoriser, cluster, identify, keep_identified, weigh

SF01 = SF001.replace("0.001", "0.01")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    row = op1_language_id(spark, SF01).where("held_out").join(docs, "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.avg(F.col("rejected").cast("int")).alias("rejected")
    ).first()
    assert row["right"] >= 0.99
    assert row["rejected"] <= 0.005


def mixed(spark):
    english = [(i, f"the cat and the dog went there number {i}") for i in range(60)]
    german = [(100 + i, f"der hund und die katze gehen dorthin nummer {i}") for i in range(60)]
    odd = [(200, None), (201, ""), (202, "12 34 !!"), (203, "Съешь ещё этих мягких французских булок"), (204, "the dog and the cat"), (204, "the dog and the cat"), (205, "der hund " * 300_000)]
    df = documents(spark, english + german + odd)
    lang = F.when(F.col("doc_id") < 100, "en").when(F.col("doc_id") < 200, "de")
    return df.withColumn("lang", lang.otherwise(F.lit(None).cast("string")))


def test_defined_cases(spark):
    got = defaultdict_rows(identify(mixed(spark)).collect())
    for i in (200, 201, 202):
        assert [(r["lang_pred"], r["score"], r["rejected"]) for r in got[i]] == [("und", 0.0, True)]
    assert got[203][0]["rejected"]
    assert [r["lang_pred"] for r in got[204]] == ["en", "en"]
    assert got[205][0]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for rows in got.values() for r in rows)


def defaultdict_rows(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_filter_keeps_rows_and_columns(spark):
    docs = mixed(spark)
    kept = keep_identified(docs)
    assert kept.schema == docs.schema and set(CLASHING) <= set(kept.columns)
    assert {r["doc_id"] for r in kept.collect()} == {*range(60), *range(100, 160), 204, 205}


def test_no_labels_and_no_rows(spark):
    docs = documents(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in identify(docs).collect()} == {"und"}
    assert identify(docs.limit(0)).collect() == []


def test_long_texts_are_read_in_slices_without_loss():
    v = Vectoriser(10)
    text = "abc déf " * 200_000
    whole, half = v.counts([text])[0], v.counts([text[: len(text) // 2]])[0]
    assert abs(whole.sum() / half.sum() - 2) < 1e-3


def test_clusters_are_unit_vectors_and_ties_go_to_the_first_language():
    import numpy as np

    rng = np.random.default_rng(0)
    made = cluster(weigh(rng.integers(0, 5, (30, 64)).astype(np.float32), np.ones(64, np.float32)), 4)
    assert np.allclose(np.linalg.norm(made, axis=1), 1, atol=1e-5)
    one = np.ones((1, 1 << 10), np.float32) / 32
    assert Model(10, np.ones(1 << 10, np.float32), ["aa", "bb"], np.concatenate([one, one])).predict(["text"])[0] == ["aa"]


def test_only_letters_are_letters(spark):
    docs = documents(spark, ["½", "² ①", "Ⅷ", "٣", "_", "ñ", "漢", "12a", "…x", "ʰ"]).withColumn("lang", F.lit("en"))
    train = documents(spark, [(100 + i, "some words of the tongue") for i in range(30)]).withColumn("lang", F.lit("en"))
    got = {r["doc_id"]: r["lang_pred"] for r in identify(docs.union(train)).collect()}
    assert [got[i] for i in range(10)] == ["und"] * 5 + ["en"] * 5


def plain_counts(text, bits):
    """N-gram counts of one text with dictionaries and Python integers."""
    from collections import Counter

    folded = "".join(chr(b) if b >= 128 or 97 <= b <= 122 else " " for b in text.lower().encode())
    folded = " " + " ".join(folded.split(" ")) + " "
    while "  " in folded:
        folded = folded.replace("  ", " ")
    seed = [int(s) for s in Vectoriser(bits).seeds]
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(folded) - n + 1):
            gram = folded[i: i + n]
            if gram != " ":
                code = int.from_bytes(gram.encode("latin-1"), "big")
                out[((code + (n << 32)) * seed[n - 1] % 2**64) >> (64 - bits)] += 1
    return out


def test_predictions_equal_brute_force():
    import math

    import numpy as np

    rng = np.random.default_rng(9)
    bits, alphabet = 9, list("abcdeé ñß  .,1ZA漢\n")
    texts = ["".join(rng.choice(alphabet, rng.integers(1, 80))) + "a" for _ in range(60)] + ["a", "É É", "x" * 3000]
    idf = (rng.random(1 << bits) + 0.5).astype(np.float32)
    model = Model(bits, idf, [f"l{i % 3}" for i in range(7)], weigh(rng.integers(0, 4, (7, 1 << bits)).astype(np.float32), idf))
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores, strict=True):
        counts = plain_counts(text, bits)
        assert {i: n for i, n in enumerate(Vectoriser(bits).counts([text])[0].tolist()) if n} == counts
        vector = {i: math.log1p(n) * float(idf[i]) for i, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        cosine = [sum(x * float(c[i]) for i, x in vector.items()) / norm for c in model.centroids]
        assert abs(score - max(cosine)) < 1e-5 and cosine[model.languages.index(name)] <= max(cosine)
        assert name in {model.languages[j] for j, c in enumerate(cosine) if max(cosine) - c < 1e-5}
