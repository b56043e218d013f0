import hashlib

import duckdb
from conftest import SF001
from helpers import CLASHING, contaminated, documents, prose, seeded

from stockledger.llm import catalog
from stockledger.llm.decontam import contamination, filter_clean, matches

ITEM = "item_id long, text string, id string, win string"


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEM)


def case():
    rng = seeded()
    tests = [(i, prose(rng, rng.randrange(14, 40))) for i in range(12)]
    tests += [(50, tests[0][1]), (60, "w1"), (61, "w2 w3"), (62, None), (63, ""), (64, "…!"), (65, "absent word"), (66, "É é Ñ"), (None, tests[1][1])]
    texts = [prose(rng, rng.randrange(5, 120)) for _ in range(40)]
    for i in range(12):
        words = tests[i][1].split()
        texts += [prose(rng, 60) + " " + tests[i][1].upper() + ", " + prose(rng, 60), " ".join(words[:12]), " ".join(words[1:14]), " ".join([*words[:6], "odd", *words[6:]])]
    texts += [None, "", "  …", "É é Ñ", "é é ñ", "w2 W3", "(w1) " * 500, prose(rng, 20_000, 5), tests[3][1], tests[3][1]]
    return texts, tests


def test_against_brute_force(spark):
    texts, tests = case()
    got = {r["doc_id"]: r for r in contamination(documents(spark, texts), items(spark, tests)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n, hit, found, bad = contaminated(text, tests)
        names = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(names), digest, bad), (i, text and text[:80])


def test_filter_keeps_clean_rows_as_they_are(spark):
    texts, tests = case()
    docs = documents(spark, [(i // 2, t) for i, t in enumerate(texts)])  # ids repeat
    kept = filter_clean(docs, items(spark, tests))
    assert kept.schema == docs.schema and set(CLASHING) <= set(kept.columns)
    want = sorted(str((i // 2, t)) for i, t in enumerate(texts) if not contaminated(t, tests)[3])
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == want


def test_proximity_matches(spark):
    test = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi")]
    words = test[0][1].split()
    texts = [" ".join(words), " ".join([*words[:5], "oh", *words[5:]]), " ".join(words[::-1]), "alpha nu xi"]
    docs = documents(spark, texts)
    found, _, _ = matches(docs, items(spark, test), slop=2)
    kinds = {}
    for r in found.collect():
        kinds.setdefault(r["id"], set()).add(r["kind"])
    assert "phrase" in kinds[0] and "proximity" in kinds[1] and 3 not in kinds
    assert {r["kind"] for r in matches(docs, items(spark, test))[0].collect()} == {"phrase"}


def test_no_items_and_no_documents(spark):
    texts, tests = case()
    assert {r["contaminated"] for r in contamination(documents(spark, texts[:5]), items(spark, [])).collect()} == {False}
    assert contamination(documents(spark, []), items(spark, tests)).collect() == []


def test_sql_of_every_registered_query(spark):
    """Each query of the subpackage that has SQL gives the SQL's rows."""
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    queries = catalog.queries()
    assert sorted({int(q[2:].split("_")[0]) for q in queries}) == list(range(1, 14))
    for name, sql in catalog.oracle_sql().items():
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        df = queries[name](spark, SF001)
        assert sorted(df.columns) == sorted(columns), name
        assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, want.fetchall())), name
