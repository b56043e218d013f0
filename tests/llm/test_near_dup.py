import numpy as np
import pytest
from helpers import CLASHING, documents, near_components, prose, seeded, shingles

from stockledger.llm import near_dup
from stockledger.llm.near_dup import keep_one, near_duplicates, stars


def case():
    rng = seeded()
    texts = [prose(rng, rng.randrange(1, 80), 60) for _ in range(40)]

    def edited(text, n):
        w = text.split()
        for _ in range(n):
            w[rng.randrange(len(w))] = f"e{rng.randrange(99)}"
        return " ".join(w)

    base = prose(rng, 150)
    texts += [edited(base, rng.randrange(0, 6)) for _ in range(90)]  # one large group of near copies
    chain = base.split()
    texts += [" ".join(chain[i:] + [f"c{j}" for j in range(i)]) for i in range(0, 60, 6)]  # linked one after another
    for t in list(texts[:15]):
        texts += [edited(t, 1), t.upper(), "  " + t.replace(" ", "\n")]
    return [*texts, None, "", " \t", "a", "A", "a b", "a b c", "é", "É", base, "z " * 20_000, "z " * 300, None]


@pytest.mark.parametrize("how", [{}, {"leaf": 16, "pivots": 4, "depth": 2, "blocks": 1}, {"leaf_shingles": 2000}, {"leaf": 8}])
def test_components_against_brute_force(spark, how):
    texts = case()
    got = {r["doc_id"]: r for r in near_duplicates(documents(spark, texts), **how).collect()}
    want = near_components(list(enumerate(texts)), 3, 85)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(shingles(t, 3)) for i, t in enumerate(texts)}
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
    return " ".join(w)


@pytest.fixture
def work(monkeypatch):
    """Rows that groups hold, and rounds of pivots, of the calls of a test."""
    seen = {"rows": 0, "rounds": 0}
    compare, pivots = near_dup.compare, near_dup._pivots

    def counted(members, *how):
        seen["rows"] += members.count()
        return compare(members, *how)

    def again(*how):
        seen["rounds"] += 1
        return pivots(*how)

    monkeypatch.setattr(near_dup, "compare", counted)
    monkeypatch.setattr(near_dup, "_pivots", again)
    return seen


def test_work_grows_in_proportion_to_a_group_of_near_copies(spark, work):
    rows = []
    for size in (300, 600, 1200):
        rng = seeded()
        base = prose(rng, 150)
        work["rows"] = 0
        got = near_duplicates(documents(spark, [edited(rng, base, rng.randrange(1, 4)) for _ in range(size)], clash=False), leaf=64).select("component_id").distinct().count()
        assert got == 1
        rows.append(work["rows"])
    assert rows[1] < 2.6 * rows[0] and rows[2] < 2.6 * rows[1], rows


def test_unlike_documents_of_one_boilerplate_end_in_few_rounds(spark, work):
    rng = seeded()
    boiler = prose(rng, 60)
    texts = [boiler + " " + prose(rng, 60, 5000) for _ in range(700)]
    texts += [edited(rng, t, 1) for t in texts[:40]]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(spark, texts, clash=False), leaf=32, depth=3, pivots=8).collect()}
    assert got == near_components(list(enumerate(texts)), 3, 85)
    assert work["rounds"] <= 4


def test_recall_in_nodes_above_a_leaf(spark):
    """Pairs near the threshold that share their boilerplate's tokens with hundreds of unlike documents."""
    rng = seeded(11)
    boiler = prose(rng, 40)
    texts = []
    for _ in range(250):
        own = boiler + " " + prose(rng, 120, 5000)
        texts += [own, edited(rng, own, rng.randrange(2, 5))]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(spark, texts, clash=False), leaf=48).collect()}
    want = near_components(list(enumerate(texts)), 3, 85)
    linked = [i for i in want if want[i] != i]
    assert len(linked) > 60 and sum(got[i] == want[i] for i in linked) >= 0.99 * len(linked)
    assert all(got[i] == i for i in want if want[i] == i)


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "the same text of some words"), (3, "the same text of some words"), (3, "the same text of some words"), (3, "something else with other words"), (9, None), (9, None), (4, "")]
    docs = documents(spark, rows)
    kept = keep_one(docs, words=5, percent=80)
    assert kept.schema == docs.schema and set(CLASHING) <= set(kept.columns)
    assert sorted((r["doc_id"], str(r["text"])) for r in kept.collect()) == [
        (3, "something else with other words"), (3, "the same text of some words"), (4, ""), (9, "None"), (9, "None"),
    ]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert near_duplicates(docs).collect() == [] and keep_one(docs).collect() == []


def test_matrix_and_pairwise_comparison_agree():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(30)]
    whole = stars(sets, np.arange(30), 55)
    root = list(range(30))
    for _ in range(30):
        for i in range(30):
            for j in range(30):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 55 * (len(sets[i]) + len(sets[j]) - common):
                    root[i] = root[j] = min(root[i], root[j])
    assert whole.tolist() == root
