import pytest
from helpers import CLASHING, documents, prose, seeded, without_lines

from stockledger.llm.line_dedup import dedup_lines


def case():
    rng = seeded()
    base = [prose(rng, rng.randrange(5, 14), 30) for _ in range(30)]

    def edited(line):
        w = line.split()
        i = rng.randrange(len(w))
        return " ".join(rng.choice([w[:i] + w[i + 1:], [*w[:i], "new", *w[i:]], [*w[:i], "other", *w[i + 1:]], w[::-1], [*w[:i], *w[i + 1:], w[i]]]))

    texts = []
    for _ in range(60):
        lines = [rng.choice([rng.choice(base), edited(rng.choice(base)), edited(edited(rng.choice(base))), prose(rng, 9, 500), "short line", ""]) for _ in range(rng.randrange(1, 9))]
        texts.append("\n".join(lines))
    numbered = "\n".join(f"this is page {i} of the book" for i in range(200))  # one group of alike lines
    spaced = "tabs\tand  spaces \x0b make the same words\n tabs and spaces make the same words"
    return [*texts, None, "", "\n\n", numbered, numbered, spaced, "a a b a a b a\na b a a b a", "x " * 6000, "x " * 5999 + "y"]


def test_against_brute_force(spark):
    texts = case()
    docs = documents(spark, texts)
    kept = dedup_lines(docs)
    # columns of the same names are replaced, all others stay
    assert set(docs.columns) | {"n_lines", "n_removed"} == set(kept.columns) and set(CLASHING) <= set(kept.columns)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in kept.collect()}
    want = without_lines(list(enumerate(texts)))
    assert {i: g for i, g in got.items() if g != want[i]} == {}
    assert len(got) == len(texts)


def test_repeated_rows_and_ids(spark):
    line, other = "one two three four five six", "six five four three two one zero"
    rows = [(1, line), (1, line), (1, other), (2, line + "\n" + other + "\nnew words in this line here")]
    got = sorted((r["doc_id"], r["n_removed"], r["text"]) for r in dedup_lines(documents(spark, rows)).collect())
    assert got == sorted([(1, 0, line), (1, 0, line), (1, 0, other), (2, 2, "new words in this line here")])


@pytest.mark.parametrize("texts", [[], [None], [""]])
def test_nothing_to_do(spark, texts):
    assert [r["text"] for r in dedup_lines(documents(spark, texts)).collect()] == texts
