"""Fixtures and brute-force versions the operator tests share."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ("id", "version", "line", "words", "n", "label", "cls", "tokens", "kept", "start", "length", "salt", "key", "pos", "term", "n_lines", "score")

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, clash=True):
    """documents from (doc_id, text) pairs or texts, with columns of clashing names."""
    from pyspark.sql import functions as F

    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clash else df


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def space_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(UPPER)) if w]


def shingles(text, n):
    w = space_words(text)
    if not w:
        return frozenset()
    return frozenset(zip(*(w[i:] for i in range(n)), strict=False)) if len(w) >= n else frozenset([tuple(w)])


class Groups(dict):
    def top(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self[max(a, b)] = min(a, b)


def near_components(docs, n, percent):
    """{id: component} over all pairs of (id, text)."""
    sets = [(i, shingles(t, n)) for i, t in docs]
    groups = Groups({i: i for i, _ in docs})
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
    return {i: groups.top(i) for i, _ in docs}


def one_edit(a, b):
    """Whether two different word lists are one insertion, deletion or substitution apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def line_words(line):
    return [w for w in re.split("[ \t\x0b\f\r]+", line) if w]


def without_lines(docs, min_words=5):
    """{id: (lines, removed, text)} by comparing every line with every earlier one."""
    seen, out = [], {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        if text is None:
            out[i] = (0, 0, None)
            continue
        lines, stay = text.split("\n"), []
        for line in lines:
            w = line_words(line)
            if len(w) < min_words:
                stay.append(line)
                continue
            if not any(w == s or one_edit(w, s) for s in seen):
                stay.append(line)
            seen.append(w)
        out[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def benchmark_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def contaminated(text, items, window=13, share=20):
    """(n_words, n_hit, item ids, contaminated) of one text."""
    words = benchmark_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        w = benchmark_words(item_text)
        if not w:
            continue
        n = min(window, len(w))
        wins = {tuple(w[s: s + n]) for s in range(len(w) - n + 1)}
        for s in range(len(words) - n + 1):
            if tuple(words[s: s + n]) in wins:
                hit |= set(range(s, s + n))
                found.add(item)
    return len(words), len(hit), found, bool(hit) and share * len(hit) >= len(words)


def control_texts(rng, n):
    parts = ["<|im_start|>", "<|im_end|>", "<|", "|>", "<\\|", "<\\\\|", "\\", "\n", "<|image|>", "assistant", "é", "🙂", " ", "<", "|"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 9))) for _ in range(n)]


def seeded(n=7):
    return random.Random(n)
