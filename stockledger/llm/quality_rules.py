"""Operator 13, quality rules by distribution divergence.

Two kinds of rule judge a document. The base rules are counts of its own text:
too few words, or too many words in 8-word windows that stand twice or more in
it. The divergence rules compare two histograms of the document, of its
character classes and of its language's common words, with the same histograms
of the whole language, by the Jensen-Shannon distance (the square root of the
divergence in bits, 0 to 1). A histogram of few characters or words says
little, so each rule has a minimum length under which it does not judge, and
the divergence that a sample of that length shows by chance alone,
``(bins - 1) / (8 n ln 2)``, is taken off first.

A language's references are sums over all documents of that language which
pass the base rules. Its common words are all words that make up at least
``common_share`` of its words. They are found without counting every word of
the corpus: each task keeps ``COUNTERS`` counters a language (frequent-item
summaries, whose undercounts add up to at most one ``COUNTERS``-th of the
words), so a bounded list of candidates holds every common word, and the
second reading of the texts counts the candidates exactly.

A document is compared with its own language's reference, or with the nearest
one if its language is null or has none. Without any reference the divergence
rules do not judge.

Defined results: null and empty texts have no words and fail the base rules;
texts are read whole, one of many megabytes takes some hundred bytes of memory
per word in its task; repeated rows are judged one by one and count in the
references as often as they stand; equally near references: the first by name;
an empty table gives an empty result. Only the named columns of the input are
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.common import U64, WordHasher, lists, mix, seeds, text_steps, written

#: Character classes: lower-case, upper-case and digits of ASCII, the symbols below, other ASCII marks, white space, all beyond ASCII.
N_CLASSES, SYMBOL, SPACE, BEYOND = 7, 3, 5, 6
SYMBOLS = b"#*$%&|<>"
#: Counters a task keeps for each language; the candidates are at most 1 / (common_share - 1 / COUNTERS) a language.
COUNTERS = 1000
#: Words of a window whose repetition counts.
WINDOW = 8
#: More languages than this are refused: their references would be too many to hand to every task.
MAX_LANGUAGES = 10_000


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; distances are compared after the allowance for chance."""

    min_words: int = 20
    repeat_percent: int = 30
    common_share: float = 0.005
    judged_chars: int = 200
    judged_words: int = 50
    char_limit: float = 0.25
    word_limit: float = 0.25


def _byte_classes() -> np.ndarray:
    classes = np.full(256, 4, np.uint8)
    classes[ord("a"): ord("z") + 1] = 0
    classes[ord("A"): ord("Z") + 1] = 1
    classes[ord("0"): ord("9") + 1] = 2
    classes[list(SYMBOLS)] = SYMBOL
    classes[[0x20, *range(0x09, 0x0E)]] = SPACE
    classes[0xC0:] = BEYOND
    classes[0x80:0xC0] = N_CLASSES  # the rest of a character that began before
    return classes


@dataclass
class Measured:
    """Counts of a run of texts; ``terms`` are hashes of lower-case words of letters and digits, ``term_bounds`` their rows."""

    base: np.ndarray  # rows x (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
    classes: np.ndarray
    terms: np.ndarray
    term_bounds: np.ndarray
    failed: np.ndarray = field(init=False)

    def judge(self, rules: Rules) -> Measured:
        n_words, repeated = self.base[:, 0], self.base[:, 4]
        self.failed = (n_words < rules.min_words) | (100 * repeated > rules.repeat_percent * n_words)
        return self


class Measurer:
    def __init__(self) -> None:
        self.classes = _byte_classes()
        self.words = WordHasher(fold=False)
        beyond_words = bytes(b for b in range(0x80) if not (chr(b).isalnum()))
        self.terms = WordHasher(separators=beyond_words)
        self.weights = seeds(WINDOW, 13)

    def measure(self, data: np.ndarray, bounds: np.ndarray) -> Measured:
        rows = len(bounds) - 1
        row_of = np.repeat(np.arange(rows), np.diff(bounds))
        width = N_CLASSES + 1
        classes = np.bincount(row_of * width + self.classes[data], minlength=rows * width).reshape(rows, width)[:, :N_CLASSES]
        del row_of
        hashes, _, _, word_bounds = self.words.words(data, bounds)
        base = np.zeros((rows, 5), np.int64)
        base[:, 0] = np.diff(word_bounds)
        base[:, 1] = classes.sum(axis=1) - classes[:, SPACE]
        base[:, 2] = classes[:, SYMBOL]
        base[:, 3] = [self._repeated_lines(data[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        base[:, 4] = self._repeated_words(hashes, word_bounds)
        terms, _, _, term_bounds = self.terms.words(data, bounds)
        return Measured(base, classes, terms, term_bounds)

    @staticmethod
    def _repeated_lines(text: bytes) -> int:
        worded = [line for line in text.split(b"\n") if line and not line.isspace()]
        return len(worded) - len(set(worded))

    def _repeated_words(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text, the words inside windows that stand twice or more in it."""
        rows, n = len(bounds) - 1, len(hashes)
        if n < WINDOW:
            return np.zeros(rows, np.int64)
        row_of = np.repeat(np.arange(rows), np.diff(bounds))
        starts = np.flatnonzero(row_of[WINDOW - 1:] == row_of[: n - WINDOW + 1])
        windows = np.zeros(n - WINDOW + 1, U64)
        for i in range(WINDOW):
            windows += hashes[i: n - WINDOW + 1 + i] * self.weights[i]
        keys = mix(windows[starts] + mix(row_of[starts].astype(U64) + U64(1)))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        cover = np.zeros(n + 1, np.int64)
        at = starts[twice]
        cover[at] += 1
        np.subtract.at(cover, at + WINDOW, 1)
        covered = np.cumsum(cover[:n]) > 0
        return np.bincount(row_of[covered], minlength=rows)


class FrequentTerms:
    """Counters of the most frequent hashes; each is short by at most ``lost``, itself at most a share 1 / size of all that came."""

    def __init__(self, size: int) -> None:
        self.size, self.keys, self.counts, self.total = size, np.zeros(0, U64), np.zeros(0, np.int64), 0

    def add(self, hashes: np.ndarray) -> None:
        keys, counts = np.unique(hashes, return_counts=True)
        self.total += len(hashes)
        joined, back = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        sums = np.zeros(len(joined), np.int64)
        np.add.at(sums, back, np.concatenate([self.counts, counts]))
        if len(joined) > self.size:
            lost = np.partition(sums, len(sums) - self.size - 1)[len(sums) - self.size - 1]
            stay = sums > lost
            joined, sums = joined[stay], sums[stay] - lost
        self.keys, self.counts = joined, sums


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(U64).view(np.int64)


def common_candidates(rows: DataFrame, rules: Rules) -> np.ndarray:
    """Hashes that hold every common word of every language; ``rows`` has text and lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer, seen = Measurer(), {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for first, last, data, bounds in text_steps(batch.column(0)):
                m = measurer.measure(data, bounds).judge(rules)
                for lang in {x for x in langs[first:last] if x is not None}:
                    own = np.repeat((langs[first:last] == lang) & ~m.failed, np.diff(m.term_bounds))
                    if own.any():
                        seen.setdefault(lang, FrequentTerms(COUNTERS)).add(m.terms[own])
        for lang, found in seen.items():
            n = len(found.keys) + 1  # the last row: all words, without a term
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n), pa.array([*_signed(found.keys).tolist(), None], pa.int64()), pa.array([*found.counts.tolist(), found.total], pa.int64())],
                names=["lang", "term", "n"],
            )

    found = rows.mapInArrow(run, "lang string, term long, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    found = written(found, "common-terms")
    if found.where("term is null").count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    totals = found.where("term is null").select("lang", F.col("n").alias("total"))
    least = F.col("total") * F.lit(rules.common_share - 1 / COUNTERS)
    kept = found.where("term is not null").join(F.broadcast(totals), "lang").where(F.col("n") >= least)
    return np.sort(np.array([r["term"] for r in kept.select("term").distinct().collect()], np.int64).view(U64))


def measured(rows: DataFrame, candidates: np.ndarray, rules: Rules) -> DataFrame:
    """Per row: id, lang, the base counts, the classes and the counts of candidates that occur (sparse)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer()
        for batch in batches:
            for first, last, data, bounds in text_steps(batch.column(2)):
                m = measurer.measure(data, bounds).judge(rules)
                n = last - first
                row_of = np.repeat(np.arange(n), np.diff(m.term_bounds))
                at = np.searchsorted(candidates, m.terms)
                at[at == len(candidates)] = 0
                known = candidates[at] == m.terms if len(candidates) else np.zeros(len(m.terms), bool)
                cells, counts = np.unique(row_of[known] * max(1, len(candidates)) + at[known], return_counts=True)
                held, which = np.divmod(cells, max(1, len(candidates)))
                ends = np.searchsorted(held, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                        *(pa.array(m.base[:, i]) for i in range(5)), pa.array(m.failed),
                        lists(m.classes.astype(np.int64).ravel(), np.arange(n + 1) * N_CLASSES), pa.array(np.diff(m.term_bounds).astype(np.int64)),
                        lists(which.astype(np.int32), ends), lists(counts.astype(np.int64), ends),
                    ],
                    names=["id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "classes", "n_terms", "which", "counts"],
                )

    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, classes array<long>, n_terms long, which array<int>, counts array<long>"
    )
    return rows.mapInArrow(run, schema)


@dataclass
class Reference:
    """Shares of a language: its character classes, its common words (places in the candidates) and, last, all other words."""

    name: str
    classes: np.ndarray
    common: np.ndarray
    shares: np.ndarray


def references(counted: DataFrame, rules: Rules) -> list[Reference]:
    """One reference a language that has words, from all its documents that pass the base rules; bounded by languages x candidates."""
    own = counted.where("lang is not null and not base_failed")
    sums = {
        r["lang"]: r for r in own.groupBy("lang").agg(
            F.sum("n_terms").alias("total"), *(F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(N_CLASSES))
        ).collect()
    }
    words: dict[str, list] = {}
    each = own.select("lang", F.explode(F.arrays_zip("which", "counts")).alias("w"))
    for r in each.groupBy("lang", "w.which").agg(F.sum("w.counts").alias("n")).collect():
        if r["n"] >= rules.common_share * sums[r["lang"]]["total"]:
            words.setdefault(r["lang"], []).append((r["which"], r["n"]))
    made = []
    for lang in sorted(sums):
        total, classes = sums[lang]["total"], np.array([sums[lang][f"c{i}"] for i in range(N_CLASSES)], float)
        common = np.array(sorted(words.get(lang, [])), np.int64).reshape(-1, 2)
        if not total:
            continue
        shares = np.append(common[:, 1], total - common[:, 1].sum()) / total
        made.append(Reference(lang, classes / classes.sum(), common[:, 0], shares))
    return made


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of each row of ``p`` from ``q``."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=1)
    return np.maximum((left + right) / 2, 0)


def distances(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row's histogram, less what chance explains at its size."""
    n = np.maximum(counts.sum(axis=1), 1)
    chance = (len(shares) - 1) / (8 * n * np.log(2))
    return np.sqrt(np.maximum(divergence(counts / n[:, None], shares) - chance, 0))


def judged(counted: DataFrame, refs: list[Reference], n_candidates: int, rules: Rules) -> DataFrame:
    """``counted`` with the reference used, both distances (null where not judged) and the verdict."""
    names = {r.name: i for i, r in enumerate(refs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                col = {n: batch.column(n) for n in batch.schema.names}
                rows = batch.num_rows
                classes = np.array(col["classes"].flatten()).reshape(rows, N_CLASSES).astype(float)
                per_row = np.diff(np.array(col["which"].offsets))
                words = np.zeros((rows, n_candidates + 1))
                words[np.repeat(np.arange(rows), per_row), np.array(col["which"].flatten())] = np.array(col["counts"].flatten())
                n_terms = np.array(col["n_terms"]).astype(float)
                own = np.array([names.get(x, -1) for x in col["lang"].to_pylist()])
                by_char, by_word = np.full((len(refs), rows), np.inf), np.full((len(refs), rows), np.inf)
                for i, ref in enumerate(refs):
                    use = (own == i) | (own == -1)
                    if use.any():
                        common = words[use][:, ref.common]
                        by_char[i, use] = distances(classes[use], ref.classes)
                        by_word[i, use] = distances(np.column_stack([common, n_terms[use] - common.sum(axis=1)]), ref.shares)
                if refs:
                    nearest = np.argmin(by_char + by_word, axis=0)
                    char, word = by_char[nearest, np.arange(rows)], by_word[nearest, np.arange(rows)]
                else:
                    nearest, char, word = np.zeros(rows, int), np.zeros(rows), np.zeros(rows)
                no_char = (classes.sum(axis=1) < rules.judged_chars) | (not refs)
                no_word = (n_terms < rules.judged_words) | (not refs)
                failed = np.array(col["base_failed"])
                kept = ~failed & (no_char | (char <= rules.char_limit)) & (no_word | (word <= rules.word_limit))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(col[n] for n in ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
                        pa.array(kept), pa.array([refs[i].name for i in nearest] if refs else [None] * rows, pa.string()),
                        pa.array(char, mask=no_char), pa.array(word, mask=no_word),
                    ],
                    names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reference", "char_distance", "word_distance"],
                )

    schema = (
        f"id {counted.schema['id'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, reference string, char_distance double, word_distance double"
    )
    return counted.mapInArrow(run, schema)


def apply_rules(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: its id, the base counts, ``base_failed``, ``kept``, the reference used and both distances."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    candidates = common_candidates(texts.select("text", "lang"), rules)
    counted = written(measured(texts, candidates, rules), "measured")
    refs = references(counted, rules)
    return judged(counted, refs, len(candidates), rules).withColumnRenamed("id", id_col)
