"""Language-model scoring by cross-entropy difference (operator 8).

Two bigram models over words, one of the target documents and one of all
documents (the background), share one vocabulary: every word of the corpus and
a symbol for a text's begin. Both are smoothed alike, towards their own word
frequencies. A document's score is the mean over its tokens of loss under the
target model minus loss under the background model: the lower, the nearer the
target.

The ``most`` frequent words' counts are sent to the executors. Documents are
dealt to steps of bounded size. A step asks once for every different pair and
every less frequent word of its texts, sending its own count of each; a bucket,
one range of the hashes, adds up what all steps counted and answers each, in the
order in which it asked, with what the others counted. The texts meet the answers of their step in the shuffle
that made the steps, so neither a table of all pairs nor a row a token is ever
written, and however frequent a pair, a bucket gets one count a step.

With ``bits``, the vocabulary is cut to the 2**bits - 2 most frequent words and
one symbol for every other word, a smaller model: texts are written once as
symbols, and the pair counts (at most vocabulary squared) are sent to the
executors as two tables of four-byte losses.

Words and pairs go by 64 bits of their hashes, texts by 64 bits of their words.

Defined results: null, empty or blank text has no tokens, no losses and no
score; repeated rows count and are scored each; without target documents the
target model is uniform. A document is a target if any label row of its id
says so. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.common import U64, WordHasher, mix, release_memory, released, text_steps, written
from stockledger.operators.joins import fits_broadcast, maybe_broadcast

#: Words after which a task sends on what it has counted.
_FLUSH = 4_000_000
#: Words of a step, and pairs and words of a bucket, about; they bound a Python worker's memory.
_STEP, _BUCKET = 1 << 19, 1 << 20
#: Symbol before a text's first word, and the multiplier that tells a pair's words apart.
_BEGIN, _ORDER = U64(0x5851F42D4C957F2D), U64(0x9E3779B97F4A7C15)
#: In a pair's second place: the first word as a token, and as a word that another follows.
_TOKEN, _CONTEXT = U64(0x14057B7EF767814F), U64(0x2545F4914F6CDD1D)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over all texts of ``rows(id, text)``; words as 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

        with np.errstate(over="ignore"):
            for batch in batches:
                for _, _, data, bounds in text_steps(batch.column(0)):
                    held.append(hasher.words(data, bounds)[0])
                    size += len(held[-1])
                    if size >= _FLUSH:
                        yield counted()
                        held, size = [], 0
            if size:
                yield counted()

    return rows.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encoded(rows: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(id, symbols, target): each text's words as 16-bit numbers; 0 is any word outside the sorted ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        known = vocabulary if len(vocabulary) else np.zeros(1, U64)
        with np.errstate(over="ignore"):
            for batch in batches:
                for lo, hi, data, bounds in text_steps(batch.column(1)):
                    word, _, _, first = hasher.words(data, bounds)
                    at = np.minimum(np.searchsorted(known, word), len(known) - 1)
                    symbol = np.where((known[at] == word) & (len(vocabulary) > 0), at + 1, 0).astype("<u2").tobytes()
                    texts = [symbol[2 * a: 2 * b] for a, b in zip(first[:-1], first[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(texts, pa.binary()), batch.column(2).slice(lo, hi - lo)], names=["id", "symbols", "target"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, symbols binary, target boolean")


def _pairs(symbols: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (previous symbol, symbol) of all texts and the number of tokens before each text and the end."""
    texts = symbols.to_pylist()
    ends = np.cumsum([0, *(len(t) // 2 for t in texts)])
    now = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[ends[:-1][np.diff(ends) > 0]] = (1 << bits) - 1
    return before << bits | now, ends


def pair_counts(texts: DataFrame, bits: int) -> DataFrame:
    """(code, target, background) over ``texts(symbols, target)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, 1 << 2 * bits), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                code, ends = _pairs(part.column(0), bits)
                if not len(code):
                    continue
                target = np.repeat(part.column(1).to_numpy(zero_copy_only=False), np.diff(ends))
                for row, some in ((0, code[target]), (1, code)):
                    at, n = np.unique(some, return_counts=True)
                    table[row, at] += n
        at = np.flatnonzero(table[1])
        for lo in range(0, len(at), 1 << 18):
            some = at[lo: lo + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(table[0, some]), pa.array(table[1, some])], names=["code", "target", "background"])

    made = texts.select("symbols", "target").mapInArrow(run, "code long, target long, background long")
    return made.groupBy("code").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def losses(code: np.ndarray, count: np.ndarray, bits: int, prior: float) -> np.ndarray:
    """-log2 P(symbol | previous symbol) for every code, as a flat table.

    P(v | u) = (c(u, v) + prior * P(v)) / (c(u) + prior) with P(v) = (c(v) + 1) / (N + V).
    """
    size = 1 << bits
    table = np.zeros((size, size), np.float32)
    table.reshape(-1)[code] = count
    single = np.bincount(code & (size - 1), weights=count, minlength=size)
    context = np.bincount(code >> bits, weights=count, minlength=size)
    share = (single + 1) / (single.sum() + size)
    table += (prior * share).astype(np.float32)
    table /= (context + prior).astype(np.float32)[:, None]
    np.log2(table, out=table)
    return np.negative(table, out=table).reshape(-1)


def _flagged(docs: DataFrame, targets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, target); null text as empty."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    wanted = targets.select(F.col(id_col).alias("id"), F.lit(True).alias("target")).where(F.col("id").isNotNull()).distinct()
    return rows.join(maybe_broadcast(wanted, fits_broadcast(wanted)), "id", "left").select("id", "text", F.coalesce("target", F.lit(False)).alias("target"))


def _code(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(u * _ORDER + v)


def _word_pairs(hasher: WordHasher, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, word before, word) of every token and the number of tokens before each text and the end."""
    word, _, _, first = hasher.words(data, bounds)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[first[:-1][np.diff(first) > 0]] = _BEGIN
    return _code(before, word), before, word, first


def _tally(codes: np.ndarray, *subsets: np.ndarray) -> list[np.ndarray]:
    """The different codes, sorted, and how often each stands in all and in every subset, a mask."""
    code, n = np.unique(codes, return_counts=True)
    out = [code, n]
    for some in subsets:
        own, m = np.unique(codes[some], return_counts=True)
        out.append(np.zeros(len(code), np.int64))
        out[-1][np.searchsorted(code, own)] = m
    return out


def word_totals(rows: DataFrame) -> DataFrame:
    """(word, t, b, tl, bl): how often a word stands in target texts and in all of ``rows(text, target)``, and as their last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            words, target, last = (np.concatenate(x) for x in zip(*held, strict=True))
            word, *counts = _tally(words, target, target & last, last)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), *map(pa.array, counts)], names=["word", "b", "t", "tl", "bl"])

        with np.errstate(over="ignore"):
            for batch in batches:
                for lo, hi, data, bounds in text_steps(batch.column(0)):
                    word, _, _, first = hasher.words(data, bounds)
                    last = np.zeros(len(word), bool)
                    last[first[1:][np.diff(first) > 0] - 1] = True
                    target = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                    held.append((word, np.repeat(target, np.diff(first)), last))
                    size += len(word)
                    if size >= _FLUSH:
                        yield counted()
                        held, size = [], 0
            if size:
                yield counted()

    made = rows.select("text", "target").mapInArrow(released(run), "word long, b long, t long, tl long, bl long")
    return made.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("t", "b", "tl", "bl")))


def _planes(values: np.ndarray) -> bytes:
    """64-bit values with their first bytes first, then all second ones: bytes that are nearly all alike compress to nothing."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view(np.int64).reshape(-1)


class _Step:
    """A step's texts as pairs and words: the codes it asks for and, once they are answered, every token's counts."""

    def __init__(self, texts: pa.Table, frequent: np.ndarray):
        hasher = WordHasher()
        parts = []
        for _, _, data, bounds in text_steps(texts.column("text")):
            pair, _, word, first = _word_pairs(hasher, data, bounds)
            parts.append((pair, word, np.diff(first)))
        pair, word, self.lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        begin = np.append(0, np.cumsum(self.lengths)[:-1])[self.lengths > 0]
        at = np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)
        known = frequent[at] == word

        def before(of: np.ndarray, first) -> np.ndarray:
            out = np.roll(of, 1)
            out[begin] = first
            return out

        #: Of every token and of its predecessor: the place among the frequent words, and whether it is one.
        self.known = (at, known), (before(at, np.searchsorted(frequent, _BEGIN)), before(known, True))
        rare = [~x for _, x in self.known]
        self.codes = np.concatenate([pair, _code(word[rare[0]], _TOKEN), _code(before(word, _BEGIN)[rare[1]], _CONTEXT)])
        self.ends = np.cumsum([len(pair), *map(np.count_nonzero, rare)])
        target = np.repeat(texts.column("target").to_numpy(), self.lengths)
        self.code, self.b, self.t = _tally(self.codes, np.concatenate([target, *(target[x] for x in rare)]))

    def counts(self, total: np.ndarray, place: np.ndarray, *tables: np.ndarray) -> list[np.ndarray]:
        """Of every token: how often its pair, it and its predecessor stand, by ``total`` of the codes and the frequent words' counts."""
        own = np.split(total[place], self.ends[:-1])
        out = [own[0]]
        for (at, known), table, rest in zip(self.known, tables, own[1:], strict=True):
            out.append(table[at])
            out[-1][~known] = rest
        return out


def _most_frequent(words: DataFrame, most: int) -> DataFrame:
    """Whole classes of about equal count, the most frequent words' first: at most ``most`` rows in all."""
    level = F.floor(F.log2("b") * 8)
    least, held = None, 0
    for r in sorted(words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["level"]):
        held += r["n"]
        if held > most:
            break
        least = r["level"]
    return words.where(F.lit(False) if least is None else level >= least)


def _score_all(rows: DataFrame, prior: float, most: int) -> DataFrame:
    """(id, n_tokens, is_target, loss_target, loss_background) over the whole vocabulary."""
    words = written(word_totals(rows), "words")
    total = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("t", "b", "tl", "bl")), F.count(F.lit(1)).alias("size")).first()
    known = _most_frequent(words, most).toArrow()
    word, t, b, tl, bl = (known.column(c).to_numpy() for c in ("word", "t", "b", "tl", "bl"))
    # a text's begin is looked up as a word too: one for every last word
    word = np.append(word.view(U64), _BEGIN)
    order = np.argsort(word)
    tables = [(np.append(n, 0)[order], np.append(n - last, total[f"{side}l"])[order]) for side, n, last in (("t", t, tl), ("b", b, bl))]
    frequent = rows.sparkSession.sparkContext.broadcast((word[order], tables))
    steps, buckets = total["b"] // _STEP + 1, total["b"] // _BUCKET + 1
    texts = rows.withColumn("step", F.pmod(F.xxhash64("id", "text"), F.lit(steps)))

    def ask(group: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            step = _Step(group, frequent.value[0])
        bucket = ((step.code >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
        ends = np.searchsorted(bucket, np.arange(buckets + 1))
        asked = [(i, lo, hi) for i, (lo, hi) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if hi > lo]
        columns = [_planes(np.diff(step.code[lo:hi], prepend=U64(0))) for _, lo, hi in asked], *([_planes(n[lo:hi]) for _, lo, hi in asked] for n in (step.t, step.b))
        number = pa.array([group.column("step")[0].as_py()] * len(asked), pa.int64())
        return pa.table([number, pa.array([i for i, _, _ in asked], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], names=["step", "bucket", "code", "t", "b"])

    def answer(group: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            codes = [np.cumsum(_values(c.as_py()).view(U64), dtype=U64) for c in group.column("code")]
        code = np.unique(np.concatenate(codes))
        places = [np.searchsorted(code, c) for c in codes]
        columns = []
        for name in ("t", "b"):
            counts = [_values(n.as_py()) for n in group.column(name)]
            total = np.zeros(len(code), np.int64)
            for place, n in zip(places, counts, strict=True):
                total[place] += n
            columns.append(pa.array([_planes(total[place] - n) for place, n in zip(places, counts, strict=True)], pa.binary()))
        return pa.table([group.column("step"), group.column("bucket"), *columns], names=["step", "bucket", "t", "b"])

    def scored(group: pa.Table, answers: pa.Table) -> pa.Table:
        codes, tables = frequent.value
        with np.errstate(over="ignore"):
            step = _Step(group, codes)
        place = np.searchsorted(step.code, step.codes)
        text = np.repeat(np.arange(group.num_rows), step.lengths)
        answers = answers.sort_by("bucket")
        columns = []
        for side, own, (token, context) in zip(("t", "b"), (step.t, step.b), tables, strict=True):
            others = np.concatenate([np.zeros(0, np.int64), *(_values(n.as_py()) for n in answers.column(side))])
            assert len(others) == len(own)
            pair, single, before = step.counts(own + others, place, token, context)
            share = (single + 1) / float(total[side] + total["size"])
            loss = -np.log2((pair + prior * share) / (before + prior))
            columns.append(pa.array(np.bincount(text, weights=loss, minlength=group.num_rows) / np.maximum(step.lengths, 1), mask=step.lengths == 0))
        return pa.table([group.column("id"), pa.array(step.lengths.astype(np.int64)), group.column("target"), *columns], names=["id", "n_tokens", "is_target", "loss_target", "loss_background"])

    def freed(of, *tables: pa.Table) -> pa.Table:
        out = of(*tables)
        release_memory()
        return out

    asked = texts.groupBy("step").applyInArrow(lambda group: freed(ask, group), "step long, bucket long, code binary, t binary, b binary")
    answers = asked.groupBy("bucket").applyInArrow(lambda group: freed(answer, group), "step long, bucket long, t binary, b binary")
    both = texts.groupBy("step").cogroup(answers.groupBy("step"))
    return both.applyInArrow(lambda group, answers: freed(scored, group, answers), f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, is_target boolean, loss_target double, loss_background double")


def score(
    docs: DataFrame, targets: DataFrame, *, bits: int | None = None, prior: float = 50.0, most: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_tokens, is_target, loss_target, loss_background (bits a token) and score, their difference.

    ``targets`` holds the ids of the target documents in ``id_col``. Every word
    is a symbol of its own; with ``bits``, the vocabulary is cut to 2**bits
    symbols. ``most`` words are looked up without a shuffle; it changes no result.
    """
    rows = _flagged(docs, targets, id_col, text_col)
    out = _score_all(rows, prior, most) if bits is None else _score_cut(rows, bits, prior)
    return out.select(F.col("id").alias(id_col), "n_tokens", "is_target", "loss_target", "loss_background", (F.col("loss_target") - F.col("loss_background")).alias("score"))


def _score_cut(rows: DataFrame, bits: int, prior: float) -> DataFrame:
    """The same over a vocabulary of 2**bits symbols."""
    top = word_counts(rows).orderBy(F.desc("n"), "word").limit((1 << bits) - 2).select("word").collect()
    vocabulary = np.sort(np.array([r["word"] for r in top], np.int64).view(U64))
    texts = encoded(rows, vocabulary)
    texts = written(texts, "symbols")
    counts = pair_counts(texts, bits).toArrow()  # at most 4**bits rows
    code = counts.column("code").to_numpy()
    tables = texts.sparkSession.sparkContext.broadcast(
        [losses(code, counts.column(name).to_numpy().astype(np.float64), bits, prior) for name in ("target", "background")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                pair, ends = _pairs(part.column(1), bits)
                n = np.diff(ends)
                columns = []
                for table in tables.value:
                    total = np.zeros(len(n))
                    if len(pair):
                        total[n > 0] = np.add.reduceat(table[pair], ends[:-1][n > 0], dtype=np.float64)
                    columns.append(pa.array(total / np.maximum(n, 1), mask=n == 0))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), part.column(2), *columns], names=["id", "n_tokens", "is_target", "loss_target", "loss_background"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, n_tokens long, is_target boolean, loss_target double, loss_background double")
