"""Operator 11, periodic run detection by recompression.

A run is a stretch of consecutive words of one text with smallest period ``q``
(words ``q`` apart are the same), at least ``min_exponent`` periods and
``min_length`` words long, which no neighbouring word extends keeping ``q``.

Texts are turned into word numbers, and the numbers of many texts, kept apart
by marks that occur once, into one run-length grammar by recompression:
alternately every block of equal symbols becomes one symbol, and, with the
symbols split into a left and a right half at random, every pair of a left
symbol followed by a right one. Equal stretches thus get equal symbols but for
a few at their ends, so an extension query (how far do the words from two
places on, or before them, agree?) climbs and descends the grammar in a
logarithmic number of steps, whole blocks at once. No suffix array is built.

Candidates come from a harmonic grid: where a run of period ``q`` is, words
``q`` apart agree over at least ``(min_exponent - 1) q`` words, so places
``(min_exponent - 2) q`` apart suffice to meet it, and from such a place some
following words must agree too. All (period, place) pairs of a text of ``n``
words are about ``n log n`` comparisons of numbers; only the pairs that agree
are extended, exactly, to both sides. A stretch found under several periods
keeps the smallest, which divides the others. Texts without a candidate have
no run and need no grammar.

Every text is whole in one task, nothing is shuffled. Defined results: null
and empty texts have no words, no run and an empty collapsed text; a text of
many megabytes takes about two hundred bytes of memory per word in its task; repeated
rows are treated one by one; runs that overlap are all returned, by start,
then period; an empty table gives an empty result. Only the named columns of
the input are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.common import U64, mix, seeds, text_steps

#: (place, period) pairs and extension queries handled at once; bounds a worker's memory.
AT_ONCE = 1 << 18


def _numbered(values: np.ndarray) -> tuple[int, np.ndarray]:
    distinct, number = np.unique(values, return_inverse=True)
    return len(distinct), number


class Grammar:
    """Run-length grammar of a sequence whose first ``marks`` symbols occur once and are never merged.

    Nodes of all levels lie in one array, level by level from the sequence up;
    a node's neighbours on its level are the next places. ``ahead`` and
    ``behind`` count the equal nodes of its block from it to either end.
    """

    def __init__(self, sequence: np.ndarray, marks: int):
        symbol = sequence.astype(np.int64)
        width = np.ones(len(symbol), np.int64)
        fresh = int(symbol.max(initial=0)) + 1
        symbols, widths, parents, firsts, lasts, ahead, behind = [symbol], [width], [], [np.full(len(symbol), -1)], [np.full(len(symbol), -1)], [], []
        base, round_ = 0, 0
        while len(symbol) > 2 * marks - 1:  # until every text is one symbol
            for step in (self._blocks, self._pairs):
                head, upper, made = step(symbol, marks, fresh, round_)
                if len(head) == len(symbol):
                    continue
                size = np.diff(np.append(head, len(symbol)))
                parent = np.repeat(np.arange(len(head)), size)
                place = np.arange(len(symbol)) - head[parent]
                equal = step == self._blocks
                ahead.append(size[parent] - place if equal else np.ones(len(symbol), np.int64))
                behind.append(place + 1 if equal else np.ones(len(symbol), np.int64))
                parents.append(base + len(symbol) + parent)
                firsts.append(base + head)
                lasts.append(base + head + size - 1)
                width = np.add.reduceat(width, head)
                base += len(symbol)
                symbol, fresh = upper, fresh + made
                symbols.append(symbol)
                widths.append(width)
            round_ += 1
        top = len(symbol)
        self.symbol, self.width = np.concatenate(symbols), np.concatenate(widths)
        self.parent = np.concatenate([*parents, np.full(top, -1)])
        self.first, self.last = np.concatenate(firsts), np.concatenate(lasts)
        self.ahead, self.behind = (np.concatenate([*x, np.ones(top, np.int64)]) for x in (ahead, behind))

    @staticmethod
    def _blocks(symbol: np.ndarray, marks: int, fresh: int, round_: int):
        head = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        size = np.diff(np.append(head, len(symbol)))
        upper = symbol[head]
        long = size > 1
        made, number = _numbered(upper[long] * (len(symbol) + 1) + size[long])
        upper[long] = fresh + number
        return head, upper, made

    @staticmethod
    def _pairs(symbol: np.ndarray, marks: int, fresh: int, round_: int):
        side = (mix(symbol.astype(U64) * seeds(1, round_)) >> U64(63)).astype(np.int8)
        side[symbol < marks] = 2
        merged = np.flatnonzero((side[:-1] == 0) & (side[1:] == 1))
        made, number = _numbered(symbol[merged] * fresh + symbol[merged + 1])
        stay = np.ones(len(symbol), bool)
        stay[merged + 1] = False
        upper = symbol.copy()
        upper[merged] = fresh + number
        return np.flatnonzero(stay), upper[stay], made

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from places ``a`` and ``b`` (different) on, or from them backwards."""
        edge, equals, way = (self.last, self.behind, -1) if back else (self.first, self.ahead, 1)
        total = np.zeros(len(a), np.int64)
        who, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        while len(who):
            same = self.symbol[x] == self.symbol[y]
            up_x, up_y = self.parent[x], self.parent[y]
            climb = same & (up_x >= 0) & (up_y >= 0) & (edge[up_x] == x) & (edge[up_y] == y)
            climb[climb] = self.symbol[up_x[climb]] == self.symbol[up_y[climb]]
            pass_ = same & ~climb
            steps = np.minimum(equals[x[pass_]], equals[y[pass_]])
            total[who[pass_]] += steps * self.width[x[pass_]]
            next_x, next_y = np.where(climb, up_x, edge[x]), np.where(climb, up_y, edge[y])
            next_x[pass_], next_y[pass_] = x[pass_] + way * steps, y[pass_] + way * steps
            going = next_x >= 0  # unequal symbols of the sequence itself have no children
            who, x, y = who[going], next_x[going], next_y[going]
        return total


def candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place in the text) whose words agree a period apart, over all periods and grid places, in bounded steps."""
    periods = np.where(sizes >= max(min_length, min_exponent), sizes // min_exponent, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    agreeing = np.maximum(min_length, min_exponent * period) - period  # words that agree a period apart in any run
    apart = np.maximum(1, (min_exponent - 2) * period) if min_exponent > 2 else np.minimum(period, agreeing)
    sure = np.minimum(4, agreeing - apart + 1)  # agreeing words from a grid place on
    places = np.maximum((sizes[text] - period - sure) // apart + 1, 0)
    ends = np.cumsum(places)
    at = 0
    while at < len(text):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        group = np.repeat(np.arange(at, stop), places[at:stop])
        place = (np.arange(len(group)) - (ends[group] - places[group] - (ends[at - 1] if at else 0))) * apart[group]
        for k in range(4):
            tested = sure[group] > k
            here = starts[text[group[tested]]] + place[tested] + k
            stay = ~tested
            stay[tested] = words[here] == words[here + period[group[tested]]]
            group, place = group[stay], place[stay]
        if len(group):
            yield text[group], period[group], place
        at = stop


def runs(words: np.ndarray, sizes: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """All runs of texts given as word numbers one after another: rows (text, start, period, length), in that order."""
    starts = np.cumsum(sizes) - sizes
    found, grammar = [], None
    for text, period, place in candidates(words, starts, sizes, min_length, min_exponent):
        if grammar is None:
            held = _texts_with_candidates(words, starts, sizes, min_length, min_exponent)
            grammar, shift = _grammar_of(words, starts, sizes, held)
        for i in range(0, len(text), AT_ONCE):
            t, q, p = text[i: i + AT_ONCE], period[i: i + AT_ONCE], place[i: i + AT_ONCE]
            here = shift[t] + p
            before = grammar.extend(here - 1, here + q - 1, back=True)
            length = before + grammar.extend(here, here + q) + q
            rows = np.column_stack([t, p - before, length, q])[length >= np.maximum(min_length, min_exponent * q)]
            found.append(np.unique(rows, axis=0))
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[smallest][:, [0, 1, 3, 2]]
    return rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]


def _texts_with_candidates(words, starts, sizes, min_length, min_exponent) -> np.ndarray:
    held = np.zeros(len(sizes), bool)
    for text, _, _ in candidates(words, starts, sizes, min_length, min_exponent):
        held[text] = True
    return np.flatnonzero(held)


def _grammar_of(words, starts, sizes, held) -> tuple[Grammar, np.ndarray]:
    """The grammar of the ``held`` texts, and each text's first place in it."""
    marks = len(held) + 1
    own = sizes[held]
    shift = np.zeros(len(sizes), np.int64)
    shift[held] = np.cumsum(own) - own + np.arange(1, marks)
    sequence = np.empty(int(own.sum()) + marks, np.int64)
    at_mark = np.append(shift[held] - 1, len(sequence) - 1)
    sequence[at_mark] = np.arange(marks)
    inside = np.repeat(starts[held] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
    stay = np.ones(len(sequence), bool)
    stay[at_mark] = False
    sequence[stay] = words[inside] + marks
    return Grammar(sequence, marks), shift


def dropped_words(found: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Which words any run contains after its first period; bounds: ``n`` words, texts from ``starts`` on."""
    cover = np.zeros(n + 1, np.int64)
    at = starts[found[:, 0]] + found[:, 1]
    np.add.at(cover, at + found[:, 2], 1)
    np.subtract.at(cover, at + found[:, 3], 1)
    return np.cumsum(cover[:n]) > 0


def collapse_runs(
    docs: DataFrame,
    *,
    min_length: int = 6,
    min_exponent: int = 4,
    rewrite: Callable[[object, int], np.ndarray | None] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: its id, ``n_words``, its ``runs`` and its ``collapsed`` text.

    ``runs`` is an array of (start, length, period), by start, then period;
    ``collapsed`` holds the words that no run repeats, one space apart. Words
    are runs of characters other than ASCII white space. ``rewrite(id, n)``
    may give, for a text of ``n`` words, the word numbers to read instead.
    """
    if min_exponent < 2 or min_length < min_exponent:
        raise ValueError("a run has two periods at least, and as many words as periods")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_steps(batch.column(1)):
                ids = batch.column(0).slice(first, last - first)
                numbers: defaultdict[bytes, int] = defaultdict()
                numbers.default_factory = numbers.__len__
                texts, parts = [], []
                for key, a, b in zip(ids.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    text = data[a:b].tobytes().split()
                    order = rewrite(key, len(text)) if rewrite else None
                    if order is not None:
                        text = [text[i] for i in order.tolist()]
                    texts.append(text)
                    parts.append(np.fromiter(map(numbers.__getitem__, text), np.int64, len(text)))
                sizes = np.array([len(t) for t in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                words = np.concatenate(parts)
                found = runs(words, sizes, min_length, min_exponent)
                gone = dropped_words(found, starts, len(words))
                touched = set(found[:, 0].tolist())
                collapsed = [
                    b" ".join([w for w, out in zip(t, gone[s: s + len(t)].tolist(), strict=True) if not out] if i in touched else t)
                    for i, (t, s) in enumerate(zip(texts, starts.tolist(), strict=True))
                ]
                ends = np.searchsorted(found[:, 0], np.arange(last - first + 1))
                columns = [pa.array(found[:, i]) for i in (1, 3, 2)]
                spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes), spans, pa.array(collapsed, pa.binary()).view(pa.string())], names=["id", "n_words", "runs", "collapsed"]
                )

    out = rows.mapInArrow(
        run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
    return out.withColumnRenamed("id", id_col)


def strongest(found: Column) -> Column:
    """Of a ``runs`` column, the run with the greatest exact length / period; ties to the smallest start, then period; null without runs."""
    return F.aggregate(
        F.slice(found, 2, F.greatest(F.size(found), F.lit(1))), F.get(found, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
