"""Language ID by nearest centroid (operator 1).

A text becomes a normalised TF-IDF vector of its hashed byte n-grams (one to
three bytes of its lower-cased letters, runs of anything else being one
space). Each language is described by several centroids, found by spherical
k-means over a sample of its labelled texts. A text takes the language of the
centroid of largest cosine; a text far from every centroid is rejected.

The model is fitted on at most ``sample`` labelled texts a language, drawn by
a hash of the id: that bound makes the vectors of one language fit one task and
the centroids (languages x clusters x dimensions) small enough to send to all
executors. Predicting reads every whole text.

Defined results: null text or text without a letter is ``und`` with score 0
and rejected; so is everything if no labelled text exists. Equal cosines go to
the language that sorts first. Repeated rows are predicted alike; extra
columns pass through ``keep_identified`` and are ignored otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.common import U64, seeds, written

UNKNOWN = "und"
_WORD_CHARACTERS = re.compile(r"[^\W\d_]+")
_STEP = 256  # rows vectorised together


def has_letter(text: str) -> bool:
    """Whether a character of a letter category is there; fractions, circled numbers and the like are none."""
    return any(c.isalpha() for run in _WORD_CHARACTERS.finditer(text) for c in run.group())


class Vectoriser:
    """Term counts of hashed n-grams, one dense row a text."""

    def __init__(self, bits: int):
        self.bits, self.dims = bits, 1 << bits
        self.seeds = seeds(3, 5)
        fold = np.full(256, 32, np.uint8)
        fold[97:123] = np.arange(97, 123)
        fold[128:] = np.arange(128, 256)
        self.fold = fold

    def counts(self, texts: list[str]) -> np.ndarray:
        """Rows of n-gram counts. Texts of any length are read whole, in slices of bounded size."""
        out = np.zeros((len(texts), self.dims), np.float32)
        step, size = [], 0
        for row, text in enumerate(texts):
            for lo in range(0, len(text), 1 << 20):
                # slices overlap by two characters at least, so no n-gram is lost at a cut
                step.append((row, text[max(lo - 2, 0): lo + (1 << 20)], lo > 0))
                size += len(step[-1][1])
                if size >= 1 << 20:
                    self._add(out, step)
                    step, size = [], 0
        if step:
            self._add(out, step)
        return out

    def _add(self, out: np.ndarray, step: list[tuple[int, str, bool]]) -> None:
        parts = [b" " + t.lower().encode() + b" " for _, t, _ in step]
        data = self.fold[np.frombuffer(b"".join(parts), np.uint8)]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        part = np.repeat(np.arange(len(parts)), lengths)
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (part[1:] != part[:-1])
        data, part = data[keep].astype(U64), part[keep]
        rows, which = np.unique([r for r, _, _ in step], return_inverse=True)
        base = which[part] * self.dims
        found = np.zeros(len(rows) * self.dims, np.int64)
        shift = U64(64 - self.bits)
        for n in range(1, 4):
            if len(data) < n:
                break
            code = data[: len(data) - n + 1].copy()
            for k in range(1, n):
                code = code << U64(8) | data[k: len(data) - n + 1 + k]
            inside = part[: len(code)] == part[n - 1:]
            if n == 1:
                inside &= code != 32
            index = (((code + U64(n << 32)) * self.seeds[n - 1]) >> shift).astype(np.int64) + base[: len(code)]
            found += np.bincount(index[inside], minlength=len(found))
        out[rows] += found.reshape(len(rows), self.dims)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a row without n-grams stays zero."""
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def cluster(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """At most ``k`` spherical k-means centroids; seeded by the farthest points, so deterministic."""
    centre = vectors.mean(axis=0)
    chosen = [int(np.argmax(vectors @ centre))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        far = int(np.argmin(nearest))
        if far in chosen:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[nearest == j].sum(axis=0) if (nearest == j).any() else centroids[j] for j in range(len(centroids))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    return centroids


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices, so that a task never holds a whole batch as Python strings."""
    for batch in batches:
        for lo in range(0, batch.num_rows, _STEP):
            yield batch.slice(lo, _STEP)


@dataclass
class Model:
    bits: int
    idf: np.ndarray
    languages: list[str]  # of each centroid, sorted
    centroids: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        vectoriser = Vectoriser(self.bits)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        lettered = [i for i, t in enumerate(texts) if t and has_letter(t)]
        if not len(self.centroids):
            return names, scores
        for lo in range(0, len(lettered), _STEP):
            rows = lettered[lo: lo + _STEP]
            cosine = weigh(vectoriser.counts([texts[i] for i in rows]), self.idf) @ self.centroids.T
            best = np.argmax(cosine, axis=1)
            for i, j, c in zip(rows, best, cosine[np.arange(len(rows)), best], strict=True):
                names[i], scores[i] = self.languages[j], min(max(float(c), 0.0), 1.0)
        return names, scores


def training_sample(labelled: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` rows (id, text, lang) a language, by a hash of the id.

    The languages' counts (one row a language) set the share that is read on;
    a window then enforces the bound on what is left.
    """
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(1.5 * sample) / F.col("n"))
    drawn = labelled.withColumn("draw", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    few = counts.count()  # one row a language: a classifier's classes
    drawn = drawn.join(F.broadcast(counts) if few <= 10_000 else counts, "lang").where(F.col("draw") < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id"))
    return drawn.withColumn("rank", rank).where(F.col("rank") <= sample).select("id", "text", "lang")


def fit(labelled: DataFrame, *, sample: int = 400, clusters: int = 4, bits: int = 13) -> Model:
    """A model from ``labelled(id, text, lang)``; the driver sees only document frequencies and centroids."""
    drawn = written(training_sample(labelled, sample), "language-sample")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectoriser = Vectoriser(bits)
        total, rows = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo in range(0, len(texts), _STEP):
                counts = vectoriser.counts(texts[lo: lo + _STEP])
                total += (counts > 0).sum(axis=0)
                rows += len(counts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], names=["dim", "n"])

    found = drawn.select("text").mapInArrow(frequencies, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    df = np.zeros((1 << bits) + 1)
    for r in found:
        df[r["dim"]] = r["n"]
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    def centroids(table: pa.Table) -> pa.Table:
        texts = table.column("text").to_pylist()
        counts = np.concatenate([Vectoriser(bits).counts(texts[lo: lo + _STEP]) for lo in range(0, len(texts), _STEP)])
        vectors = weigh(counts, idf)
        vectors = vectors[vectors.any(axis=1)]
        made = cluster(vectors, clusters) if len(vectors) else np.zeros((0, 1 << bits), np.float32)
        return pa.table({"lang": [table.column("lang")[0].as_py()] * len(made), "centroid": pa.array(list(made), pa.list_(pa.float32()))})

    rows = drawn.orderBy("id").groupBy("lang").applyInArrow(centroids, "lang string, centroid array<float>").collect()
    rows.sort(key=lambda r: r["lang"])
    made = np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), 1 << bits)
    return Model(bits, idf, [r["lang"] for r in rows], made)


def fold_of(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def identify(
    docs: DataFrame, *, folds: int = 5, sample: int = 400, clusters: int = 4, bits: int = 13, min_cosine: float = 0.15,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Per row: its id, held_out, lang_pred, score (cosine of the nearest centroid) and rejected.

    Learns from labelled rows of the folds other than 0. ``min_cosine`` is the
    smallest cosine that is not rejected.
    """
    text = F.col(text_col).cast("string")
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold_of(F.col(id_col), folds) != 0)).select(
        F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).alias("lang")
    )
    model = fit(labelled, sample=sample, clusters=clusters, bits=bits)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            names, scores = model.predict(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(scores)], names=["id", "lang_pred", "score"])

    predicted = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return predicted.select(
        F.col("id").alias(id_col), F.coalesce(fold_of(F.col("id"), folds) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_cosine)).alias("rejected"),
    )


def keep_identified(docs: DataFrame, *, min_cosine: float = 0.15, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", **how) -> DataFrame:
    """The rows and columns of ``docs`` whose language is identified; the decision is made beside the row, without a join."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold_of(F.col(id_col), how.pop("folds", 5)) != 0)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    model = fit(labelled, **how)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            names, scores = model.predict(part.column(at).to_pylist())
            yield part.filter(pa.array([n != UNKNOWN and s >= min_cosine for n, s in zip(names, scores, strict=True)]))

    return docs.mapInArrow(run, docs.schema)
