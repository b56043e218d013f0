"""Token counts by rank-synchronous merging of ragged arrays (operator 6).

Each task cuts its texts into pre-tokens, lays the pre-tokens it has not met
yet end to end in one flat symbol array, and merges all of them at once: in
every round each sequence merges all occurrences of its own lowest-rank pair.
A merge never creates a pair of lower rank than the one merged, so this is
the order in which the merges are defined. Only surviving symbols are counted.

A pre-token's count is remembered in the worker under a bounded number of
entries, because words repeat.

Defined results: null text counts as empty (0 tokens); strings of added
special tokens inside a text count one token each, as the library does by
default; extra columns are ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens whose counts one Python worker remembers.
REMEMBERED = 400_000
_NONE = np.int32(2**31 - 1)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class RankMerger:
    """Merge table of a byte-level BPE file as sorted arrays."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model["type"] != "BPE":
            raise ValueError("a byte-level BPE file without normaliser or prefix space is needed")
        vocab = model["vocab"]
        symbols = byte_symbols()
        self.first = np.array([vocab[symbols[b]] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = regex.compile("(?:" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # the byte-level pre-tokeniser's pattern (fixed value)
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def ranks(self, symbol: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each symbol; none across sequences or at the end."""
        pair = np.empty(len(symbol), np.int64)
        pair[:-1] = symbol[:-1] << 32 | symbol[1:]
        pair[-1] = -1
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        rank = np.where(self.key[at] == pair, self.rank[at], _NONE)
        rank[starts[1:] - 1] = _NONE
        rank[-1] = _NONE
        return rank

    def count(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols that survive the merges of each (non-empty) byte string."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        result = lengths.copy()
        active = np.arange(len(words))
        while len(active):
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            rank = self.ranks(symbol, starts)
            lowest = np.minimum.reduceat(rank, starts)
            hit = rank == np.repeat(np.where(lowest == _NONE, -1, lowest), lengths)
            where = np.flatnonzero(hit)
            if len(where):  # of overlapping equal pairs, every second one, from the left
                run = np.concatenate([[True], np.diff(where) != 1])
                head = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
                # a pair ends a run where the next one belongs to another sequence
                where = where[(np.arange(len(where)) - head) % 2 == 0]
            keep = np.ones(len(symbol), bool)
            symbol[where] = self.merged[rank[where]]
            keep[where + 1] = False
            lengths = np.add.reduceat(keep, starts, dtype=np.int64)
            done = lowest == _NONE
            result[active] = lengths
            stay = ~done & (lengths > 1)
            symbol = symbol[keep & np.repeat(stay, np.diff(np.append(starts, len(keep))))]
            active, lengths = active[stay], lengths[stay]
        return result


class TokenCounter:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.merger, self.known, self.remembered = RankMerger(path), {}, remembered

    def counts(self, texts: list[str]) -> list[int]:
        merger, known = self.merger, self.known
        if len(known) > self.remembered:
            known.clear()
        out = []
        step, size = [], 0
        for text in texts:
            step.append(text)
            size += len(text)
            if size >= 1 << 20:
                out += self._step(step, merger, known)
                step, size = [], 0
        return out + self._step(step, merger, known)

    def _step(self, texts: list[str], merger: RankMerger, known: dict[str, int]) -> list[int]:
        cut = []
        for text in texts:
            special, parts = 0, [text]
            if merger.split and any(s in text for s in merger.special):
                parts = merger.split.split(text)
                special = len(parts) - 1
            words: list[str] = []
            for part in parts:
                words += merger.words.findall(part)
            cut.append((special, words))
        new = {w for _, words in cut for w in words if w not in known}
        if new:
            new = list(new)
            known.update(zip(new, merger.count([w.encode() for w in new]).tolist(), strict=True))
        out = [special + sum(map(known.__getitem__, words)) for special, words in cut]
        if len(known) > self.remembered:
            known.clear()
        return out


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is a byte-level BPE file that every executor can read, or the
    name of a file of ``public_tokenizers``. The id column keeps its type.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer_path(tokenizer))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_bytes = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(counter.counts(texts), pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    import pyarrow.compute  # noqa: F401 - pa.compute in the tasks

    counted = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def tokenizer_path(name: str) -> str:
    """A file's path as it is; a bare name is one of the public tokenizer files."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
