"""Sequence packing: shortest-pack-first over the length histogram (operator 7).

1. A Python task turns each text into ids, cuts documents longer than a
   sequence into full pieces and one rest, and keeps per piece its place,
   length and checksum (the ids too if asked). The pieces are written once.
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the
   corpus) goes to the driver. Lengths are placed longest first into the
   currently shortest packs. Packs of equal fill are interchangeable, so the
   state is a count of packs per fill with ranges of sequence numbers: the
   placement list depends on the capacity, not on the number of documents.
3. Pieces get a rank within their length: counts per (length, salt) give each
   salt its first rank, so one very common length is numbered by many tasks.
   A placement covers a range of ranks; a binary search joins a piece to it.

Defined results: null text counts as empty, and an empty document is the end
id alone; repeated rows are documents of their own; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.common import written
from stockledger.llm.token_counts import byte_symbols, tokenizer_path

#: Words, and ids of words, that one Python worker remembers.
REMEMBERED, REMEMBERED_IDS = 250_000, 2_500_000


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids of whole texts from ids of their words.

    The tokenizer drops white space and never joins text across it, so a
    text's ids are those of its words in order; the library encodes each word
    once, and the worker remembers it. A text of Latin-1 characters without
    ``<|`` (no special token can be hidden in it) is lower-cased first, as the
    normaliser does next, so that words repeat more often. A word of lower-case
    Latin-1 letters, also before one comma or full stop, is one pre-token (or
    two) as it stands and goes to the library's model directly; any other word
    takes the library's whole path.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.stops = {s: self.tokenizer.encode(s, add_special_tokens=False).ids for s in ",."}
        self.forget()

    def forget(self) -> None:
        self.slot, self.ids, self.first = {"": 0}, np.zeros(0, np.int32), np.zeros(2, np.int64)

    def word(self, word: str) -> list[int]:
        core, stop = (word[:-1], word[-1]) if word[-1] in self.stops else (word, None)
        if core.isalpha() and core.islower() and _latin(core):
            spelled = core if core.isascii() else "".join([self.symbols[b] for b in core.encode()])
            ids = [t.id for t in self.model.tokenize(spelled)]
            return ids + self.stops[stop] if stop else ids
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        encoded = [self.word(w) for w in words]
        n, end = len(self.slot), int(self.first[-1])
        self.slot.update(zip(words, range(n, n + len(words)), strict=True))
        self.first = np.concatenate([self.first, end + np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(encoded), np.int32)])

    def words(self, text: str) -> list[str]:
        if "<|" not in text and _latin(text):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        step, size = [], 0
        for text in texts:
            step.append(text)
            size += len(text)
            if size >= 1 << 20:
                yield from self._step(step)
                step, size = [], 0
        yield from self._step(step)

    def _step(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.slot) > REMEMBERED or self.first[-1] > REMEMBERED_IDS:
            self.forget()
        words: list[str] = []
        ends = [0]
        for text in texts:
            words += self.words(text)
            ends.append(len(words))
        at = list(map(self.slot.get, words))
        missing = [i for i, a in enumerate(at) if a is None]
        if missing:
            self.learn(list({words[i] for i in missing}))
            for i in missing:
                at[i] = self.slot[words[i]]
        at = np.array(at, np.int64)
        begin = self.first[at]
        lengths = self.first[at + 1] - begin
        upto = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.ids[np.repeat(begin - upto[:-1], lengths) + np.arange(upto[-1])]
        cuts = upto[ends]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield flat[lo:hi]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path(tokenizer))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                row, start, length, crc, total, kept = [], [], [], [], [], []
                for i, ids in enumerate(encoder.encode(part.column(1).to_pylist())):
                    ids = np.append(ids, end_id).astype("<u4")
                    for s in range(0, len(ids), capacity):
                        piece = ids[s: s + capacity]
                        row.append(i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(ids))
                        if keep_ids:
                            kept.append(piece.astype(np.int32))
                columns = [part.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(run, schema)


def place(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Placements (length, first rank, first sequence, offset), ordered by length and rank.

    ``n`` consecutive ranks from the first rank lie in ``n`` consecutive
    sequences from the first one, up to the next placement of that length.
    """
    packs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free room: (first sequence, count)
    fresh, out = 0, []
    most = 0  # no pack has more room than this
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            while most >= length and not packs[most]:
                most -= 1
            if most < length:  # open packs, as many as this length fills when they are shared evenly
                count = -(-left // (capacity // length))
                packs[capacity].append((fresh, count))
                fresh += count
                most = capacity
            first, count = packs[most].pop()
            taken = min(count, left)
            if taken < count:
                packs[most].append((first + taken, count - taken))
            packs[most - length].append((first, taken))
            out.append((length, rank, first, capacity - most))
            rank += taken
            left -= taken
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    keep_ids: bool = False, salt_rows: int = 200, most_salts: int = 64, salt_most_rows: int = 1_000_000,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Columns: the id column, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and ids if ``keep_ids``. Every id of a document, the end id
    included, lies in exactly one piece. Writes the pieces to the checkpoint folder.

    The pieces of one length are numbered by one task for every ``salt_rows``
    of them, up to ``most_salts`` tasks, beyond that one for ``salt_most_rows``:
    the driver sees at most capacity x most_salts counts and one for every
    ``salt_most_rows`` pieces.
    """
    cut = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    # at most ``capacity`` rows: collected, and broadcast back with the number of salts
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = {k: max(min(most_salts, -(-n // salt_rows)), -(-n // salt_most_rows)) for k, n in histogram.items()}
    lengths = cut.sparkSession.createDataFrame(sorted(salts.items()), "length long, salts long")
    salted = cut.join(F.broadcast(lengths), "length").withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), "salts"))
    shift, slot = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)  # pieces and salts of smaller lengths
    for length, n in histogram.items():
        shift[length + 1], slot[length + 1] = n, salts[length]
    shift, slot = np.cumsum(shift), np.cumsum(slot)
    before = np.zeros(slot[-1], np.int64)  # pieces of smaller lengths, or smaller salts of the same
    for r in salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).collect():
        before[slot[r["length"]] + r["salt"]] = r["n"]
    before = np.cumsum(before) - before
    plan = place(histogram, capacity)

    numbered = salted.drop("salts").withColumn(
        "in_salt", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32")) - 1
    )
    key = shift[plan[:, 0]] + plan[:, 1]  # ascending over (length, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = before[slot[length] + batch.column("salt").to_numpy()] + batch.column("in_salt").to_numpy()
            at = np.searchsorted(key, number, "right") - 1
            sequence = plan[at, 2] + number - key[at]
            names = [n for n in batch.schema.names if n not in ("salt", "in_salt")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(plan[at, 3])],
                names=[*names, "sequence_id", "offset"],
            )

    kept = [f for f in numbered.schema.fields if f.name not in ("salt", "in_salt")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    out = numbered.mapInArrow(run, schema)
    rest = [f.name for f in kept if f.name not in ("id", "start", "length", "ids_crc32", "doc_tokens")]
    return out.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", *rest, "sequence_id", "offset")
