import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import documents, seeded
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockledger.llm.packing import pack, place

FILE = "word_bpe_49k.json"


def cases():
    rng = seeded()
    alphabet = list("aabcAB 'stre  \n\t\x1c\xa0éßΣİ1½漢한🙂́!?<|>")
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(200)]
    return [*made, None, "", " ", "word " * 9000, "x" * 3000, "<|endoftext|> a<|startoftext|>", *["copy of one text"] * 300]


def check(rows, texts, capacity):
    library = Tokenizer.from_file(public_tokenizers.path(FILE))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert len(by_doc) == len(texts)
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            piece = np.array(ids[at: at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return sum(r["length"] for r in rows) / (capacity * len(by_sequence))


def test_every_id_lies_in_one_piece(spark):
    texts = cases()
    rows = pack(documents(spark, texts), FILE, capacity=512).collect()
    assert check(rows, texts, 512) > 0.95


def test_salted_ranks_and_kept_ids(spark):
    texts = ["one two three"] * 50 + ["a b"] * 7
    rows = pack(documents(spark, texts), FILE, capacity=16, salt_rows=3, keep_ids=True).collect()
    check(rows, texts, 16)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_empty_table(spark):
    assert pack(documents(spark, []), FILE).collect() == []


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 60), min_size=1))
def test_placements_cover_every_rank_once(histogram):
    plan = place(histogram, 24)
    fill = defaultdict(int)
    for length, n in sorted(histogram.items(), reverse=True):
        own = [p for p in plan if p[0] == length]
        ends = [*[p[1] for p in own[1:]], n]
        assert own[0][1] == 0
        for (_, rank, sequence, offset), end in zip(own, ends, strict=True):
            for s in range(sequence, sequence + end - rank):
                assert fill[s] == offset
                fill[s] += length
    assert max(fill.values()) <= 24
    assert sorted(fill) == list(range(len(fill)))
