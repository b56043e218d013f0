import public_tokenizers
from helpers import documents, seeded
from tokenizers import Tokenizer

from stockledger.llm.token_counts import RankMerger, count_tokens

FILE = "byte_bpe_50k.json"


def texts():
    rng = seeded()
    alphabet = list("aaabAB 'stre  \n\t\r\x0b\x1c\x85\xa0　éßΣİ123٣½漢字한🙂‍!?<|>_-")
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    return [*made, None, "", " ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "a" * 5000, "ab" * 3000, "x " * 40_000, "same", "same"]


def test_equals_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path(FILE))
    cases = texts()
    got = {r["doc_id"]: r for r in count_tokens(documents(spark, cases), FILE, limit=100).collect()}
    assert len(got) == len(cases)
    for i, text in enumerate(cases):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 100), text


def test_empty_table(spark):
    assert count_tokens(documents(spark, []), FILE).collect() == []


def test_merging_many_sequences_at_once_equals_one_by_one():
    merger = RankMerger(public_tokenizers.path(FILE))
    words = [b"aaaaaaa", b"aa", b"a", b" the", b"therethere", b"abababab"]
    assert merger.count(words).tolist() == [int(merger.count([w])[0]) for w in words]
