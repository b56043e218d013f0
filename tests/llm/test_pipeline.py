"""The pipeline against a brute-force version of its stages, and the style of the native operators."""

import pathlib
import re

import corpus_pipeline
import pytest
from conftest import SF001
from helpers import contaminated, documents, near_components, without_lines

import stockledger.llm as llm
from stockledger.llm.language_id import identify

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    rejected = {r["doc_id"] for r in identify(docs).where("rejected").collect()}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in rejected]
    texts = [(i, t) for i, (_, gone, t) in without_lines(texts).items() if not gone or t.strip(" \t\n\x0b\f\r")]
    component = near_components(texts, 5, 80)
    texts = [(i, t) for i, t in texts if component[i] == i]
    texts = [(i, t) for i, t in texts if not contaminated(t, items)[3]]
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in texts}
    # the packed documents are those texts, whole
    from stockledger.llm.packing import pack

    want = pack(documents(spark, texts, clash=False), corpus_pipeline.WORD_BPE)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(tuple(r[c] for c in key) for r in rows) == sorted(tuple(r) for r in want.select(*key).collect())


def test_stages_return_documents_also_for_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "12 34"), (4, "plain words of a text that is alone here"), (4, "plain words of a text that is alone here"), (5, "x " * 50_000)]
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert set(COLUMNS) <= set(docs.columns)
    assert {r["doc_id"] for r in docs.collect()} <= {4, 5}


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_an_empty_table(spark, stage):
    empty = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, empty, SF001).collect() == []


def test_lines_that_go_change_the_length(spark):
    docs = documents(spark, ["one two three four five six", "one two three four five six\nalone"], clash=False)
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.dedup_lines(spark, docs, SF001).collect()}
    assert out == {0: ("one two three four five six", 27), 1: ("alone", 5)}


NATIVE = ("chat", "decontam", "line_dedup")


def test_native_operators_use_built_in_functions_only():
    folder = pathlib.Path(llm.__file__).parent
    for name in NATIVE:
        source = (folder / f"{name}.py").read_text()
        assert not re.search(r"InArrow|InPandas|udf\(|pandas|pyarrow|numpy|\.rdd\b|\.collect\(", source), name


def test_no_operator_uses_volatile_storage_or_all_pairs():
    for p in pathlib.Path(llm.__file__).parent.glob("*.py"):
        assert not re.search(r"localCheckpoint|crossJoin|\.cache\(|\.persist\(|toPandas", p.read_text()), p
