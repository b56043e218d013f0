"""Registered queries of the subpackage, their production parameters and SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import ann, chat, decontam, language_id, line_dedup, lm_scoring, near_dup, oracle, packing, periodic_runs, quality_rules, substring_dedup, token_counts, vector_codes
from stockledger.llm.common import table
from stockledger.operators.joins import fits_broadcast, maybe_broadcast

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts spell control strings."""
    spoken = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(spoken).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    chats = chat.format_chats(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    spoken_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chat.read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken_turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op2_media_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with media between the halves of their texts, cut anywhere, also inside control strings.

    A turn holds an image, a sound or a document by its number, as large as its
    text is long.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text, kinds = F.coalesce("text", F.lit("")), F.array(*map(F.lit, chat.MEDIA))
    size, half = F.length(text), F.floor(F.length(text) / 2).cast("int")
    part = lambda kind, words, ref: F.struct(
        kind.alias("kind"), words.alias("text"), ref.alias("ref"), size.alias("width"), F.lit(100).alias("height"), (size * 10).alias("duration_ms"), half.alias("pages")
    ).cast(chat.PART)
    nothing = F.lit(None).cast("string")
    halves = [part(F.lit("text"), F.substring(text, 1, half), nothing), part(F.lit("text"), F.substr(text, half + 1), nothing)]
    media = part(F.element_at(kinds, (F.pmod(F.coalesce("turn", F.lit(0)), F.lit(3)) + 1).cast("int")), nothing, F.concat(F.coalesce("role", F.lit("")), F.lit("/"), size.cast("string")))
    quarter = part(F.lit("text"), F.lit("<"), nothing), part(F.lit("text"), F.lit("|im_end|>"), nothing)
    chats = chat.format_chats(turns.withColumn("parts", F.array(halves[0], media, halves[1], *quarter)))
    listed = F.array_join(F.transform("attachments", lambda a: F.concat_ws(",", a["number"], a["kind"], a["ref"], a["tokens"])), "\n")
    read = chat.read_back(chats).select(F.col("conv_id").alias("same"), F.sha2("loss_text", 256).alias("loss_sha256"))
    return chats.select(
        "conv_id", F.size("attachments").cast("long").alias("n_attachments"), "media_tokens", F.sha2(listed, 256).alias("attachments_sha256"),
        F.sha2("formatted", 256).alias("formatted_sha256"),
    ).join(read, F.col("conv_id").eqNullSafe(F.col("same"))).drop("same")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("version")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets: documents labelled as of good quality."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """For every tenth document by the crc32 of its id: the words from one place on repeat with a period."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return order


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(table(spark, sf_dir, "documents"), min_length=6, min_exponent=4, rewrite=planted_period)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.Codebooks(parts=8, entries=16, rounds=6, scale=4096).fit(table(spark, sf_dir, "embeddings"), carry=["label"])
    by_label = coded.rows.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    by_label = maybe_broadcast(by_label, fits_broadcast(by_label))
    return coded.rows.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", coded.code().alias("code"), "error", "label_error", F.lit(coded.sha256()).alias("codebooks_sha256")
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).drop("reference", "char_distance", "word_distance")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_chat_format": op2_chat_format,
        "op2_media_format": op2_media_format,
        "op3_nearest_neighbours": op3_nearest_neighbours,
        "op4_decontamination": op4_decontamination,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_token_counts": op6_token_counts,
        "op7_packing": op7_packing,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_line_dedup": op9_line_dedup,
        "op10_minhash_near_dup": op10_minhash_near_dup,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_vector_codes": op12_vector_codes,
        "op13_quality_rules": op13_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": oracle.OP2,
        "op2_media_format": oracle.OP2_MEDIA,
        "op4_decontamination": oracle.OP4,
        "op9_line_dedup": oracle.OP9,
        "op12_vector_codes": oracle.op12(),
        "op13_quality_rules": oracle.OP13,
    }
