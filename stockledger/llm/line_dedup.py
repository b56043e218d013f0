"""Line dedup by a deletion-neighbourhood join (operator 9; built-in functions only).

Lines are sequences of words (runs of characters other than ASCII white
space). Two lines are alike if one word edit at most -- an insertion, a
deletion or a substitution -- turns one into the other. A line is removed if
an alike line stands earlier, in order of document id and line number; that
earlier line counts even if it is itself removed. Lines of fewer than
``min_words`` words always stay.

1. Equal lines become one class with its earliest place.
2. Classes without any possible partner leave: alike lines agree on their
   first or on their second half (cut where the shorter line is halved), so a
   class none of whose halves occurs in another class has no alike line.
3. The rest emit all their variants under one deletion as hashed keys: the
   line with word i taken out, keyed with i (two lines sharing it differ by a
   substitution) and without i (a line equal to it differs by that deletion).
   Keys are sums of hashes of (word, place), so all variants of a line cost
   one running sum.
4. Equal variants are joined with the earliest holder of the key, whose
   distance is then verified on the words. A key held by very many lines is
   reduced to its earliest holder before the join: no pairs within a group.

Defined results: a null text stays null (0 lines), an empty one is one empty
line; rows that repeat an id and a text share their places, so neither removes
the other's lines; rows that repeat an id with another text are documents of
their own. Extra columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.common import written
from stockledger.operators.joins import broadcast_limit, fits_broadcast, maybe_broadcast

_ODD = ("  ", "\t", "\x0b", "\f", "\r")


def _spaced(line: Column) -> Column:
    """The words of a line with one space between them; most lines already are so and cost a few byte scans."""
    odd = F.lit(False)
    for s in _ODD:
        odd = odd | F.contains(line, F.lit(s))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\x0b\f\r]+", " ")).otherwise(line))


def _key(line: Column) -> list[Column]:
    """The 128-bit name of a class of equal lines."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of both halves as cut for partners of the same or more words, and of fewer."""
    def cut(m: Column) -> tuple[Column, Column]:
        half = F.floor(m / 2).cast("int")
        return (
            F.xxhash64(m, F.lit("first"), F.call_function("substring_index", line, F.lit(" "), half)),
            F.xxhash64(m, F.lit("second"), F.call_function("substring_index", line, F.lit(" "), half - m)),
        )

    return F.array(*cut(n), *cut(n - 1))


def line_places(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """id, version (of the text), line number, the line's class (k1, k2) and its half keys."""
    lines = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.posexplode(F.split(text_col, "\n")).alias("line", "text")
    )
    spaced = lines.withColumn("s", _spaced(F.col("text")))
    worded = spaced.withColumn("n", F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "))) + 1).where(F.col("n") >= min_words)
    return worded.select("id", "version", "line", *_key(F.col("s")), _half_keys(F.col("s"), F.col("n")).alias("halves"))


def _wanted_words(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """k1, k2, place and words of the wanted classes, read at their earliest place."""
    ids = wanted.select("place.id").distinct()
    ids = maybe_broadcast(ids, fits_broadcast(ids))
    lines = (
        docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(ids, "id", "left_semi")
        .select("id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
        .withColumn("s", _spaced(F.col("text")))
        .select(F.struct("id", "line").alias("place"), *_key(F.col("s")), F.split("s", " ").alias("words"))
    )
    return lines.join(wanted, ["k1", "k2", "place"]).dropDuplicates(["k1", "k2"])


def _variants(lines: DataFrame) -> DataFrame:
    """One row for each line and word: the keys of the line without that word, with and without its place, and of the whole line."""
    def h(word: str, place: Column, salt: int) -> Column:  # 44 bits, so that sums never overflow
        return F.shiftright(F.xxhash64(F.lit(salt), F.col(word), place), 20)

    word = lines.select("k1", "k2", "place", F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))
    here = word.select("*", *(h("w", F.col("i"), s).alias(f"h{s}") for s in (1, 2)), *(h("w", F.col("i") - 1, s).alias(f"g{s}") for s in (1, 2)))
    line = Window.partitionBy("k1", "k2")
    before = line.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    for s in (1, 2):
        here = (
            here.withColumn(f"t{s}", F.sum(f"h{s}").over(line))
            .withColumn(f"d{s}", F.coalesce(F.sum(f"h{s}").over(before), F.lit(0)) + F.sum(f"g{s}").over(line) - F.sum(f"g{s}").over(upto))
            .withColumn(f"s{s}", F.col(f"t{s}") - F.col(f"h{s}"))
        )


    def key(name: str, *of) -> list[Column]:
        return [F.xxhash64(*of).alias(f"{name}1"), F.xxhash64(F.lit(1), *of).alias(f"{name}2")]

    return here.select(
        "k1", "k2", "place", "i", *key("sub", "s1", "s2", "n", "i"), *key("cut", "d1", "d2", F.col("n") - 1),
        F.when(F.col("i") == 0, F.struct(*key("w", "t1", "t2", "n"))).alias("whole"),
    )


def alike_earlier(lines: DataFrame) -> DataFrame:
    """Classes (k1, k2) of ``lines(k1, k2, place, words)`` with an earlier line one edit away."""
    variant = written(_variants(lines), "variants")
    # substitution: the same line once word i is taken out; only the earliest holder of a key matters
    key = ["sub1", "sub2"]
    first = variant.groupBy(*key).agg(F.min(F.struct("place", "k1", "k2")).alias("e"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    same = variant.select("k1", "k2", "place", *key).join(first, key).where(F.col("e.place") < F.col("place")).select(
        "k1", "k2", F.col("e.k1").alias("o1"), F.col("e.k2").alias("o2"), F.lit(-1).alias("i")
    )
    # insertion or deletion: a line without word i is another whole line
    whole = variant.where("i = 0").select(
        F.col("whole.w1").alias("cut1"), F.col("whole.w2").alias("cut2"), F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("place").alias("b_place")
    )
    pair = variant.select("k1", "k2", "place", "i", "cut1", "cut2").join(whole, ["cut1", "cut2"])
    longer_later = F.col("b_place") < F.col("place")
    pair = pair.select(
        F.when(longer_later, F.col("k1")).otherwise(F.col("b1")).alias("k1"), F.when(longer_later, F.col("k2")).otherwise(F.col("b2")).alias("k2"),
        F.when(longer_later, F.col("b1")).otherwise(F.col("k1")).alias("o1"), F.when(longer_later, F.col("b2")).otherwise(F.col("k2")).alias("o2"), "i",
    )
    found = same.union(pair).dropDuplicates(["k1", "k2", "o1", "o2"])
    mine = lines.select("k1", "k2", "words")
    other = lines.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("words").alias("other"))
    a, b = F.col("long"), F.col("short")
    one_off = F.size(F.filter(F.zip_with("words", "other", lambda x, y: x != y), lambda x: x)) == 1
    without = F.concat(F.slice(a, F.lit(1), F.col("i")), F.slice(a, F.col("i") + 2, F.size(a))) == b
    return (
        found.join(mine, ["k1", "k2"]).join(other, ["o1", "o2"])
        .withColumn("long", F.when(F.size("words") > F.size("other"), F.col("words")).otherwise(F.col("other")))
        .withColumn("short", F.when(F.size("words") > F.size("other"), F.col("other")).otherwise(F.col("words")))
        .where(F.when(F.col("i") < 0, one_off).otherwise(without))
        .select("k1", "k2").distinct()
    )


def removed_lines(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """id, version and the numbers of the lines to remove, for documents that have any."""
    places = written(line_places(docs, min_words, id_col, text_col), "places")
    classes = written(
        places.groupBy("k1", "k2").agg(F.min(F.struct("id", "line")).alias("place"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("c")),
        "line-classes",
    )
    half = classes.select("k1", F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    sharing = half.join(shared, "half", "left_semi").select("k1").distinct()
    wanted = written(classes.select("k1", "k2", "place").join(sharing, "k1", "left_semi"), "wanted")
    lines = written(_wanted_words(docs, wanted, id_col, text_col), "wanted-lines")
    fuzzy = alike_earlier(lines).withColumn("fuzzy", F.lit(True))
    gone = classes.join(fuzzy, ["k1", "k2"], "left").where("c > 1 or fuzzy").select("k1", "k2", "place", F.coalesce("fuzzy", F.lit(False)).alias("fuzzy"))
    return (
        places.select("id", "version", "line", "k1", "k2").join(gone, ["k1", "k2"])
        .where(F.col("fuzzy") | (F.struct("id", "line") != F.col("place")))
        .groupBy("id", "version").agg(F.collect_set("line").alias("removed"))
    )


def dedup_lines(docs: DataFrame, *, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the text of the lines that stay, ``n_lines`` and ``n_removed``."""
    gone = written(removed_lines(docs, min_words, id_col, text_col), "removed-lines")
    size = gone.agg((F.count(F.lit(1)) * 64 + F.coalesce(F.sum(F.size("removed")), F.lit(0)) * 8).alias("bytes")).first()["bytes"]
    gone = maybe_broadcast(gone.select(F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("removed").alias("__removed")), size <= broadcast_limit(docs))
    text, removed = F.col(text_col), F.col("__removed")
    lines = F.split(text, "\n")
    stay = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(removed, i)), "\n")
    return (
        docs.join(gone, (F.col(id_col) == F.col("__id")) & (F.xxhash64(text_col) == F.col("__version")), "left")
        .withColumn("n_lines", F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"))
        .withColumn("n_removed", F.when(removed.isNull(), F.lit(0)).otherwise(F.size(removed)).cast("long"))
        .withColumn(text_col, F.when(removed.isNull(), text).otherwise(stay))
        .drop("__id", "__version", "__removed")
    )
