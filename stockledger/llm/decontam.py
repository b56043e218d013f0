"""Benchmark decontamination on a positional inverted index (operator 4; built-in functions only).

1. Test items become windows of ``window`` consecutive words (an item of fewer
   words is one window); equal windows of several items are one.
2. Every text is cut into words once and stored as its terms in order (32-bit
   hashes; the last step compares words, so a collision costs work, not truth).
   The corpus frequency of every test term is counted over all documents. A
   window with a term the corpus lacks cannot occur. Of each other window, the
   ``rarest`` terms are its probes.
3. The training postings of the probe terms are stored: a list of positions
   for each (term, document). Lists of terms that no window probes would never
   be read and are not stored.
4. The lists of a window's probes are intersected from the rarest on, each
   shifted by the term's offset in the window: what is left is a start of the
   whole window, or a proximity match if shifts of up to ``slop`` words are allowed.
5. A phrase match must equal the window on the document's own words.

Words are runs of 0-9, a-z and non-ASCII characters after A-Z are lower-cased.
Joins with the test side broadcast it only if its measured size allows;
otherwise they are shuffle joins whose skewed terms are split at run time.

Defined results: null or wordless text has no words and is clean; null or
wordless items have no windows; a null item id is never reported; rows that
repeat an id and a text give equal results; an id with several texts is judged
text by text. Extra columns pass through ``filter_clean`` and are ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.common import ascii_lower, written
from stockledger.operators.joins import broadcast_limit, fits_broadcast, maybe_broadcast

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(_WORD), F.lit(0))


def test_windows(items: DataFrame, window: int, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(win, terms, hashes) of distinct windows, and (win, item) of the items that hold them."""
    worded = items.where(F.col(text_col).isNotNull()).select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))))
    cut = worded.select("item", "w", start.alias("s")).select("item", F.slice("w", F.col("s") + 1, F.lit(window)).alias("terms"))
    cut = written(cut.withColumn("win", F.md5(F.array_join("terms", " "))), "windows")
    distinct = cut.select("win", "terms", F.transform("terms", lambda w: F.hash(w)).alias("hashes")).dropDuplicates(["win"])
    return distinct, cut.select("win", "item").distinct()


def probes(windows: DataFrame, frequency: DataFrame, rarest: int) -> DataFrame:
    """(win, rank, off, term): the rarest terms of each window whose terms all occur in the corpus."""
    term = windows.select("win", F.size("terms").alias("n"), F.posexplode("hashes").alias("off", "term")).join(frequency, "term")
    by_win = Window.partitionBy("win")
    return (
        term.withColumn("held", F.count(F.lit(1)).over(by_win)).where("held = n")
        .withColumn("rank", F.row_number().over(by_win.orderBy("freq", "term", "off"))).where(F.col("rank") <= rarest)
        .select("win", "rank", "off", "term")
    )


def stored_terms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, version, terms): each text's term hashes in order; a null text has a null version and no terms."""
    text = F.col(text_col)
    terms = F.transform(words(text), lambda w: F.hash(w))
    return written(
        docs.select(F.col(id_col).alias("id"), F.when(text.isNotNull(), F.xxhash64(text)).alias("version"), F.coalesce(terms, F.array().cast("array<int>")).alias("terms")),
        "terms",
    )


def matches(
    docs: DataFrame, items: DataFrame, *, window: int = 13, rarest: int = 3, slop: int = 0,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, version, win, start, length, kind) of all matches, (win, item), and the stored terms.

    ``kind`` is ``phrase`` (the window's words, in place) or, with ``slop`` over 0,
    ``proximity`` (its rarest terms in place but for shifts of up to ``slop`` words).
    """
    stored = stored_terms(docs, id_col, text_col)
    wins, holders = test_windows(items, window, item_col, item_text_col)
    vocabulary = wins.select(F.explode("hashes").alias("term")).distinct()
    vocabulary = maybe_broadcast(vocabulary, fits_broadcast(vocabulary))
    frequency = written(
        stored.select(F.explode("terms").alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("freq")), "frequency"
    )
    probe = written(probes(wins, frequency, rarest), "probes")
    small = fits_broadcast(probe)
    probed = maybe_broadcast(probe.select("term").distinct(), small)
    postings = written(
        stored.select("id", "version", F.posexplode("terms").alias("pos", "term")).join(probed, "term")
        .groupBy("term", "id", "version").agg(F.collect_list("pos").alias("positions")),
        "postings",
    )

    def of_rank(r: int) -> DataFrame:
        return maybe_broadcast(probe.where(F.col("rank") == r).select("win", "off", "term"), small)

    found = (
        postings.join(of_rank(1), "term").select("win", "id", "version", F.explode("positions").alias("pos"), "off")
        .select("win", "id", "version", (F.col("pos") - F.col("off")).alias("start"))
    )
    last = probe.groupBy("win").agg(F.max("rank").alias("probes"))
    found = found.join(maybe_broadcast(last, small), "win")
    if slop == 0:
        found = found.where("start >= 0")
    for r in range(2, rarest + 1):
        place = F.col("start") + F.col("off")
        near = F.array_contains("positions", place) if slop == 0 else F.exists("positions", lambda p: F.abs(p - place) <= slop)  # noqa: B023
        kept = found.where(F.col("probes") >= r).join(of_rank(r), "win").join(postings, ["term", "id", "version"]).where(near)
        found = kept.select(*found.columns).union(found.where(F.col("probes") < r))
    found = written(found.drop("probes").distinct(), "candidates")

    ids = found.select("id").distinct()
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    text = rows.join(maybe_broadcast(ids, fits_broadcast(ids)), "id", "left_semi").select("id", "version", words(F.col("text")).alias("w")).dropDuplicates(["id", "version"])
    full = found.join(maybe_broadcast(wins, _windows_fit(wins)), "win")
    phrase = (F.col("start") >= 0) & (F.slice("w", F.greatest(F.col("start"), F.lit(0)) + 1, F.size("terms")) == F.col("terms"))
    judged = text.join(full, ["id", "version"]).select(
        "id", "version", "win", "start", F.size("terms").alias("length"), F.when(phrase, "phrase").otherwise("proximity").alias("kind")
    )
    if slop == 0:
        judged = judged.where("kind = 'phrase'")
    return written(judged, "matches"), holders, stored


def _windows_fit(wins: DataFrame) -> bool:
    row = wins.agg((F.count(F.lit(1)) * 128 + F.coalesce(F.sum(F.aggregate("terms", F.lit(0), lambda a, t: a + 16 + F.octet_length(t))), F.lit(0))).alias("b")).first()
    return row["b"] <= broadcast_limit(wins)


def contamination(
    docs: DataFrame, items: DataFrame, *, window: int = 13, share: int = 20, rarest: int = 3,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per row: its id, version (hash of the text), n_words, n_hit, n_items, items_sha256 and contaminated.

    A word is hit if it lies in a phrase match; a document is contaminated if
    one in ``share`` of its words is hit.
    """
    found, holders, stored = matches(
        docs, items, window=window, rarest=rarest, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col
    )
    ordered = Window.partitionBy("id", "version").orderBy("start", "length")
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hits = (
        found.select("id", "version", "start", "length").distinct()
        .withColumn("new", F.greatest(F.lit(0), end - F.greatest(F.col("start"), reached)))
        .groupBy("id", "version").agg(F.sum("new").alias("n_hit"))
    )
    held = (
        found.select("id", "version", "win").distinct().join(holders, "win")
        .groupBy("id", "version").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
        .select("id", "version", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    hit = written(hits.join(held, ["id", "version"], "left"), "hits")
    hit = maybe_broadcast(hit, fits_broadcast(hit))
    rows = stored.select("id", "version", F.size("terms").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(hit, ["id", "version"], "left").select(
        F.col("id").alias(id_col), "version", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def filter_clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows and columns of ``docs`` whose text is not contaminated."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    bad = contamination(docs, items, **how).where("contaminated").select(F.col(id_col).alias("__id"), F.col("version").alias("__version")).distinct()
    bad = written(bad, "contaminated")
    return docs.join(
        maybe_broadcast(bad, fits_broadcast(bad)), (F.col(id_col) == F.col("__id")) & (F.xxhash64(text_col) == F.col("__version")), "left_anti"
    )
