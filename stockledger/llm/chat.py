"""Chat formatting with typed content parts (operator 2; built-in functions only).

A turn holds an array of parts: ``kind`` (text, image, audio or document),
``text``, ``ref`` and the sizes ``width``, ``height``, ``duration_ms`` and
``pages``. A visitor over the parts of a turn writes texts as they are
(escaped) and every other part as a placeholder, in order; each placeholder is
recorded as an attachment with its number in the conversation, its reference
and the tokens it expands to. A turn reads

    <|im_start|>role, line feed, content, <|im_end|>, line feed

and the loss mask holds the character spans of the assistant's contents.

Escaping is reversible: in a content one backslash goes between ``<`` and
``|`` (after any that are there), so no text can spell a control string, also
not across neighbouring parts, which are joined first; reading back cuts at the
placeholders before it removes escapes. A
role has its backslashes, line feeds and ``<|`` replaced by ``\\s``, ``\\n``
and ``<\\p|``.

A conversation is one output row, so its turns meet in one task; that is the
result's own size. Turns are ordered by turn, role and content.

Defined results: null text, role or part array counts as empty; a part of
unknown or null kind counts as text; sizes that are null or not positive count
as one unit; repeated rows are turns of their own; a null id is a conversation;
texts are formatted whole, so a conversation must fit one row of Spark (2 GB);
an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Kinds of parts that are written as placeholders.
MEDIA = ("image", "audio", "document")
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,duration_ms:int,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")), F.lit("<|"), F.lit("<\\p|"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\p"), F.lit("")), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """The part array of a plain text."""
    empty = {"ref": "string", "width": "int", "height": "int", "duration_ms": "int", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(F.lit(None).cast(k).alias(n) for n, k in empty.items())))


def _units(size: Column, unit: int) -> Column:
    return F.greatest(F.ceil(F.coalesce(size, F.lit(1)) / F.lit(unit)), F.lit(1)).cast("long")


def placeholder(kind: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def visit(parts: Column) -> Column:
    """What the parts of a turn write, in order: placeholders, and escaped texts between them.

    Neighbouring texts are joined before they are escaped, so no control string
    can be spelled across parts.
    """
    none = F.struct(F.lit("").alias("done"), F.lit("").alias("text"))

    def step(so_far: Column, part: Column) -> Column:
        media = part["kind"].isin(*MEDIA)
        closed = F.concat(so_far["done"], escape(so_far["text"]), placeholder(part["kind"]))
        more = F.concat(so_far["text"], F.coalesce(part["text"], F.lit("")))
        return F.when(media, F.struct(closed.alias("done"), F.lit("").alias("text"))).otherwise(F.struct(so_far["done"].alias("done"), more.alias("text")))

    return F.aggregate(parts, none, step, lambda so_far: F.concat(so_far["done"], escape(so_far["text"])))


def expanded(part: Column, patch: int, audio_ms: int, page_tokens: int) -> Column:
    """Tokens that a placeholder stands for."""
    return (
        F.when(part["kind"] == "image", _units(part["width"], patch) * _units(part["height"], patch))
        .when(part["kind"] == "audio", _units(part["duration_ms"], audio_ms))
        .otherwise(_units(part["pages"], 1) * F.lit(page_tokens))
    )


def format_chats(
    turns: DataFrame, *, patch: int = 28, audio_ms: int = 40, page_tokens: int = 1024, loss_role: str = "assistant",
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts",
) -> DataFrame:
    """One row a conversation: id, formatted, loss_spans (start, length in characters), attachments and media_tokens."""
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    content = visit(parts)
    media = F.transform(
        F.filter(parts, lambda p: p["kind"].isin(*MEDIA)),
        lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), expanded(p, patch, audio_ms, page_tokens).alias("tokens")),
    )
    role = F.coalesce(F.col(role_col), F.lit(""))
    one = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), role.alias("role"), content.alias("content"), media.alias("media"),
        F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"),
    ).withColumn("body", F.concat("head", "content", F.lit(END + "\n")))
    order = Window.partitionBy("id").orderBy("turn", "role", "content", F.xxhash64("media"))
    before = F.coalesce(F.sum(F.length("body")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = one.withColumn("place", F.row_number().over(order)).withColumn("start", before + F.length("head"))
    whole = placed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "body", "role", "start", F.length("content").alias("length"), "media"))).alias("t"))
    spans = F.transform(F.filter("t", lambda t: t["role"] == loss_role), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    attachments = F.flatten(F.transform("t", lambda t: t["media"]))
    numbered = F.transform(attachments, lambda a, i: F.struct(i.alias("number"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    return whole.select(
        F.col("id").alias(id_col), F.array_join(F.transform("t", lambda t: t["body"]), "").alias("formatted"), spans.alias("loss_spans"),
        numbered.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("media_tokens"),
    )


def parse_turns(formatted: Column) -> Column:
    """The (role, content) pairs written in a formatted conversation; contents still hold placeholders and escapes."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(bodies, lambda b: F.struct(unescape_role(F.substring_index(b, "\n", 1)).alias("role"), F.substr(b, F.instr(b, "\n") + 1).alias("content")))


def read_back(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted output says: id, turns (role, text), loss_text, formatted_chars."""
    between = r"<\|(?:" + "|".join(MEDIA) + r")\|>"  # an escaped text holds no "<|", so these are placeholders

    def plain(content: Column) -> Column:
        return F.array_join(F.transform(F.split(content, between), unescape), "")

    turns = F.transform(parse_turns(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), plain(t["content"]).alias("text")))
    under = F.transform("loss_spans", lambda s: plain(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"])))
    return chats.select(id_col, turns.alias("turns"), F.array_join(under, "").alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))
