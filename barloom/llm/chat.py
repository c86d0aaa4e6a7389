"""Chat formatting with typed content parts.

A visitor turns each content part into text: text parts are escaped, image, audio and document
parts become placeholders in their order, with a record of what they refer to and how many tokens
they expand to. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks of the template.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens that one unit of a part expands to: an image tile, a second of audio, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 768}

# Strings that no text may bring in: the start of this template's marks, and marks of others.
CONTROL = ("<|", "</s>", "<s>", "<unk>", "[INST]", "[/INST]")

PART = "struct<kind:string,text:string,ref:string,units:int>"


def escape(text: Column) -> Column:
    """Text without control strings: backslashes are doubled, then one is put into each of them.

    A control string in the text gets its backslash after the first character. A text that had
    one there already has two by then, so the way back is unique.
    """
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    out = text
    for mark in reversed(CONTROL):
        out = F.replace(out, F.lit(f"{mark[0]}\\{mark[1:]}"), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("ref"),
        none.cast("int").alias("units"),
    )
    return F.array(part)


def _by_kind(part: Column, table: dict, other: Column) -> Column:
    out = other
    for kind, value in table.items():
        out = F.when(part["kind"] == kind, F.lit(value)).otherwise(out)
    return out


def visited(part: Column) -> Column:
    """What a part adds to the content. Kinds that are not known count as text."""
    return _by_kind(part, PLACEHOLDER, escape(F.coalesce(part["text"], F.lit(""))))


def part_tokens(part: Column) -> Column:
    """Tokens of an attachment; text parts have none here."""
    units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))
    return (_by_kind(part, UNIT_TOKENS, F.lit(0)) * units).cast("long")


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted conversation per conv_id.

    ``turns`` has conv_id, turn, role and ``parts``, an array of (kind, text, ref, units). Returns
    conv_id, ``formatted``, ``loss_spans`` (start and length in UTF-8 bytes of each assistant
    content, from 0), ``attachments`` (kind, ref, number of its placeholder from 0, tokens) and
    ``expanded_tokens`` of all attachments.

    Parts are visited row by row before the shuffle; one conversation is one string by its nature
    and is put together in one task, like any value. Turns are ordered by number, ties by role and
    content, a missing number first. A null role or text counts as empty, a null list as no parts;
    rows without conv_id make up one conversation. An empty table gives no rows.
    """
    parts = F.coalesce(F.col("parts"), F.from_json(F.lit("[]"), f"array<{PART}>"))
    content = F.array_join(F.transform(parts, visited), "")
    others = F.filter(parts, lambda p: p["kind"].isin(*PLACEHOLDER))
    attached = F.transform(
        others,
        lambda p: F.struct(
            p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")
        ),
    )
    role = F.coalesce(F.col("role"), F.lit(""))
    visits = turns.select(
        "conv_id", "turn",
        F.concat(F.lit(TURN), escape(role), F.lit(SAYS)).alias("head"),
        content.alias("content"),
        (role == "assistant").alias("learn"),
        attached.alias("attached"),
    )
    head, body = F.octet_length("head"), F.octet_length("content")
    size = (head + body + len(END.encode())).cast("long")
    along = Window.partitionBy("conv_id").orderBy("turn", "head", "content")
    before = F.sum(size).over(along.rowsBetween(Window.unboundedPreceding, -1))
    placed = visits.withColumn("start", F.coalesce(before, F.lit(0)))
    entry = F.struct(
        "start",
        F.concat("head", "content", F.lit(END)).alias("text"),
        F.when(
            F.col("learn"),
            F.struct((F.col("start") + head).alias("start"), body.cast("long").alias("length")),
        ).alias("span"),
        "attached",
    )
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    attachments = F.flatten("turns.attached")
    tokens = F.aggregate(attachments, F.lit(0).cast("long"), lambda sum_, a: sum_ + a["tokens"])
    return gathered.select(
        "conv_id",
        F.array_join("turns.text", "").alias("formatted"),
        F.array_compact("turns.span").alias("loss_spans"),
        attachments.alias("attachments"),
        tokens.alias("expanded_tokens"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, ``turns`` (role, text) and ``loss_texts``, from formatted text and spans alone."""
    ends = F.split("formatted", END.replace("|", r"\|"))
    pieces = F.slice(ends, F.lit(1), F.size(ends) - 1)
    turns = F.transform(
        pieces,
        lambda piece: F.struct(
            unescape(F.substring_index(F.replace(piece, F.lit(TURN), F.lit("")), SAYS, 1)).alias(
                "role"
            ),
            unescape(F.substring_index(piece, SAYS, -1)).alias("text"),
        ),
    )
    data = F.col("formatted").cast("binary")
    losses = F.transform(
        "loss_spans",
        lambda s: unescape(
            F.decode(F.substring(data, s["start"].cast("int") + 1, s["length"].cast("int")), "UTF-8")
        ),
    )
    return chats.select("conv_id", "formatted", turns.alias("turns"), losses.alias("loss_texts"))
