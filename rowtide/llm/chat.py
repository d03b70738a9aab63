r"""Chat formatting with typed content parts, in DataFrame and SQL functions only.

A message has a role and parts: text, image, audio, document. A visitor goes through the parts in order, escapes texts and
puts a placeholder for everything else, whose reference and number of tokens after expansion are recorded. A turn reads
``<|turn|>role<|text|>content<|end|>``. Inside roles and texts a backslash is doubled and every control string gets a
backslash after its first character, so a text can neither end a turn nor forge one, and is read back exactly.

A formatted conversation is a list of segments with a loss flag, set for what the given roles say and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Control strings of templates in wide use, escaped as well.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
CONTROL = (TURN, TEXT, END, *PLACEHOLDERS.values(), *FOREIGN)
# Tokens for one unit of a part: a tile of an image, a second of sound, a page of a document.
RATES = {"image": 256.0, "audio": 25.0, "document": 512.0}

PARTS = "array<struct<kind: string, text: string, ref: string, units: double>>"


def escape(text: Column) -> Column:
    starts = "|".join("".join(f"\\{c}" if not c.isalnum() and c not in "_<>/" else c for c in s) for s in CONTROL)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"(?=(?:{starts}))(.)", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def flatten(parts: Column) -> Column:
    """The content of a message: its texts escaped, a placeholder for every other part. Unknown kinds get that of a
    document."""

    def visit(part: Column) -> Column:
        other = F.lit(PLACEHOLDERS["document"])
        for kind, mark in PLACEHOLDERS.items():
            other = F.when(part["kind"] == kind, mark).otherwise(other)
        return F.when(is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(other)

    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(PARTS)), visit), "")


def attachments(parts: Column, rates: dict[str, float] | None = None) -> Column:
    """``kind, ref, tokens`` of the parts that are not text, in order. Null or negative units count as one, unknown kinds
    as documents, and no attachment has less than one token."""
    rates = rates or RATES

    def record(part: Column) -> Column:
        rate = F.lit(rates["document"])
        for kind, value in rates.items():
            rate = F.when(part["kind"] == kind, value).otherwise(rate)
        units = F.when(part["units"] >= 0, part["units"]).otherwise(1.0)
        tokens = F.greatest(F.ceil(units * rate), F.lit(1)).cast("long")
        return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))

    return F.transform(F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: ~is_text(p)), record)


def text_parts(text: Column) -> Column:
    """A plain text as the parts of a message."""
    none = F.lit(None)
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), none.alias("ref"), none.alias("units"))
    return F.array(part).cast(PARTS)


def format_chats(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    loss_roles: tuple[str, ...] = ("assistant",),
    rates: dict[str, float] | None = None,
) -> DataFrame:
    """One row per conversation: ``<conv_col>, n_turns, formatted, segments, loss_spans, attachments, expanded_tokens``.

    Messages come by turn, nulls first; equal turns by role and content. A null role or text counts as empty, null or
    empty parts as no content; rows without a conversation form one of their own; repeated rows are turns like others.
    ``segments`` (text, loss) put together are ``formatted``. ``loss_spans`` (start, end) count code points of it.
    ``attachments`` (turn, kind, ref, tokens) are numbered by turn from 0, in order, and ``expanded_tokens`` is their
    sum. An empty table gives no rows; other columns are not looked at.
    """
    head = F.concat(F.lit(TURN), escape(F.coalesce(messages[role_col].cast("string"), F.lit(""))), F.lit(TEXT))
    turns = messages.select(
        messages[conv_col].alias("conv"),
        messages[turn_col].alias("turn"),
        head.alias("head"),
        flatten(messages[parts_col]).alias("content"),
        F.coalesce(messages[role_col].isin(*loss_roles), F.lit(False)).alias("loss"),
        attachments(messages[parts_col], rates).alias("found"),
    )
    in_order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "head", "content")
    size = F.length("head") + F.length("content") + len(END)
    before = F.coalesce(F.sum(size).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = turns.select("*", (F.row_number().over(in_order) - 1).alias("n"), before.alias("before"))
    chats = placed.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("n", "head", "content", "loss", "before", "found"))).alias("turns")
    )
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
                F.struct(t["content"].alias("text"), t["loss"].alias("loss")),
                F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    start = lambda t: t["before"] + F.length(t["head"])
    spans = F.transform(
        F.filter("turns", lambda t: t["loss"]),
        lambda t: F.struct(start(t).alias("start"), (start(t) + F.length(t["content"])).alias("end")),
    )
    found = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["found"], lambda a: F.struct(t["n"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))
            ),
        )
    )
    return chats.select(
        F.col("conv").alias(conv_col),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform(segments, lambda s: s["text"]), "").alias("formatted"),
        segments.alias("segments"),
        spans.alias("loss_spans"),
        found.alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped; placeholders stay as they are."""
    turns = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda t: t != "")
    parts = lambda t: F.split(F.substring(t, F.lit(len(TURN) + 1), F.length(t)), r"<\|text\|>", -1)
    return F.transform(
        turns, lambda t: F.struct(unescape(parts(t)[0]).alias("role"), unescape(parts(t)[1]).alias("text"))
    )


def digests(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``<conv_col>, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read from what ``format_chats``
    returned."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    both = chats.select(conv_col, "formatted", read_back(F.col("formatted")).alias("turns"), loss.alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return both.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
