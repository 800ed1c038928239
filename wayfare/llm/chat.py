"""Chat formatting of turns made of typed parts, with a loss mask."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import let

# Each turn is TURN role TEXT content END. Content cannot hold any of them.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

RESULTS = ("n_turns", "segments", "attachments", "formatted")

PARTS = """array<struct<kind:string, text:string, uri:string, width:int, height:int,
    seconds:double, pages:int>>"""

# Control strings of this and other common templates, found by their start.
_CONTROL = r"(<)(\||/?s>)|(\[)(/?INST\])"


def escape(text: Column) -> Column:
    """Break up control strings by a backslash after their first character."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


@dataclass(frozen=True)
class Expansion:
    """Tokens that one attachment stands for."""

    patch: int = 14
    audio_per_second: float = 25.0
    per_page: int = 1024

    def tokens(self, part: Column) -> Column:
        def patches(side: Column) -> Column:
            return F.ceil(F.coalesce(side, F.lit(0)) / self.patch)

        return (
            F.when(part["kind"] == "image", patches(part["width"]) * patches(part["height"]))
            .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_per_second))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * self.per_page)
            .otherwise(0)
            .cast("long")
        )


def visited(parts: Column, expansion: Expansion) -> Column:
    """Visit typed parts in order: their content and the attachments they refer to.

    Neighbouring text is one text and is escaped as such, so no control string can be put
    together from parts; any other part becomes a placeholder ``<|kind:n|>`` that
    counts the attachments of its turn from 0. A null list has no parts, a null
    part is skipped, a part without kind is text, and an unknown kind is an
    attachment of no tokens.
    """
    parts = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())

    def visit(ps: Column) -> Column:
        def is_text(p: Column) -> Column:
            return F.coalesce(p["kind"], F.lit("text")) == "text"

        attached = F.filter(F.transform(ps, lambda p, i: F.struct(p.alias("part"), i.alias("at"))), lambda x: ~is_text(x["part"]))
        texts = F.transform(ps, lambda p: F.coalesce(p["text"], F.lit("")))

        def content(files: Column) -> Column:
            def run(k: Column) -> Column:
                """All text before the k-th attachment, or after the last."""
                start = F.coalesce(F.get(files, k - 1)["at"] + 1, F.lit(0))
                end = F.coalesce(F.get(files, k)["at"], F.size(ps))
                return escape(F.array_join(F.slice(texts, start + 1, end - start), ""))

            def mark(k: Column) -> Column:
                kind = F.regexp_replace(F.get(files, k)["part"]["kind"], r"[^a-z0-9_]", "_")
                placed = F.concat(F.lit("<|"), kind, F.lit(":"), k.cast("string"), F.lit("|>"))
                return F.coalesce(placed, F.lit(""))

            pieces = F.transform(F.sequence(F.lit(0), F.size(files)), lambda k: F.concat(run(k), mark(k)))
            return F.struct(
                F.array_join(pieces, "").alias("content"),
                F.transform(
                    files,
                    lambda x: F.struct(
                        x["part"]["kind"].alias("kind"),
                        x["part"]["uri"].alias("uri"),
                        expansion.tokens(x["part"]).alias("tokens"),
                    ),
                ).alias("attachments"),
            )

        return let(attached, content)

    return let(parts, visit)


def typed(text: Column) -> Column:
    """A turn of one text, as typed parts."""
    empty = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()],
        )
    )


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    learned: Sequence[str] = ("assistant",),
    expansion: Expansion = Expansion(),
) -> DataFrame:
    """One row per conversation: its formatted text, loss mask and attachments.

    Returns the conversation column, ``n_turns``, ``segments`` (the output in
    order, each with whether it counts for the loss), ``formatted`` (the
    segments joined) and ``attachments`` (turn number, kind, uri, tokens).

    Turns are formatted where they are read; only then the rows of a
    conversation meet, and as a conversation is one text they meet in one row.
    They are ordered by ``turn`` (null first), ties by role and content, so
    repeated rows stay and follow each other. Null roles are empty; null
    conversations are one conversation. Empty input gives no rows. The conversation's
    column may not have the name of a result.
    """
    if conversation in RESULTS:
        raise ValueError(f"{conversation} is the name of a result; rename the column")
    seen = visited(F.col(parts), expansion)
    name = F.coalesce(F.col(role), F.lit(""))
    pieces = turns.select(
        F.col(conversation),
        F.struct(F.col(turn).alias("turn"), name.alias("role"), seen.alias("said")).alias("chat__row"),
    )
    ordered = F.sort_array(F.collect_list("chat__row"))
    whole = pieces.groupBy(conversation).agg(ordered.alias("chat__rows"))

    def segments(row: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(TURN), escape(row["role"]), F.lit(TEXT)).alias("text"), F.lit(False).alias("loss")),
            F.struct(row["said"]["content"].alias("text"), row["role"].isin(*learned).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )

    return whole.select(
        conversation,
        F.size("chat__rows").cast("long").alias("n_turns"),
        F.flatten(F.transform("chat__rows", segments)).alias("segments"),
        F.flatten(
            F.transform(
                "chat__rows",
                lambda row, i: F.transform(
                    row["said"]["attachments"],
                    lambda a: F.struct(i.alias("turn"), a["kind"].alias("kind"), a["uri"].alias("uri"), a["tokens"].alias("tokens")),
                ),
            )
        ).alias("attachments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of role and text, unescaped.

    Placeholders stay in the text.
    """
    chunks = F.filter(F.split(formatted, r"<\|turn\|>"), lambda c: c != "")

    def turn(chunk: Column) -> Column:
        halves = F.split(chunk, r"<\|text\|>")
        said = F.get(halves, 1)
        return F.struct(
            unescape(F.get(halves, 0)).alias("role"),
            unescape(F.left(said, F.length(said) - len(END))).alias("text"),
        )

    return F.transform(chunks, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    counted = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"])
    return unescape(F.array_join(counted, ""))
