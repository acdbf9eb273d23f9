"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent
turns of one role are merged by an array aggregation, and the blocks are
concatenated::

    <|im_start|>user\n...<|im_end|>\n<|im_start|>assistant\n...<|im_end|>\n

Turns merged into one block stay apart by ``<|turn|>``, so a formatted text can
be read back turn by turn.  In texts, ``<`` + backslashes + ``|`` gets one more
backslash: no text can hold a control string, and the change is reversible.
Roles have ``%``, ``<`` and line feeds percent-encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of a chunk that spans are read from; elements of a piece of a running sum.
CHUNK = 1024
PIECE = 256
START, END, TURN = "<|im_start|>", "<|im_end|>\n", "<|turn|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    role = F.replace(role, F.lit("%"), F.lit("%25"))
    role = F.replace(role, F.lit("<"), F.lit("%3C"))
    return F.replace(role, F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    role = F.replace(role, F.lit("%0A"), F.lit("\n"))
    role = F.replace(role, F.lit("%3C"), F.lit("<"))
    return F.replace(role, F.lit("%25"), F.lit("%"))


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss_spans``.

    ``loss_spans`` holds (start, length) in characters of ``formatted``, start
    from 1, of every text of ``trained_role``.

    Nulls: a null role or text is empty, a null turn comes first, a row without
    conversation id is a conversation of its own.  Equal turn numbers are
    ordered by role and text, repeated rows are repeated turns.  Other columns
    are ignored.  An empty table gives no rows.  A conversation is one row, so
    it is made in one task, like any single value, in time in proportion to its
    length (50,000 turns take a second or two).
    """
    rows = turns.select(
        F.col(conv).alias("c"),
        F.when(F.col(conv).isNull(), F.monotonically_increasing_id()).alias("lone"),
        F.struct(
            F.col(turn).alias("turn"),
            escape_role(F.coalesce(F.col(role), F.lit(""))).alias("role"),
            escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("c", "lone").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def blocks_of(all_turns: Column) -> Column:
        """Adjacent turns of one role as one block: each starts where the role changes and ends before the next."""
        n = F.size(all_turns)
        places = F.sequence(F.lit(1), n)
        starts = F.filter(
            places,
            lambda i: (i == 1) | (F.get(all_turns, i - 1)["role"] != F.get(all_turns, i - 2)["role"]),
        )

        def block_at(start: Column, k: Column, all_starts: Column) -> Column:
            size = F.coalesce(F.get(all_starts, k + 1), n + 1) - start
            return F.struct(
                F.get(all_turns, start - 1)["role"].alias("role"),
                F.transform(F.slice(all_turns, start, size), lambda t: t["text"]).alias("texts"),
            )

        return let(starts, lambda all_starts: F.transform(all_starts, lambda s, k: block_at(s, k, all_starts)))

    merged = sorted_turns.select("c", let(F.col("turns"), blocks_of).alias("blocks"))

    def block(b: Column) -> Column:
        return F.concat(
            F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], TURN), F.lit(END)
        )

    def block_size(b: Column) -> Column:
        between = len(START) + 1 + len(END) - len(TURN)
        texts = F.aggregate(b["texts"], F.lit(0), lambda at, x: at + F.char_length(x) + len(TURN))
        return F.char_length(b["role"]) + between + texts

    def spans_of(b: Column, at: Column) -> Column:
        head = at + len(START) + F.char_length(b["role"]) + 1
        sizes = F.transform(b["texts"], lambda x: F.char_length(x) + len(TURN))
        spans = F.zip_with(
            running(sizes, head), sizes, lambda a, n: F.struct(a.alias("start"), (n - len(TURN)).alias("length"))
        )
        no_spans = F.array().cast("array<struct<start:int,length:int>>")
        return F.when(b["role"] == escape_role(F.lit(trained_role)), spans).otherwise(no_spans)

    starts = running(F.transform("blocks", block_size), F.lit(1))
    return merged.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("blocks", block), "").alias("formatted"),
        F.flatten(F.zip_with("blocks", starts, spans_of)).alias("loss_spans"),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(sizes: Column, first: Column) -> Column:
    """Where each of a row of pieces starts, the first at ``first``.

    An array that grows element by element is copied each time, so it only grows within pieces of
    ``PIECE`` elements, and by one element a piece.
    """

    def starts(values: Column, at: Column) -> Column:
        state = F.struct(at.cast("int").alias("at"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(
            values,
            state,
            lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")),
        )["starts"]

    def by_piece(values: Column) -> Column:
        numbers = F.when(
            F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / PIECE).cast("int"))
        ).otherwise(F.array().cast("array<int>"))
        pieces = F.transform(numbers, lambda k: F.slice(values, k * PIECE + 1, F.lit(PIECE)))
        totals = lambda p: F.transform(p, lambda x: F.aggregate(x, F.lit(0), lambda a, n: a + n))
        return let(pieces, lambda p: F.flatten(F.zip_with(p, starts(totals(p), first), starts)))

    return let(sizes, by_piece)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as array<struct<role, text>>."""

    def turns(block: Column) -> Column:
        inner = F.substring(block, F.lit(len(START) + 1), F.char_length(block))
        role = unescape_role(F.substring_index(inner, "\n", 1))
        body = F.substring(inner, F.char_length(F.substring_index(inner, "\n", 1)) + 2, F.char_length(inner))
        return let(
            role,
            lambda r: F.transform(
                F.split(body, r"<\|turn\|>", -1),
                lambda x: F.struct(r.alias("role"), unescape(x).alias("text")),
            ),
        )

    blocks = F.split(formatted, r"<\|im_end\|>\n", -1)
    return let(blocks, lambda all_blocks: F.flatten(
        F.transform(F.slice(all_blocks, F.lit(1), F.size(all_blocks) - 1), turns)
    ))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    A substring is found by counting code points from the start, so the text is cut into chunks once
    and a span is taken from those it touches.
    """

    def cut(chunks: Column) -> Column:
        def part(s: Column) -> Column:
            first = F.floor((s["start"] - 1) / CHUNK).cast("int")
            last = F.floor((s["start"] + s["length"] - 1) / CHUNK).cast("int")
            touched = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
            return unescape(F.substring(touched, s["start"] - first * CHUNK, s["length"]))

        return F.array_join(F.transform(spans, part), "")

    return let(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), cut)
