"""Benchmark decontamination by spaced seeds, with DataFrame operations only.

A seed is a fixed mask over neighbouring tokens, for example ``1101011111``:
the tokens at a 1 are hashed together, those at a 0 are ignored, so a hash
still meets its partner when an ignored token was substituted.  Documents and
benchmark items are hashed under every mask; equal hashes are hits.  Around a
hit the item is laid over the document and both are compared token by token:
in every window of ``WINDOW`` tokens substitutions are tolerated as long as
``MIN_EQUAL`` of them are equal.  Wherever those substitutions are, one of the
masks meets none of them, so no overlap is lost before it is compared.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of

#: Weight 8; for any two tokens of a window some mask lies in it and reads neither.
MASKS = ("111110111", "1101011111", "11111001011", "111001100111", "110111111")
#: The same for whole items shorter than a window, by their tokens; the room takes lighter masks.
SHORT_MASKS = {
    9: ("111011", "1001111", "11010011", "111101"),
    10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
    11: ("11111011", "110101111", "111011101", "1101101011", "1100110111", "111110011", "1010011111"),
    12: ("11110111", "1100101111", "11011001011", "1111111", "11111101"),
}
#: Items with fewer tokens must be equal throughout.
SHORTEST = min(SHORT_MASKS)
WINDOW = 13
MIN_EQUAL = 11
#: A seed row is about 100 bytes in memory; above this many the join is not broadcast, and the
#: documents' seeds are shuffled without the tokens they stand in.
BROADCAST_ROWS = 200_000


def covers(masks: tuple[str, ...], length: int, missing: int) -> bool:
    """Whether ``masks`` meet all of ``length`` tokens with up to ``missing`` substitutions."""
    placed = [
        {at + i for i, c in enumerate(m) if c == "1"}
        for m in masks
        for at in range(length - len(m) + 1)
    ]
    return all(
        any(p.isdisjoint(gone) for p in placed) for gone in combinations(range(length), missing)
    )


def _seed_hash(hashes: Column, at: Column, mask: str, which: int) -> Column:
    on = [i for i, c in enumerate(mask) if c == "1"]
    return F.xxhash64(F.lit(which), *(F.get(hashes, at + i) for i in on))


def _token_hashes(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, row, hashes.  The row number keeps equal ids apart, and filters above this
    projection from being pushed below it, which would hash every text twice."""
    return df.select(
        F.col(key).alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("hashes"),
    )


def _seeds(df: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """A row for every mask at every position it fits, with its ``seed``."""
    last = F.size("hashes") - min(map(len, masks))
    placed = df.select(
        "*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at")
    )
    # A mask that hangs over the end has no seed.
    seeds = (
        F.when(
            F.col("at") + len(m) <= F.size("hashes"),
            _seed_hash(F.col("hashes"), F.col("at"), m, i),
        )
        for i, m in enumerate(masks)
    )
    return placed.select("*", F.explode(F.array(*seeds)).alias("seed")).filter("seed IS NOT NULL")


def _laid_over(docs: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """One row per document row, item row and alignment: the tokens under the item."""
    seeds = _seeds(items, masks).select(
        F.col("row").alias("item_row"),
        F.col("at").alias("item_at"),
        F.size("hashes").alias("n_item"),
        "seed",
    )
    under = (
        "slice(hashes, greatest(1, doc_start + 1), greatest(0, least("
        "size(hashes) - greatest(0, doc_start), n_item - greatest(0, -doc_start))))"
    )
    start = (F.col("at") - F.col("item_at")).alias("doc_start")
    found = ["row", "item_row", "doc_start"]
    if seeds.count() <= BROADCAST_ROWS:
        hits = _seeds(docs, masks).join(F.broadcast(seeds), "seed").select("*", start)
        return (
            hits.select(F.col("key").alias("doc"), *found, F.expr(under).alias("under"))
            .groupBy("doc", *found)
            .agg(F.first("under").alias("under"))
        )
    # The row's number is made of the row, so that it is the same on both sides of the second join.
    docs = docs.withColumn("row", F.xxhash64("key", "hashes"))
    hits = (
        _seeds(docs, masks).select("row", "at", "seed").join(seeds, "seed").select("row", "item_row", "n_item", start)
    ).distinct()
    return docs.dropDuplicates(["row"]).join(hits, "row").select(
        F.col("key").alias("doc"), *found, F.expr(under).alias("under")
    )


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    doc_text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    min_equal: int = MIN_EQUAL,
) -> DataFrame:
    """Overlaps of documents with benchmark items: one row per pair and alignment.

    ``doc``, ``item``, ``doc_start`` (token of the document under the item's
    first, negative if that hangs over), ``n_equal`` (equal tokens where the two
    lie over each other), ``n_item`` (the item's tokens) and ``best_window``
    (most equal tokens in a window).  An overlap needs ``min_equal`` equal
    tokens in some window of ``window``; an item shorter than a window may
    miss as many tokens as a window may, and one of fewer than ``SHORTEST``
    tokens none.  All such overlaps are found; masks that would lose some of them
    raise ValueError.

    Tokens are lower-case words between white space.  Null and blank texts
    overlap with nothing, null ids stay null, repeated rows give one row.
    Other columns are ignored.  Empty tables give no rows.  Items shorter than a
    window are looked for by their length, of which there are only twelve.
    """
    missing = window - min_equal
    if not covers(masks, window, missing):
        raise ValueError(f"masks lose overlaps of {min_equal} equal tokens in a window of {window}")
    # The items are hashed once more by each branch below, so fix their rows first.
    items = items.select(F.col(item).alias("key"), F.col(item_text).alias("text")).distinct()
    hashed_items = _token_hashes(items, "key", "text").withColumn(
        "row", F.xxhash64("key", "hashes")
    )
    hashed_docs = _token_hashes(docs, doc, doc_text)
    laid = _laid_over(hashed_docs, hashed_items.filter(F.size("hashes") >= window), masks)
    short = hashed_items.filter((F.size("hashes") > 0) & (F.size("hashes") < window))
    for (length,) in short.select(F.size("hashes")).distinct().collect():
        own = ("1" * length,) if length < SHORTEST else SHORT_MASKS.get(length, masks)
        if length >= SHORTEST and not covers(own, length, missing):
            raise ValueError(f"no masks for items of {length} tokens of which {missing} may differ")
        laid = laid.unionByName(
            _laid_over(hashed_docs, short.filter(F.size("hashes") == length), own)
        )

    def most_equal(equal: Column) -> Column:
        """The most equal tokens in a window; all of them if there is only one."""
        start = F.aggregate(F.slice(equal, 1, window), F.lit(0), lambda a, x: a + x)
        moves = F.when(
            F.size(equal) > window, F.sequence(F.lit(0), F.size(equal) - window - 1)
        ).otherwise(F.array().cast("array<int>"))

        def move(a: Column, i: Column) -> Column:
            now = a["now"] - F.get(equal, i) + F.get(equal, i + window)
            return F.struct(now.alias("now"), F.greatest(a["best"], now).alias("best"))

        both = F.struct(start.alias("now"), start.alias("best"))
        return F.aggregate(moves, both, move)["best"]

    compared = laid.join(
        hashed_items.select(
            F.col("row").alias("item_row"), F.col("key").alias("item"), F.col("hashes").alias("whole")
        ),
        "item_row",
    ).select(
        "doc",
        "item",
        "doc_start",
        F.size("whole").alias("n_item"),
        F.zip_with(
            "under",
            F.slice("whole", F.greatest(F.lit(0), -F.col("doc_start")) + 1, F.size("under")),
            lambda a, b: (a == b).cast("int"),
        ).alias("equal"),
    )
    return (
        compared.select(
            F.col("doc").alias(doc),
            F.col("item").alias(item),
            "doc_start",
            F.aggregate("equal", F.lit(0), lambda a, x: a + x).alias("n_equal"),
            "n_item",
            most_equal(F.col("equal")).alias("best_window"),
        )
        .filter(
            F.col("best_window")
            >= F.when(F.col("n_item") < SHORTEST, F.col("n_item")).otherwise(
                F.least(F.lit(window), F.col("n_item")) - (window - min_equal)
            )
        )
        .distinct()
    )
