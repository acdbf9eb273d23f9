"""Spelling variants: pairs of words one edit apart, by pivotal grams.

The bigrams of a word are ordered rare ones first.  One edit destroys at most
one of two disjoint bigrams, so of two words that are one edit apart, the one
whose first three bigrams end earlier in the order has a *pivot* that the
other has among its own first three; a pivot is one of two disjoint bigrams of
those three, chosen by dynamic programming for the least total frequency.

A bigram that both words have, with one edit between them, lies either after
the edit or before it.  Its place in the other word is therefore known, and
more: before the edit the words are equal up to and with it, after the edit
from it on.  That is the position limit here: a pivot meets a prefix gram
under the hash of its word's head or of its tail.  The pairs that meet are
compared once.

Where a head or tail is so common that its words would make too many pairs,
the words below it are divided once more, exactly: by the rest of the word as
it is and with each single code point left out.  Words one edit apart share
one of these, and no more words share one than there are letters to fill the
gap with.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import stage

from .common import bound_batches

#: Fixed values of the contract: letters of a run, where one is mistyped, and what counts as a word.
RUN = "[A-Za-zÀ-ÿ]+"
MISTYPED = 97
MIN_LETTERS = 5
MIN_COUNT = 3
#: A form has at least this many times the occurrences.
DOMINANT = 2
GRAM = 2
EDITS = 1
#: Grams of a word that are looked at: any GRAM * EDITS + 1 hold EDITS + 1 disjoint ones.
PREFIX = GRAM * EDITS + 1
#: Words under one head or tail above which they are divided.
CROWD = 200
#: Different words a task counts before it sends them on.
FLUSH = 200_000
#: Code points of a text taken at a time (up to the end of a run).
PIECE = 1 << 20


def count_words(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the runs of letters, A-Z lower-cased, with one code point left out where
    crc32(``<doc_id>:<run>``) is a multiple of MISTYPED; words of MIN_LETTERS and MIN_COUNT or more.

    Null texts have no runs; in a row without an id nothing is left out.  Repeated rows count again.
    A task sends every word it has seen once for each FLUSH different ones, so a word with a third of
    all occurrences is summed before the shuffle.  Lowers the session's Arrow batch size
    (``bound_batches``).
    """
    bound_batches(docs.sparkSession)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        runs = re.compile(RUN)
        counted: Counter[str] = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())],
                names=["word", "n"],
            )
            counted.clear()
            return batch

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                own: Counter[str] = Counter()
                if value.is_valid:
                    for piece in _pieces(value.as_py()):
                        # Only A-Z: the bytes of other letters stay.
                        own.update(runs.findall(piece.encode().lower().decode()))
                head = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                for run, n in own.items():
                    if head is not None and (h := zlib.crc32(run.encode(), head)) % MISTYPED == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= MIN_LETTERS:
                        counted[run] += n
                if len(counted) >= FLUSH:
                    yield flush()
        if counted:
            yield flush()

    sent = docs.select(F.col(doc).cast("long"), F.col(text)).mapInArrow(scan, "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _pieces(text: str) -> Iterator[str]:
    """The text in parts that cut no run."""
    if len(text) <= PIECE:
        yield text
        return
    gap = re.compile(RUN.replace("[", "[^", 1).rstrip("+"))
    start = 0
    while start < len(text):
        found = gap.search(text, min(start + PIECE, len(text)))
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def _grams(word: str) -> list[str]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def rare_first(word: str, order: dict[str, int]) -> tuple[list[int], list[int]]:
    """(prefix, pivots) as places in the word.

    The prefix has the first PREFIX grams by order, and all others that equal the last of them, so
    that it is a matter of grams and not of their places.
    """
    grams = _grams(word)
    by_order = sorted(range(len(grams)), key=lambda i: (order[grams[i]], i))
    first = by_order[:PREFIX]
    bound = order[grams[first[-1]]]
    prefix = [i for i in by_order if order[grams[i]] <= bound]
    return prefix, cheapest_disjoint(sorted(first), [order[grams[i]] for i in sorted(first)])


def cheapest_disjoint(places: list[int], weights: list[int], wanted: int = EDITS + 1) -> list[int]:
    """The ``wanted`` places, no two of which overlap, of least total weight.

    best[k] after a place is the cheapest choice of k so far; a place joins the best choice of k - 1
    among those that end at least GRAM before it.
    """
    best: list[list[tuple[int, list[int]] | None]] = []
    for j, place in enumerate(places):
        row: list[tuple[int, list[int]] | None] = list(best[-1]) if best else [(0, []), *[None] * wanted]
        ended = [i for i in range(j) if places[i] + GRAM <= place]
        before = best[ended[-1]] if ended else [(0, []), *[None] * wanted]
        for k in range(1, wanted + 1):
            if (prior := before[k - 1]) is not None:
                cost, chosen = prior[0] + weights[j], [*prior[1], place]
                if row[k] is None or cost < row[k][0]:
                    row[k] = cost, chosen
        best.append(row)
    found = best[-1][wanted]
    return found[1] if found else []


def _gram_order(words: DataFrame) -> dict[str, int]:
    """A number for every gram, rarest first.  Two letters out of 90: at most 8,100 grams."""
    places = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = F.transform(places, lambda i: F.substring("word", i, F.lit(GRAM)))
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    return {r["gram"]: i for i, r in enumerate(sorted(counted, key=lambda r: (r["count"], r["gram"])))}


def _entries(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """(word, key, rest, is_pivot, is_prefix): a row per chosen gram and side of it."""
    spark = words.sparkSession
    table = spark.sparkContext.broadcast(order)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: list[tuple] = []
            for word in batch.column(0).to_pylist():
                prefix, pivots = rare_first(word, table.value)
                for at in sorted({*prefix, *pivots}):
                    flags = at in pivots, at in prefix
                    out.append((word, "<" + word[: at + GRAM], word[at + GRAM :], *flags))
                    out.append((word, ">" + word[at:], word[:at], *flags))
            columns = list(zip(*out)) if out else [[]] * 5
            types = [pa.string()] * 3 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["word", "key", "rest", "is_pivot", "is_prefix"],
            )

    found = words.select("word").mapInArrow(
        scan, "word string, key string, rest string, is_pivot boolean, is_prefix boolean"
    )
    return found.withColumn("key", F.xxhash64("key"))


def _left_out(rest: Column) -> Column:
    """The rest as it is and with each code point left out."""
    places = F.when(F.char_length(rest) > 0, F.sequence(F.lit(1), F.char_length(rest))).otherwise(
        F.array().cast("array<int>")
    )
    cut = F.transform(places, lambda i: F.concat(F.left(rest, i - 1), F.substring(rest, i + 1, F.char_length(rest))))
    return F.array_distinct(F.transform(F.concat(F.array(rest), cut), lambda s: F.xxhash64(s)))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b, once each: the words that differ by one inserted, deleted or replaced code point.

    ``words`` has every ``word`` once, none null and none under MIN_LETTERS code points.
    """
    bound_batches(words.sparkSession)
    entries = stage(_entries(words, _gram_order(words)), "gram-entries")
    crowds = entries.groupBy("key").count().filter(F.col("count") > CROWD).select("key", F.lit(True).alias("is_crowd"))
    placed = stage(
        entries.join(crowds, "key", "left").withColumn(
            "part",
            F.explode(F.when(F.col("is_crowd"), _left_out(F.col("rest"))).otherwise(F.array(F.lit(0).cast("long")))),
        ).drop("rest", "is_crowd"),
        "placed-entries",
    )
    one = F.levenshtein("x", "y", EDITS) == EDITS
    met = (
        placed.filter("is_pivot").select("key", "part", F.col("word").alias("x"))
        .join(placed.filter("is_prefix").select("key", "part", F.col("word").alias("y")), ["key", "part"])
        .filter((F.col("x") != F.col("y")) & one)
    )
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n).

    ``form`` is the near word with most occurrences (ties: the smallest word) if it has at least
    DOMINANT times the word's; else null.  ``root`` follows forms to the last.  Occurrences at least
    double along forms, so no form leads back and a chain is no longer than the logarithm of the
    count; roots are found by doubling the way.  An empty table gives no rows.
    """
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_pairs(words), "near-words")
    ways = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = (
        ways.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
        .groupBy("a")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), "b")).alias("best"))
    )
    most = -F.col("best")["col1"]
    formed = stage(
        words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(most >= DOMINANT * F.col("n"), F.col("best")["b"]).alias("form"),
            F.when(most >= DOMINANT * F.col("n"), most).alias("form_n"),
        ),
        "forms",
    )
    way = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = way.join(on, "root", "left")
        way = stage(
            longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        if way.filter("moved").limit(1).count() == 0:
            break
        way = way.drop("moved")
    return formed.join(way.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
