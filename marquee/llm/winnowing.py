"""Document fingerprints by winnowing, with DataFrame functions only.

Every run of ``GRAM`` neighbouring words has a rolling (Karp-Rabin) hash; of
each ``WINDOW`` neighbouring hashes the smallest is kept, the rightmost one
where several are smallest, with its place in the text.  Whatever two texts
have in common over ``GRAM + WINDOW - 1`` words or more is then found: both
keep the same hash inside it, equally far from its start.  Nothing shorter
than ``GRAM`` words is ever matched.

Words stand between white space; a run without any counts as a word for every
``LONGEST`` code points, so texts in scripts without spaces have words too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import stage

from .ranks import following

#: Words of a hashed run.
GRAM = 3
#: Neighbouring hashes of which one is kept.
WINDOW = 4
#: Code points of a word.
LONGEST = 32
WORD = rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}"
#: Hashes are modulo this prime; the base is any number below it.
PRIME = (1 << 31) - 1
BASE = 911_382_323
#: A kept hash and its place are one number, place * 2^31 + hash.
HASH_BITS = 31


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def word_codes(text: Column) -> Column:
    """A number below 2^28 for every word: the first seven digits of its md5."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.conv(F.left(F.md5(w), F.lit(7)), 16, 10).cast("long"))


def gram_hashes(codes: Column, gram: int = GRAM) -> Column:
    """Hashes of all runs of ``gram`` words: the sum of code * BASE ** (gram - 1 - i) modulo PRIME.

    Fewer words have one hash, as if words of 0 followed; none have none.
    """
    powers = [pow(BASE, gram - 1 - j, PRIME) for j in range(gram)]

    def at(values: Column) -> Callable[[Column, Column], Column]:
        def hashed(code: Column, i: Column) -> Column:
            total = code * _long(powers[0])
            for j in range(1, gram):
                # Below 2^28 * 2^31 each: sixteen fit before the modulus is due.
                term = F.coalesce(F.get(values, i + j), _long(0)) * _long(powers[j])
                total = total + term if j % 15 else total % _long(PRIME) + term
            return total % _long(PRIME)

        return hashed

    whole = F.greatest(F.size(codes) - (gram - 1), F.lit(1))
    return F.slice(F.transform(codes, at(codes)), F.lit(1), whole)


def _window_minima(values: Column, window: int) -> Column:
    """The minimum of each ``window`` neighbours; of all of them where there are fewer."""
    low = F.transform(values, lambda v, i: F.least(v, *(F.get(values, i + j) for j in range(1, window))))
    return F.slice(low, F.lit(1), F.greatest(F.size(values) - (window - 1), F.lit(1)))


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The kept hashes of a text as an array of long, place * 2^31 + hash, by place (a word's number, from 0).

    A null text and one without words keep none.  A text of fewer than ``gram`` words keeps one
    hash, one with fewer than ``window`` hashes their minimum.  Equal texts keep the same.  Takes
    time in proportion to the text's length, and memory of some 200 bytes for each of its words.
    """
    if gram < 2 or window < 2:
        raise ValueError("a gram and a window have two members or more")
    last = (1 << HASH_BITS) - 1

    def kept(codes: Column) -> Column:
        # Smaller hash first, then the place further right.
        marked = F.transform(
            gram_hashes(codes, gram), lambda h, i: F.shiftleft(h, HASH_BITS) + (_long(last) - i)
        )
        return _let(marked, lambda v: F.array_distinct(_window_minima(v, window)))

    placed = F.transform(
        _let(word_codes(text), kept),
        lambda v: F.shiftleft(_long(last) - v.bitwiseAND(_long(last)), HASH_BITS) + F.shiftright(v, HASH_BITS),
    )
    return F.coalesce(placed, F.array().cast("array<bigint>"))


def hashes(kept: Column) -> Column:
    """The different hashes of a fingerprint, without their places."""
    return F.array_distinct(F.transform(kept, lambda v: v.bitwiseAND(_long(PRIME)).cast("int")))


def as_text(kept: Column) -> Column:
    """``hash@place`` of every kept hash, by place, parted by spaces."""
    entry = lambda v: F.concat(
        v.bitwiseAND(_long(PRIME)).cast("string"), F.lit("@"), F.shiftright(v, HASH_BITS).cast("string")
    )
    return F.array_join(F.transform(kept, entry), " ")


def likeness(a: Column, b: Column) -> Column:
    """Of the different hashes of two ``hashes`` arrays the share that both have; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def with_next(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, next_id, next_head, next_hashes``: every row and the document that follows by descending id.

    ``next_head`` has the first code points of the next text, half as many as the row's own (more if
    rows share the id), ``next_hashes`` the ``hashes`` of its fingerprint.

    After the smallest id the largest follows; a single one follows itself.  A null id is the
    smallest, a null text empty.  Rows that share an id share their next document, and the one of
    them with the least xxhash64 of its text stands for the id as somebody's next.  Other columns
    are not read; an empty table gives no rows.  Texts are shuffled by id once, for both sides of
    the last join; an id with very many rows is a skewed key of an inner join, which adaptive
    execution splits.
    """
    base = docs.select(
        F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("key", _key("doc_id"))
    ids = base.groupBy("doc_id").agg(
        F.min(F.xxhash64("text")).alias("stands"), F.max(_half(F.col("text"))).alias("half")
    )
    ids = stage(following(stage(ids, "ids"), "doc_id", "sorted-ids"), "next-ids")
    wanted = ids.select(_key("next").alias("key"), _key("doc_id").alias("before"), "half").join(
        ids.select(_key("doc_id").alias("key"), "stands"), "key"
    )
    # No second join key: the exchange by key alone serves both joins.
    is_stand = F.xxhash64("text").bitwiseXOR(F.col("stands")) == 0
    heads = (
        base.join(wanted, "key")
        .filter(is_stand)
        .select(
            F.col("before").alias("key"),
            F.col("doc_id").alias("next_id"),
            F.left("text", F.col("half")).alias("next_head"),
            hashes(fingerprint(F.col("text"))).alias("next_hashes"),
        )
        .groupBy("key")
        .agg(*(F.first(c).alias(c) for c in ("next_id", "next_head", "next_hashes")))  # repeated rows are alike
    )
    return base.join(heads, "key").drop("key")


def _key(column: str) -> Column:
    """An id for joins, never null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _half(text: Column) -> Column:
    return F.floor(F.char_length(text) / 2).cast("int")


def edited(text: Column, head: Column) -> Column:
    """The text with its last half, floor(n / 2) code points, replaced by as many of ``head``, or all it has."""
    half = _half(text)
    return F.concat(F.left(text, F.char_length(text) - half), F.left(head, half))
