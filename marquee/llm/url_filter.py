"""URL filter: a blocked Bloom filter before an exact hash join.

Keys of two kinds are listed: canonical URLs that are blocked, and rules of a
host and a path prefix.  Every listed key sets eight bits in one block of 256;
a URL's candidate keys are looked up in their block, and only possible hits
go on to the exact join with the list, which removes false positives.  The
filter's size follows the number of keys, two bytes each.  Up to ``MAX_BLOCKS``
blocks (32 bytes each, so 4 MiB) it is broadcast; that of a longer list is a
table by block, which candidates are joined with on their block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 17
BITS_PER_KEY = 16
BLOCK_BITS = 256
#: Query parameters that only track: they are no part of a canonical URL.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without port 80 or 443, path without its last slash, other parameters sorted.

    Scheme, fragment and tracking parameters go.  Empty without ``://``.
    """
    query = F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(
            F.split(query, "&"),
            lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING),
        )
    )
    return F.coalesce(
        F.concat(
            F.regexp_replace(host_of(url), r":(80|443)$", ""),
            F.regexp_replace(path_of(url), r"/$", ""),
            F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""),
        ),
        F.lit(""),
    )


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), blocks)


def _mask(key: Column, word: int) -> Column:
    """Two bits of one of the block's four words."""
    h = F.xxhash64(key, F.lit(2))
    bits = []
    for at in (12 * word, 12 * word + 6):
        low = F.shiftright(h, at).bitwiseAND(F.lit(63)).cast("int")
        bits.append(_one_left(low))
    return bits[0].bitwiseOR(bits[1])


def _one_left(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n)


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The blocked filter as rows (block, w0, w1, w2, w3); at most ``blocks`` of them."""
    return keys.groupBy(_block(F.col(key), F.lit(blocks)).alias("block")).agg(
        *(F.bit_or(_mask(F.col(key), w)).alias(f"w{w}") for w in range(4))
    )


def possible_hits(candidates: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The candidates whose bits are all set in their block."""
    bloom = bloom.withColumnRenamed("block", "_block")
    if blocks <= MAX_BLOCKS:
        bloom = F.broadcast(bloom)
    probed = candidates.withColumn("_block", _block(F.col(key), F.lit(blocks))).join(bloom, "_block")
    hit = F.lit(True)
    for w in range(4):
        mask = _mask(F.col(key), w)
        hit = hit & (F.col(f"w{w}").bitwiseAND(mask) == mask)
    return probed.filter(hit).select(*candidates.columns)


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    page: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page``, host, path, rule, verdict, and whether the URL itself ``is_listed``.

    ``rules`` has (host, path, verdict); a rule fits its host and all
    subdomains if the URL's path starts with the rule's.  The longest rule
    wins, among equals the one with the longer host, then the first by text.
    Where none fits, the verdict is ``block`` for a URL whose canonical form is
    in ``listed`` (column ``url``, canonical), else ``allow``.

    Of a host only as many of its last labels are looked at as the longest rule's host has, so a URL
    of many labels takes time in proportion to its length.

    A null URL or one without ``://`` has an empty host and path and no
    candidates; it is allowed.  Every different URL is judged once; repeated rows
    get one result row each.  Null rules and listed URLs are ignored.  Other columns of ``pages``
    are ignored.  Empty tables work.
    """
    rules = (
        rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .withColumn("host", host_of(F.concat(F.lit("x://"), F.col("host"))))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block before allow
    )
    keys = rules.select(
        F.concat(F.lit("r:"), "host", "path").alias("key"),
        F.concat("host", "path").alias("rule"),
        F.char_length("host").alias("host_chars"),
        "verdict",
    ).unionByName(
        listed.filter("url IS NOT NULL AND url <> ''").select(F.concat(F.lit("u:"), "url").alias("key")).distinct(),
        allowMissingColumns=True,
    )
    # One count; the most labels of a rule's host; the distinct lengths of rule paths, no more than the longest has.
    size = keys.count()
    shapes = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.char_length("path")).alias("lengths")
    ).first()
    most, lengths = shapes["labels"] or 0, sorted(shapes["lengths"])
    blocks = max(1, -(-size * BITS_PER_KEY // BLOCK_BITS))

    urls = (
        pages.select(F.col(url).alias("_url")).filter("_url IS NOT NULL").distinct()
    ).select(
        "_url",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        canonical(F.col("_url")).alias("_canonical"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - (most - 1)), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    # One value however many lengths there are.
    listed_lengths = F.filter(F.split(F.lit(",".join(map(str, lengths))), ","), lambda n: n != "").cast("array<int>")
    prefixes = F.transform(
        F.filter(listed_lengths, lambda n: n <= F.char_length("path")), lambda n: F.left("path", n)
    )
    rule_keys = F.flatten(
        F.transform(
            suffixes if most else F.array().cast("array<string>"),
            lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r:"), s, p)),
        )
    )
    all_keys = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
        F.concat(rule_keys, F.array(F.concat(F.lit("u:"), "_canonical")))
    )
    candidates = urls.select("_url", F.explode(F.array_distinct(all_keys)).alias("key"))
    hits = possible_hits(candidates, "key", bloom_blocks(keys, "key", blocks), blocks)
    best = (
        hits.join(keys, "key")  # exact: equal text
        .groupBy("_url")
        .agg(
            F.max(
                F.when(
                    F.col("rule").isNotNull(),
                    F.struct(F.char_length("rule").alias("n"), "host_chars", "rule", "verdict"),
                )
            ).alias("best"),
            F.max(F.col("rule").isNull()).alias("is_listed"),
        )
    )
    return (
        pages.select(F.col(page).alias("_page"), F.col(url).alias("_url"))
        .join(best, "_url", "left")
        .select(
            F.col("_page").alias(page),
            host_of(F.col("_url")).alias("host"),
            path_of(F.col("_url")).alias("path"),
            F.col("best.rule").alias("rule"),
            F.coalesce(
                F.col("best.verdict"),
                F.when(F.col("is_listed"), F.lit("block")).otherwise(F.lit("allow")),
            ).alias("verdict"),
            F.coalesce("is_listed", F.lit(False)).alias("is_listed"),
        )
    )
