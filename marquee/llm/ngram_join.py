"""Jaccard self-join of documents on word n-grams by rare-first prefixes.

Shingles of a document are ordered rare ones first; two sets with a Jaccard
similarity of ``t`` share a shingle among the first ``n - ceil(t n) + 1`` of
each.  The steps:

1. One pass over the texts gives every row a key of its word sequence, so that
   copies are one class from here on, and counts in how many texts shingles
   occur.  Only those in many texts need their count for the order; they are at
   most ``MAX_FREQUENT`` and become a table every task gets.
2. A second pass emits the prefixes.  Equal prefix shingles meet in a bucket of
   hashes, where pairs pass the length and the positional filter.  In groups of
   more than ``SMALL_GROUP`` texts all are at first paired only with the first
   ``LEADERS`` of about their length: those with the fewest rare shingles of
   their own, which are closest to what the group has in common.
3. Pairs are made distinct and pass the suffix filter: shingles are
   divided by hash, and the differences of the parts' sizes bound the distance.
4. Each pair left is verified once, on whole sets; components follow.
5. In the large groups, pairs between *different* components are then all
   filtered and verified, which makes the components whole: within one no
   further link can change it.
6. The pairs of the large groups *inside* components are filtered and verified
   in blocks, which makes the links whole.  Nothing of this runs where only
   the components are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import stage

from .common import bit_table, bits_for, bound_batches, give_back, marked
from .graph import components
from .shingles import SHINGLE, shingle_sets, text_key

#: Similarity in hundredths: linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles with a known count; eight bytes and a count each.
MAX_FREQUENT = 500_000
#: Counts up to this are never told apart.
RARE = 8
SMALL_GROUP = 12
LEADERS = 2
#: Texts of a large group that are paired at a time.
GROUP_BLOCK = 256
#: Shingles a task collects before it sends them on: 6 MB of entries, held a few times over.
FLUSH = 250_000
#: A bucket should get about this many shingles or prefix entries.
PER_BUCKET = 400_000
#: Buckets a task works on one after another, of shingles and of prefix entries: about 16 MB read.  Each
#: task writes a file, for which a JVM without Hadoop's native library starts processes.
SHINGLE_BUCKETS = 8
PREFIX_BUCKETS = 2

#: An odd factor: among rare shingles a prefix has the least hashes, which would crowd the first buckets.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_ENTRY = np.dtype([("h", "<u8"), ("key", "<i8"), ("n", "<u4"), ("pos", "<u4")])


def _texts(column) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]


def _parts(s: np.ndarray) -> int:
    """The sizes of four parts of a set, by the hash's last bits, 15 bits each."""
    sizes = np.minimum(np.bincount((s & np.uint64(3)).astype(np.int64), minlength=4), 32767)
    return int(sum(int(v) << (15 * i) for i, v in enumerate(sizes)))


def _tasks(buckets: int, each: int) -> int:
    """How many tasks share the buckets; with few buckets each has its own."""
    return max(min(16, buckets), -(-buckets // each))


def _first(bucket: int, buckets: int) -> int:
    """The least hash of a bucket; buckets are equal ranges of hashes."""
    return bucket * ((1 << 64) // buckets + 1)


def _bucket_rows(h: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes."""
    edges = np.array([_first(b, buckets) for b in range(buckets)], dtype=np.uint64)
    at = [*np.searchsorted(h, edges).tolist(), len(h)]
    for b in range(buckets):
        if at[b] < at[b + 1]:
            yield b, at[b], at[b + 1]


def _profile(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """Rows of two kinds: (doc_id, key, n, parts) of a text; or (h, df) of a frequent shingle."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["bucket", "docs", "ones", "many", "counts"]
        seen: set[int] = set()
        held: list[np.ndarray] = []
        amount = 0

        def send(bucket, docs=None, ones=None, many=None, counts=None):
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32())]
                + [
                    pa.array(x if x is not None else [None] * len(bucket), pa.binary())
                    for x in (docs, ones, many, counts)
                ],
                names=names,
            )

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            once = counts == 1
            ones, many, times = values[once], values[~once], counts[~once].astype("<u4")
            rows: dict[int, list] = {}
            for b, i, j in _bucket_rows(ones, buckets):
                low = np.uint64(_first(b, buckets) >> 20)
                rows.setdefault(b, [None] * 3)[0] = ((ones[i:j] >> np.uint64(20)) - low).astype("<u8")
            for b, i, j in _bucket_rows(many, buckets):
                rows.setdefault(b, [None] * 3)[1:] = many[i:j], times[i:j]
            b = list(rows)
            # 44 bits a hash: one of 16 buckets or more gives four, five bytes hold the others.
            ones = [
                None if (x := rows[k][0]) is None
                else np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()
                for k in b
            ]
            many = [None if rows[k][1] is None else rows[k][1].tobytes() for k in b]
            times = [None if rows[k][2] is None else rows[k][2].tobytes() for k in b]
            return send(b, None, ones, many, times)

        for batch in batches:
            texts = _texts(batch.column(1))
            sets = shingle_sets(texts, size)
            rows, home = [], []
            for doc, text, s in zip(batch.column(0).to_pylist(), texts, sets):
                key = text_key(text)
                rows.append((doc is None, doc or 0, key, len(s), _parts(s)))
                home.append(key % buckets)
                if key not in seen:
                    # Copies in this task count once; the set of keys stays small beside texts.
                    seen.add(key)
                    held.append(s)
                    amount += len(s)
            flat = np.array(rows, "<i8").reshape(-1, 5)
            yield send(home, [r.tobytes() for r in flat])
            if amount >= FLUSH:
                yield flush()
                amount = 0
        if held:
            yield flush()
        give_back()

    def merge(batches: Iterator) -> Iterator:
        """Over the rows of one partition, which holds whole buckets one after another."""
        import pyarrow as pa

        def rows(kind, doc, a, n, b):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(a), kind), pa.int32()),
                    doc,
                    pa.array(a, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(b, pa.int64()),
                ],
                names=["kind", "doc_id", "a", "n", "parts"],
            )

        def counted(bucket, ones, many, times):
            five = np.frombuffer(b"".join(ones), np.uint8).reshape(-1, 5)
            wide = np.zeros((len(five), 8), np.uint8)
            wide[:, :5] = five
            ones = wide.view("<u8").ravel() + np.uint64(_first(bucket, buckets) >> 20)
            many = np.frombuffer(b"".join(many), "<u8") >> np.uint64(20)
            values = np.concatenate([ones, many])
            weight = np.concatenate(
                [np.ones(len(ones)), np.frombuffer(b"".join(times), "<u4").astype(float)]
            )
            order = np.argsort(values, kind="stable")
            values, weight = values[order], weight[order]
            first = np.flatnonzero(np.diff(values, prepend=values[:1] - np.uint64(1)))
            df = np.add.reduceat(weight, first) if len(first) else np.empty(0)
            often = df > RARE
            return rows(
                1,
                pa.nulls(int(often.sum()), pa.int64()),
                values[first][often].astype(np.int64),
                df[often].astype(np.int64),
                np.zeros(int(often.sum()), np.int64),
            )

        now, held = -1, ([], [], [])
        for batch in batches:
            raw = b"".join(x for x in batch.column(1).to_pylist() if x is not None)
            if raw:
                d = np.frombuffer(raw, "<i8").reshape(-1, 5)
                yield rows(0, pa.array(d[:, 1], pa.int64(), mask=d[:, 0] == 1), d[:, 2], d[:, 3], d[:, 4])
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4)]
            for bucket, ones, many, times in zip(*columns):
                if ones is None and many is None:
                    continue
                if bucket != now and any(held):
                    yield counted(now, *held)
                    held = [], [], []
                now = bucket
                if ones is not None:
                    held[0].append(ones)
                if many is not None:
                    held[1].append(many)
                    held[2].append(times)
        if any(held):
            yield counted(now, *held)
        del held
        give_back()

    spark = docs.sparkSession
    bound_batches(spark)
    sent = docs.mapInArrow(scan, "bucket int, docs binary, ones binary, many binary, counts binary")
    tasks = _tasks(buckets, SHINGLE_BUCKETS)
    return sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        merge, "kind int, doc_id long, a long, n long, parts long"
    )


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles (44 bits) in more texts than a bound that leaves MAX_FREQUENT, and their counts."""
    levels = (
        counts.groupBy(F.floor(F.log2("n")).alias("level")).count().orderBy(F.desc("level")).collect()
    )
    bound, kept = None, 0
    for r in levels:
        kept += r["count"]
        if kept > MAX_FREQUENT:
            break
        bound = 1 << r["level"]
    if bound is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    table = counts.filter(F.col("n") >= bound).select("a", "n").toPandas().sort_values("a")
    return table["a"].to_numpy().astype(np.uint64), table["n"].to_numpy()


def _prefix_pairs(docs: DataFrame, frequent, size: int, buckets: int, percent: int) -> DataFrame:
    """Candidate pairs (kind 0: a, b), and the entries of large groups (kind 1)."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        often, df = table.value
        seen: set[int] = set()
        held: list[np.ndarray] = []
        amount = 0

        def flush():
            entries = np.concatenate(held)
            held.clear()
            entries = entries[np.argsort(entries["h"], kind="stable")]
            rows = list(_bucket_rows(entries["h"], buckets))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in rows], pa.int32()),
                    pa.array([entries[i:j].tobytes() for _, i, j in rows], pa.binary()),
                ],
                names=["bucket", "entries"],
            )

        for batch in batches:
            texts = _texts(batch.column(1))
            for text, s in zip(texts, shingle_sets(texts, size)):
                n = len(s)
                if not n:
                    continue
                key = text_key(text)
                if key in seen:
                    continue
                seen.add(key)
                take = n - -(-percent * n // 100) + 1
                if len(often):
                    counted = s >> np.uint64(20)
                    at = np.minimum(np.searchsorted(often, counted), len(often) - 1)
                    hit = np.flatnonzero(often[at] == counted)
                    if len(hit):
                        # Frequent ones last, by count and hash; the sort is stable.
                        weight = np.zeros(n, np.int64)
                        weight[hit] = df[at[hit]]
                        s = s[np.argsort(weight, kind="stable")]
                e = np.empty(take, _ENTRY)
                e["h"], e["key"], e["n"], e["pos"] = s[:take] * _SPREAD, key, n, np.arange(take)
                held.append(e)
                amount += take
            if amount >= FLUSH:
                yield flush()
                amount = 0
        if held:
            yield flush()
        give_back()

    def meet(batches: Iterator) -> Iterator:
        """Over the rows of one partition, which holds whole buckets one after another."""
        import pyarrow as pa

        def rows(kind, *columns):
            columns = [np.ascontiguousarray(c).astype(np.int64) for c in columns]
            columns += [np.zeros(len(columns[0]), np.int64)] * (4 - len(columns))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(columns[0]), kind), pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns],
                names=["kind", "a", "b", "n", "pos"],
            )

        def met(raw):
            e = np.frombuffer(b"".join(raw), _ENTRY)
            e = e[np.lexsort((e["key"], e["n"], e["h"]))]
            same = (e["h"][1:] == e["h"][:-1]) & (e["key"][1:] == e["key"][:-1])
            e = e[np.concatenate([[True], ~same])]  # copies from different tasks
            first = np.flatnonzero(np.concatenate([[True], e["h"][1:] != e["h"][:-1]]))
            group = np.diff(first, append=len(e))
            large = np.repeat(group > SMALL_GROUP, group)
            more = np.repeat(group, group) > 1
            e, large = e[more], large[more]
            found = []
            for d in range(1, SMALL_GROUP):
                x, y = e[:-d], e[d:]
                near = (x["h"] == y["h"]) & ~large[d:]
                if not near.any():
                    break
                found.append(_likely(x[near], y[near], percent))
            big = e[large]
            if len(big):
                found += _with_leaders(big, percent)
            if found:
                pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
                yield rows(0, pairs[:, 0], pairs[:, 1])
            if len(big):
                yield rows(1, big["h"], big["key"], big["n"], big["pos"])

        now, held = -1, []
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now and held:
                    yield from met(held)
                    held = []
                now = bucket
                held.append(raw)
        if held:
            yield from met(held)
        del held
        give_back()

    return (
        docs.mapInArrow(scan, "bucket int, entries binary")
        .repartition(_tasks(buckets, PREFIX_BUCKETS), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(meet, "kind int, a long, b long, n long, pos long")
    )


def _likely(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    passed = _may_link(x, y, percent)
    return np.stack([x["key"][passed], y["key"][passed]], axis=1)


def _with_leaders(e: np.ndarray, percent: int) -> list[np.ndarray]:
    """Pairs with the leaders of each length class of a group, and leaders of neighbour classes."""
    level = (np.log(e["n"]) / np.log(1.1)).astype(np.int64)
    order = np.lexsort((e["key"], e["pos"], level, e["h"]))
    e, level = e[order], level[order]
    fresh = np.concatenate([[True], (e["h"][1:] != e["h"][:-1]) | (level[1:] != level[:-1])])
    first = np.flatnonzero(fresh)
    own = np.repeat(first, np.diff(first, append=len(e)))
    found = []
    for k in range(LEADERS):
        lead = np.minimum(own + k, len(e) - 1)
        ok = (e["h"][lead] == e["h"]) & (level[lead] == level) & (lead < np.arange(len(e)))
        found.append(_likely(e[lead[ok]], e[ok], percent))
    above, below = first[1:], first[:-1]
    ok = e["h"][above] == e["h"][below]
    found.append(_likely(e[below[ok]], e[above[ok]], percent))
    return found


def _may_link(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Length and positional filter."""
    n, m = x["n"].astype(np.int64), y["n"].astype(np.int64)
    rest = np.minimum(n - x["pos"], m - y["pos"])
    need = -(-percent * (n + m) // (100 + percent))
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (rest >= need)


def _suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets may be close enough by the sizes of their parts."""
    left = classes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa"))
    right = classes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb"))

    def part(c: str, i: int):
        return F.shiftright(c, 15 * i).bitwiseAND(F.lit(32767))

    distance = sum((F.abs(part("pa", i) - part("pb", i)) for i in range(4)), F.lit(0))
    need = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent) - 1e-9)
    # A part of 32767 may be larger, so such texts pass.
    full = sum(((part(c, i) == 32767).cast("int") for c in ("pa", "pb") for i in range(4)), F.lit(0))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter((full > 0) | (distance <= F.col("na") + F.col("nb") - 2 * need))
        .select("a", "b")
    )


def _may_be_wanted(docs: DataFrame, ids: DataFrame, texts: int) -> DataFrame:
    """All rows of ``docs`` whose doc_id is in ``ids``, and few others, found without a shuffle of them.

    Ids are hashed to as many bits as the number of ``texts`` asks for.
    """
    bits = bits_for(texts)
    return marked(docs, "doc_id", bit_table(ids, "doc_id", bits), bits)


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are linked."""
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
    ids = (
        wanted.distinct()
        .join(classes, "key")
        .filter("smallest IS NOT NULL")
        .select(F.col("smallest").alias("doc_id"))
        .distinct()
    )
    # Only texts that may be wanted are shuffled for the exact join; those that have no id anywhere
    # are read whole, and the join by key below picks them.  A semi join would be moved before the first.
    rows = (
        _may_be_wanted(docs, ids, classes.count())
        .join(ids, "doc_id")
        .unionByName(docs.filter("doc_id IS NULL"))
    )

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = _texts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([text_key(t) for t in texts], pa.int64()),
                    pa.array([s.tobytes() for s in shingle_sets(texts, size)], pa.binary()),
                ],
                names=["key", "shingles"],
            )

    sets = (
        rows.mapInArrow(scan, "key long, shingles binary")
        .groupBy("key")
        .agg(F.first("shingles").alias("shingles"))
    )
    both = pairs.join(
        sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a"
    ).join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(x.as_buffer(), "<u8")
                y = np.frombuffer(y.as_buffer(), "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            kept = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            yield kept

    return both.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def _inside(with_root: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of the large groups whose texts are in one component, block by block."""
    groups = with_root.groupBy("h").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("blocks"))
    placed = (
        with_root.join(groups, "h")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
    )
    at, each = ["h", "root", "i", "j"], ("key", "n", "pos", "block")
    x = placed.select(*at, *(F.col(c).alias(c + "1") for c in each))
    y = placed.select(*at, *(F.col(c).alias(c + "2") for c in each))
    need = F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent) - 1e-9)
    return (
        x.join(y, at)
        .filter(
            (F.col("key1") < F.col("key2"))
            & ((F.col("i") == F.col("j")) | (F.col("block1") != F.col("block2")))
            & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
            & (F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2")) >= need)
        )
        .select(F.col("key1").alias("a"), F.col("key2").alias("b"))
        .distinct()
    )


def join_similar(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the similarity join.

    ``members`` has a row per row of ``docs``: ``doc_id``, ``key`` (of the word sequence; equal
    for copies), ``n_shingles``, ``component_id`` (smallest doc_id reachable by links, its own
    included).  ``links`` has every linked pair (a, b) of different keys once, a < b; copies are
    linked by their key.  In a large group of near copies that is a row for each two of them, so
    the pairs inside components are verified only when ``links`` is read.

    Texts with fewer than ``size`` words have their whole sequence as one shingle.  Null and blank
    texts have no shingles and are linked with nothing, not even each other.  A null id stays null
    and never names a component unless no member has an id.  Repeated rows are copies.  Other
    columns are ignored.  An empty table gives no rows.  Keys have 64 bits: among 10^9 different
    texts two share one with a chance of 3 in 100, and would then be taken for copies.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # About one shingle for six characters; only the order of magnitude matters.
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-chars // (6 * PER_BUCKET)))
    found = stage(_profile(docs, size, buckets), "profile")
    rows = found.filter("kind = 0").select("doc_id", F.col("a").alias("key"), "n", "parts")
    classes = stage(
        rows.filter("n > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("smallest"), F.first("n").alias("n"), F.first("parts").alias("parts")
        ),
        "classes",
    )
    frequent = _frequent(found.filter("kind = 1"))
    met = stage(_prefix_pairs(docs, frequent, size, max(16, buckets // 4), percent), "prefixes")
    pairs = met.filter("kind = 0").select("a", "b").distinct()
    pairs = stage(_suffix_filter(pairs, classes, percent), "pairs")
    links = stage(_verified(docs, pairs, classes, size, percent), "verified")
    nodes = components(links)

    entries = met.filter("kind = 1").select(
        F.col("a").alias("h"), F.col("b").alias("key"), F.col("n"), F.col("pos")
    )
    with_root = entries.join(nodes.withColumnRenamed("node", "key"), "key", "left").select(
        "h", "key", "n", "pos", F.coalesce("root", "key").alias("root")
    )
    mixed = with_root.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    rest = stage(with_root.join(mixed.select("h"), "h", "left_semi"), "mixed-groups")
    x = rest.select("h", *(F.col(c).alias(c + "1") for c in ("key", "n", "pos", "root")))
    y = rest.select("h", *(F.col(c).alias(c + "2") for c in ("key", "n", "pos", "root")))
    need = F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent) - 1e-9)
    across = (
        x.join(
            y,
            (x["h"] == y["h"])
            & (F.col("key1") < F.col("key2"))
            & (F.col("root1") != F.col("root2"))
            & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
            & (F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2")) >= need),
        )
        .select(F.col("key1").alias("a"), F.col("key2").alias("b"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    across = stage(_suffix_filter(across, classes, percent), "across")
    if across.limit(1).count():
        more = stage(_verified(docs, across, classes, size, percent), "verified-across")
        links = links.unionByName(more)
        nodes = components(links)

    inside = _suffix_filter(
        _inside(with_root, percent).join(pairs, ["a", "b"], "left_anti"), classes, percent
    )
    links = links.unionByName(_verified(docs, inside, classes, size, percent))

    named = (
        nodes.join(classes.withColumnRenamed("key", "node"), "node")
        .groupBy("root")
        .agg(F.min("smallest").alias("component_id"))
    )
    component = classes.join(nodes.withColumnRenamed("node", "key"), "key", "left").join(
        named, "root", "left"
    ).select("key", F.coalesce("component_id", "smallest").alias("component_id"))
    members = rows.join(component, "key", "left").select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
    return members, links
