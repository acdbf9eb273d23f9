"""Graph components, n-gram join, projection passes, WARC archives."""

from __future__ import annotations

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import ngram_join, projection_dedup, queries, warc_index
from marquee.llm.graph import components
from marquee.llm.shingles import shingle_sets, text_key
from marquee.session import scratch_path, stage


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_hubs_chains_and_noise(spark):
    rng = random.Random(4)
    links = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1060)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    links += links[:20] + [(b, a) for a, b in links[:20]] + [(5, 5), (None, 3), (3, None)]
    union = Union(range(2400))
    for a, b in links:
        if a is not None and b is not None:
            union.link(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len({n for n, _ in rows})
    touched = {x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}
    assert dict(rows) == {n: union.root(n) for n in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram join -----------------------------------------------------------------


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_members(rows):
    sets = [shingles(t) for _, t in rows]
    union = Union(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                union.link(i, j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = union.root(i)
            smallest[r] = min(doc, smallest.get(r, doc))
    return sorted(
        ((d, len(s), smallest.get(union.root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def joined(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    members, links = ngram_join.join_similar(df.repartition(5))
    links.count()
    return sorted((tuple(r) for r in members.drop("key").collect()), key=str)


def test_shingle_sets_and_keys():
    texts = [b"a b c d e f", b" A\tb\nc\x0bd\x0ce\rf ", b"a b", b"", b" \n", b"a b c d e a b c d e",
             "é x y z w\xa0v".encode()]
    sizes = [len(shingles(t.decode())) for t in texts]
    got = shingle_sets(texts)
    assert [len(s) for s in got] == sizes
    assert (got[0] == got[1]).all() and text_key(texts[0]) == text_key(texts[1])
    assert all((np.diff(s) > 0).all() for s in got if len(s) > 1)


def test_join_against_brute_force_with_hot_groups(spark):
    """Many near copies, a passage in many texts, copies, short and empty texts, odd ids."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=4))
    base, passage = [word() for _ in range(90)], [word() for _ in range(60)]
    rows = []
    for i in range(80):  # near copies: one or two words changed
        copy = list(base)
        for at in rng.sample(range(90), rng.randint(1, 2)):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    for i in range(100, 160):  # a common passage and few own words: similar, but not enough
        rows.append((i, " ".join(passage + [word() for _ in range(rng.choice([9, 14, 30]))])))
    rows += [(200 + i, " ".join(base).upper()) for i in range(20)]
    rows += [(300, "a b c"), (301, "A  b\nc"), (302, "a b"), (303, ""), (304, None), (305, " \t")]
    rows += [(None, " ".join(passage)), (None, " ".join(passage)), (7, rows[3][1]), (7, rows[3][1])]
    rows += [(None, "only this text has no number at all")] * 2
    rows += [(400 + i, " ".join(word() for _ in range(40))) for i in range(40)]
    assert joined(spark, rows) == brute_members(rows)


def test_pairs_across_components_of_a_large_group(spark, monkeypatch):
    """With every group large and all shingles of unknown count, the last step finds the links."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 3)
    monkeypatch.setattr(ngram_join, "MAX_FREQUENT", 0)
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=4))
    core, rows = [word() for _ in range(60)], []
    for i in range(60):
        tail = [word() for _ in range(rng.choice([2, 8, 12, 15]))]
        rows.append((i, " ".join(core + tail)))
    assert joined(spark, rows) == brute_members(rows)


def test_links_inside_a_large_group_are_whole(spark, monkeypatch):
    """Near copies of one text, more than a block: every linked pair is in links, once."""
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 16)
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=4))
    base, rows = [word() for _ in range(300)], []
    for i in range(50):
        copy = list(base)
        for at in rng.sample(range(300), rng.randint(1, 2)):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    sets = [(text_key(t.encode()), shingles(t)) for _, t in rows]
    want = sorted(
        tuple(sorted((k, m))) for i, (k, a) in enumerate(sets) for m, b in sets[:i]
        if k != m and 100 * len(a & b) >= 80 * len(a | b)
    )
    assert len(want) > 500
    _, links = ngram_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, links.select("a", "b").collect())) == want


def test_only_texts_that_may_be_wanted_are_shuffled(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    docs = docs.unionByName(docs.limit(10)).unionByName(docs.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    wanted = {3, 64, 65, 127, 3999, -5, 2**62}
    ids = spark.createDataFrame([(i,) for i in wanted], "doc_id long")
    got = [r.doc_id for r in ngram_join._may_be_wanted(docs, ids, 4000).collect()]
    assert len(got) < 30 and set(got) >= {3, 64, 65, 127, 3999} and got.count(3) == 2
    assert ngram_join._may_be_wanted(docs, ids.limit(0), 0).count() == 0

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        pairs = spark.createDataFrame([(1, 2)], "a long, b long")
        classes = spark.createDataFrame([(1, 3), (2, 64)], "key long, smallest long")
        found = ngram_join._verified(docs, pairs, classes, 5, 80)
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        # The texts go through the table of bits before they are shuffled by id.
        first = next(i for i, line in enumerate(plan) if "BroadcastHashJoin" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        above = [line for line in plan[:first] if depth(line) < depth(plan[first])]
        assert any("Exchange hashpartitioning(doc_id" in line for line in above)
    finally:
        spark.conf.set(key, before)


def test_tasks_share_buckets(spark, monkeypatch):
    """With many buckets few tasks, and so few files, and each bucket is whole in one of them."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=4))
    base, rows = [word() for _ in range(60)], [(1000, "a b c"), (1001, None), (None, "x y z")]
    for i in range(90):
        copy = list(base)
        copy[rng.randrange(60)] = word()
        rows.append((i, " ".join(copy if i % 3 else [word() for _ in range(40)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = ngram_join._profile(docs, 5, 200).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in found}) <= 25
    counts = {}
    for s in shingle_sets([(t or "").encode() for _, t in rows]):
        for h in (s >> np.uint64(20)).tolist():
            counts[h] = counts.get(h, 0) + 1
    want = {h: n for h, n in counts.items() if n > ngram_join.RARE}
    assert len(want) > 40 and {r.a: r.n for r in found if r.kind == 1} == want
    assert sum(r.kind == 1 for r in found) == len(want) and sum(r.kind == 0 for r in found) == len(rows)

    often = np.empty(0, np.uint64), np.empty(0, np.int64)
    met = ngram_join._prefix_pairs(docs, often, 5, 200, 80).withColumn("task", F.spark_partition_id())
    assert 0 < len({r.task for r in met.collect()}) <= 100
    monkeypatch.setattr(ngram_join, "PER_BUCKET", 25)
    assert joined(spark, rows) == brute_members(rows)


def test_prefixes_spread_over_buckets(spark, monkeypatch):
    """Prefixes have the least hashes of their texts; their buckets are even all the same."""
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijkl", k=5)) for _ in range(200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    seen = []
    often = np.empty(0, np.uint64), np.empty(0, np.int64)
    plain = type(docs).repartition
    monkeypatch.setattr(type(docs), "repartition", lambda df, *a: seen.append(df) or plain(df, *a))
    ngram_join._prefix_pairs(docs, often, 5, 16, 80)
    sizes = {}
    for r in seen[-1].collect():
        sizes[r.bucket] = sizes.get(r.bucket, 0) + len(r.entries) // ngram_join._ENTRY.itemsize
    take = 196 - -(-80 * 196 // 100) + 1
    assert sum(sizes.values()) == 60 * take and len(sizes) == 16
    assert max(sizes.values()) < 2 * 60 * take / 16


def test_join_of_nothing(spark):
    assert joined(spark, []) == []


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = queries.QUERIES["op9_ngram_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute_members([tuple(r) for r in docs.collect()])


# --- projection passes --------------------------------------------------------------


def brute_vectors(rows, threshold=0.93):
    ok = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    union, links = Union(range(len(rows))), [0] * len(rows)
    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if j < i and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    union.link(i, j)
                    links[i] += 1
                    links[j] += 1
    low = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            low[union.root(i)] = min(d, low.get(union.root(i), d))
    return sorted(
        ((d, links[i], low.get(union.root(i))) for i, (d, _, _) in enumerate(rows)), key=str
    )


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = projection_dedup.near_duplicates(df.withColumn("code", F.lit(1)))
    return found


def test_vectors_against_brute_force(spark, monkeypatch):
    """A cluster far denser than the window and than a component's block, copies, odd vectors."""
    monkeypatch.setattr(projection_dedup, "COMPONENT_BLOCK", 50)
    rng = np.random.default_rng(0)
    centre, rows = rng.normal(size=24), []
    for i in range(150):
        rows.append((i, [float(x) for x in (centre + rng.normal(size=24) * 0.15).astype("f4")], 1))
    for i in range(150, 300):
        v = [float(x) for x in rng.normal(size=24).astype("f4")]
        rows.append((i, v, int(i % 3)))
        if i % 5 == 0:
            rows.append((1000 + i, v, int(i % 3)))
            rows.append((2000 + i, [2 * x for x in v], int(i % 3)))
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [nan] + [1.0] * 23, 1),
             (904, [inf] * 24, 1), (905, [None] + [1.0] * 23, 1), (906, rows[0][1], None),
             (907, [1.0, 2.0], 1), (908, [1.0, 2.0], 1), (None, rows[200][1], rows[200][2]), rows[3], rows[3]]
    got = vectors(spark, rows).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)


def test_no_vectors(spark):
    assert vectors(spark, []).collect() == []


def test_passes_hold_recall_as_vectors_grow():
    few, many = projection_dedup.passes_for(1_000), projection_dedup.passes_for(10**9)
    assert 3 <= few < many < 200


def test_recall_of_borderline_pairs(spark):
    """Pairs just above the threshold, among many: the passes alone find nine in ten or more."""
    rng, rows = np.random.default_rng(1), []
    for i in range(800):
        a = rng.normal(size=48)
        a /= np.linalg.norm(a)
        b = rng.normal(size=48)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        for k, v in enumerate((a, 0.94 * a + np.sqrt(1 - 0.94**2) * b)):
            rows.append((2 * i + k, [float(x) for x in v], 0))
    got = vectors(spark, rows)
    assert got.filter("n_links >= 1").count() >= 0.9 * 1600


@pytest.mark.parametrize("work", [projection_dedup.PASS_WORK, 1])
def test_recall_among_crowded_vectors(spark, monkeypatch, work):
    """A label with a common direction, and one with a dense group among others; with and without passes."""
    monkeypatch.setattr(projection_dedup, "PASS_WORK", work)
    monkeypatch.setattr(projection_dedup, "COMPONENT_BLOCK", 300)
    rng, dim = np.random.default_rng(3), 64

    def around(n, cosine):
        centre = np.full(dim, dim**-0.5) * np.sqrt(cosine)
        return centre + rng.normal(size=(n, dim)) * np.sqrt((1 - cosine) / dim)

    kinds = [around(3000, 0.86), np.concatenate([rng.normal(size=(1500, dim)), around(1000, 0.87)])]
    rows, pairs = [], []
    for label, v in enumerate(kinds):
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        a, b = np.nonzero(np.triu(v @ v.T >= 0.931, 1))
        pairs += list(zip((a + 10_000 * label).tolist(), (b + 10_000 * label).tolist()))
        rows += [(10_000 * label + i, [float(x) for x in u], label) for i, u in enumerate(v)]
    assert len(pairs) > 50
    of = {r["vec_id"]: r["component_id"] for r in vectors(spark, rows).collect()}
    found = sum(of[a] == of[b] for a, b in pairs) / len(pairs)
    assert found >= (0.9 if work == 1 else 1)


# --- archives -------------------------------------------------------------------------


def captures(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, t long")
    return df.select("*", F.timestamp_seconds("t").alias("captured"), F.lit(1).alias("digest")).repartition(3)


def test_loser_tree():
    rng = random.Random(0)
    for k in range(12):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 30))) for _ in range(k)]
        tree = warc_index.LoserTree([iter(r) for r in runs], key=lambda x: x)
        assert list(tree) == sorted(sum(runs, []))


def test_history_round_trip(spark):
    hot = "http://a.org/x"
    rows = [(i, hot if i % 3 else f"http://w{i % 7}.a.org/p?q={i % 5}", f"<p>é {i % 40}\r\n\r\nWARC/1.1\r\n", 50 - i % 9)
            for i in range(300)]
    rows += [(900, None, None, None), (901, "", "", 1), (None, "http://b.c/\r\nd", rows[5][2], 2),
             (None, "x", "alone", 3), (902, "x", "z" * 300_000, 4), (5, *rows[5][1:]), (285, *rows[285][1:])]
    got = warc_index.capture_history(captures(spark, rows)).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: (r["part"], r["rank"]))
    order = [(r["url_key"], r["captured"], -1 if r["page_id"] is None else r["page_id"]) for r in got]
    assert order == sorted(order)
    by_id = {}
    for r in got:
        by_id.setdefault(r["page_id"], []).append(r)
    same = {}
    for i, _, html, _ in rows:
        if i is not None:
            same[html or ""] = max(i, same.get(html or "", i))
    for i, _, html, _ in rows:
        first = same.get(html or "")
        for r in by_id[i]:
            if i is None:
                continue
            assert r["payload_bytes"] == len((html or "").encode())
            assert r["record_type"] == ("response" if i == first else "revisit")
            assert r["refers_to"] == (None if i == first else first)
    assert {(r["record_type"], r["refers_to"]) for r in by_id[None]} == {("response", None), ("revisit", 285)}


def test_ranges_and_archives_follow_the_amount(spark, monkeypatch):
    """More ranges than the session's partitions, archives of few records, one very long payload."""
    monkeypatch.setattr(warc_index, "ENTRIES_PER_RANGE", 40)
    monkeypatch.setattr(warc_index, "ARCHIVE_BYTES", 60_000)
    rows = [(i, f"http://h{i % 7}.org/p{i % 50}", f"text {i % 90}", i) for i in range(900)]
    rows.append((5000, "http://h3.org/p1", "long \r\n\r\n" * 400_000, 1))
    path = scratch_path(spark, "warc")
    warc_index.write_archives(captures(spark, rows), path)
    runs = stage(warc_index.read_runs(spark, path), "runs")
    assert runs.select("run").distinct().count() > 8
    got = warc_index.merge_runs(runs).collect()
    assert max(r["rank"] for r in got) < 400 and len({r["part"] for r in got}) > 8
    got.sort(key=lambda r: (r["part"], r["rank"]))
    order = [(r["url_key"], r["captured"], r["page_id"]) for r in got]
    assert order == sorted(order) and len(got) == len(rows)
    long = next(r for r in got if r["page_id"] == 5000)
    assert long["payload_bytes"] == 9 * 400_000 and long["record_type"] == "response"


def test_small_payloads_are_not_revisited(spark):
    path = scratch_path(spark, "warc")
    warc_index.write_archives(captures(spark, [(1, "u", "ab", 1), (2, "u", "ab", 1)]), path, min_bytes=3)
    assert {r["record_type"] for r in warc_index.read_runs(spark, path).collect()} == {"response"}


def test_no_captures(spark):
    assert warc_index.capture_history(captures(spark, [])).count() == 0


def test_damaged_archives_are_told(spark, tmp_path):
    path = str(tmp_path / "a")
    warc_index.write_archives(captures(spark, [(1, "http://u/", "some text", 1)]).coalesce(1), path)
    raw = gzip.decompress(next((tmp_path / "a").glob("*.gz")).read_bytes())
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"some text\r\n\r\n")
    entries = lambda b: list(warc_index.archive_entries(memoryview(gzip.compress(b))))
    assert entries(raw)[0][2] == 1
    assert [e[7] for e in entries(raw + raw)] == [0, len(raw)]
    for broken in (raw.replace(b"some", b"sone"), raw[:-9], raw[4:]):
        with pytest.raises(ValueError):
            entries(broken)


def test_url_keys():
    assert warc_index.url_key("HTTP://www.A.org:80/b?c#d") == "org,a)/b?c"
    assert warc_index.url_key(None) == "" and warc_index.url_key("http://a.b") == "b,a)/"
