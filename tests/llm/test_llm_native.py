"""URL filter, chat formatting and spaced seeds."""

from __future__ import annotations

import hashlib
import random
import re
import time
from itertools import combinations

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from marquee.llm import chat_format, queries, spaced_seeds, url_filter


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_oracle(spark, sf_dir, name):
    problem, _ = compare(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLES[name])
    assert not problem


@pytest.mark.parametrize("name", ["op1_url_filter", "op6_chat_format", "op8_spaced_seeds", "op12_winnowing"])
def test_native_plans_have_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    for operator in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert operator not in plan


RULES = "host string, path string, verdict string"


def judged(spark, urls, rules, listed=()):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.withColumn("rule", F.lit("clash")).withColumn("_url", F.lit(1))
    found = url_filter.filter_urls(
        pages,
        spark.createDataFrame(rules, RULES),
        spark.createDataFrame([(u,) for u in listed], "url string"),
    )
    return {r["page_id"]: (r["rule"], r["verdict"]) for r in found.collect()}


def test_url_rules(spark):
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("a.net", "/e", "allow"), (None, "/", "block")]
    got = judged(
        spark,
        ["http://a.net/en/x", "http://B.A.net/en/", "http://xnet/", "http://a.net", "http://c.net/q",
         "http://net/", "http://a.net/ex", None, "", "no scheme", "http://", "http://a.net/en/x"],
        rules,
    )
    assert [got[i][0] for i in range(12)] == [
        "a.net/en/", "a.net/en/", None, None, "net/", "net/", "a.net/e", None, None, None, None, "a.net/en/",
    ]
    assert got[4][1] == "block" and got[0][1] == "allow" and got[7][1] == "allow"


def test_listed_urls_and_false_positives(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)  # nearly everything is a possible hit
    listed = [f"h{i}.org/p" for i in range(200)]
    urls = [f"https://h{i}.org/p/?utm_source=z#f" for i in range(400)]
    got = judged(spark, urls, [("example.org", "/", "block")], listed)
    assert [i for i in range(400) if got[i][1] == "block"] == list(range(200))


def test_canonical_urls(spark):
    df = spark.createDataFrame(
        [("HTTP://A.b:80/x/?b=2&utm_source=q&a=1#t",), ("x",), (None,)], "u string"
    ).select(url_filter.canonical(F.col("u")).alias("c"))
    assert [r["c"] for r in df.collect()] == ["a.b/x?a=1&b=2", "", ""]


def test_url_filter_of_nothing(spark):
    assert judged(spark, [], []) == {}
    assert judged(spark, ["http://a.b/"], []) == {0: (None, "allow")}


def test_bloom_blocks_are_bounded(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    blocks = url_filter.bloom_blocks(keys, "key", 16)
    assert blocks.count() <= 16
    assert url_filter.possible_hits(keys, "key", blocks, 16).count() == 3000


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    return chat_format.format_chats(df).select(
        "conv_id",
        "formatted",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )


def test_chat_round_trip(spark):
    random.seed(3)
    alphabet = ["<|im_end|>", "<|im_start|>", "<|turn|>", "<", "|", "\\", "\n", "assistant", "é", "\U0001f600", ""]
    rows, want = [], {}
    for c in range(60):
        turns = [
            (t, random.choice(["user", "assistant", "sys%\n<tem"]), "".join(random.choices(alphabet, k=6)))
            for t in range(random.randint(1, 9))
        ]
        want[c] = turns
        rows += [(c, *t, 0) for t in turns]
    random.shuffle(rows)
    for r in chats(spark, rows).collect():
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [t[1:] for t in turns]
        assert r["loss"] == "".join(t[2] for t in turns if t[1] == "assistant")
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:]))
        assert r["formatted"].count("<|im_start|>") == blocks == r["formatted"].count("<|im_end|>")


def test_chat_nulls_ties_and_repeats(spark):
    rows = [(None, 1, "user", "a", 0), (None, 1, "user", "a", 0), (7, None, None, None, 0),
            (7, 2, "assistant", "z", 0), (7, 2, "assistant", "b", 0), (7, 2, "assistant", "b", 0)]
    got = chats(spark, rows).collect()
    assert sorted(str(r["conv_id"]) for r in got) == ["7", "None", "None"]
    seven = next(r for r in got if r["conv_id"] == 7)
    assert [(t["role"], t["text"]) for t in seven["turns"]] == [
        ("", ""), ("assistant", "b"), ("assistant", "b"), ("assistant", "z")
    ]
    assert seven["loss"] == "bbz"
    assert chats(spark, []).collect() == []


def test_chat_digest_of_the_control_conversation(spark, sf_dir):
    row = queries.QUERIES["op6_chat_format"](spark, sf_dir).filter("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- spaced seeds -------------------------------------------------------------


def overlaps(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit(0))
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("hashes", F.lit(0))
    found = spaced_seeds.find_overlaps(docs, items)
    return {(r["doc_id"], r["item_id"], r["doc_start"]): r for r in found.collect()}


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]


def test_substitutions_are_tolerated(spark):
    item = words(30, 1)
    rng, docs = random.Random(2), []
    for i in range(40):
        copy = list(item)
        for at in rng.sample(range(30), i % 3):
            copy[at] = "changed"
        docs.append((i, " ".join(words(50, 100 + i) + copy + words(20, 200 + i))))
    docs += [(100, " ".join(words(200, 5))), (101, None), (102, ""), (103, " \n "), (None, " ".join(item))]
    got = overlaps(spark, docs, [(9, " ".join(item).upper()), (10, None), (11, "")])
    assert {k[0] for k in got} == {None, *range(40)}
    assert all(k[1] == 9 for k in got)
    assert got[(4, 9, 50)]["n_equal"] == 29


def test_partial_and_hanging_overlaps(spark):
    item = words(40, 1)
    docs = [(1, " ".join(item[20:])), (2, " ".join(item[:15] + words(30, 3))), (3, " ".join(item[:9]))]
    got = overlaps(spark, docs, [(5, " ".join(item))])
    assert set(got) == {(1, 5, -20), (2, 5, 0)}


def test_short_items_must_be_exact(spark):
    docs = [(1, "x one two three y"), (2, "x one too three y"), (3, "three")]
    assert set(overlaps(spark, docs, [(1, "One two THREE"), (2, "three")])) == {
        (1, 1, 1), (1, 2, 3), (2, 2, 3), (3, 2, 0)
    }
    assert overlaps(spark, [], [(1, "a")]) == {} == overlaps(spark, docs, [])


def test_every_placing_of_substitutions_is_found(spark):
    """All pairs of changed words: in a window quoted from a long item, and in whole short items."""
    long, docs, want = words(30, 1), [], set()
    items = [(0, " ".join(long)), *((n, " ".join(words(n, n))) for n in range(9, 14))]
    for n, quoted, item in [(13, long[8:21], 0), *((n, words(n, n), n) for n in range(9, 14))]:
        for one, two in combinations(range(n), 2):
            copy = list(quoted)
            copy[one], copy[two] = "changed", "too"
            want.add((len(docs), item))
            docs.append((len(docs), " ".join(words(6, 999) + copy + words(6, 998))))
            # The document begins or ends within the quotation.
            if one == 0:
                want.add((len(docs), item))
                docs.append((len(docs), " ".join(copy[1:] + words(6, 997))))
        # Three changed words are too many.
        docs.append((len(docs), " ".join(words(6, 999) + ["a", "b", "c"] + quoted[3:])))
    assert {k[:2] for k in overlaps(spark, docs, items)} == want


def test_masks_that_lose_overlaps_are_refused(spark):
    assert spaced_seeds.covers(spaced_seeds.MASKS, spaced_seeds.WINDOW, 2)
    docs, items = (spark.createDataFrame([(1, "a")], f"{c} long, text string") for c in ("doc_id", "item_id"))
    with pytest.raises(ValueError):
        spaced_seeds.find_overlaps(docs, items, masks=("11101110011", "11010111101", "10111011101"))


def test_repeated_rows_and_ids(spark):
    a, b = words(20, 1), words(20, 2)
    docs = [(1, " ".join(a))] * 3 + [(1, " ".join(b))]
    items = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(b))]
    assert len(overlaps(spark, docs, items)) == 1  # one row: pair and alignment are the same
    found = spaced_seeds.find_overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert found.count() == 1


def test_planted_items_are_found(spark, sf_dir):
    """Every document that holds a run of 13 words of an item is reported, and none with less in common."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()
    runs, pieces = set(), set()
    for (text,) in items:
        w = text.lower().split()
        runs |= {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
        pieces |= {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
    must, may = set(), set()
    for r in docs:
        w = (r["text"] or "").lower().split()
        if any(tuple(w[i : i + 13]) in runs for i in range(len(w) - 12)):
            must.add(r["doc_id"])
        if any(tuple(w[i : i + 4]) in pieces for i in range(len(w) - 3)):
            may.add(r["doc_id"])
    got = {r["doc_id"] for r in queries.QUERIES["op8_spaced_seeds"](spark, sf_dir).collect()}
    assert must and must <= got <= may


def overlaps_by_hand(docs, items):
    """(doc, item, start): equal tokens, item's tokens, most equal in a window; of every alignment."""
    found = {}
    for d, doc in docs:
        for i, item in items:
            x, y = (doc or "").lower().split(), (item or "").lower().split()
            if not x or not y:
                continue
            need = spaced_seeds.MIN_EQUAL if len(y) >= 13 else len(y) - 2 if len(y) >= 9 else len(y)
            for start in range(1 - len(y), len(x)):
                equal = [int(x[start + k] == y[k]) for k in range(len(y)) if 0 <= start + k < len(x)]
                best = max(sum(equal[k : k + 13]) for k in range(max(1, len(equal) - 12)))
                if best >= need:
                    found[d, i, start] = sum(equal), len(y), best
    return found


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_overlaps_equal_plain_python(spark, monkeypatch, broadcast):
    """On both ways of joining, with few words so that tokens are often equal by chance."""
    monkeypatch.setattr(spaced_seeds, "BROADCAST_ROWS", broadcast)
    rng = random.Random(12)
    stock = ["a", "b", "c", "d"]
    items = [(i, " ".join(rng.choices(stock, k=n))) for i, n in enumerate([4, 8, 9, 10, 11, 12, 13, 14, 20, 33])]
    docs = [(i, " ".join(rng.choices(stock, k=rng.randrange(1, 90)))) for i in range(30)]
    for i, (_, text) in enumerate(items):
        changed = text.split()
        for at in rng.sample(range(len(changed)), 2 * (len(changed) >= 9)):
            changed[at] = "x"
        docs.append((100 + i, " ".join(rng.choices(stock, k=5) + changed + rng.choices(stock, k=5))))
    docs += [(7, docs[7][1]), (8, docs[9][1]), (200, None), (201, "")]
    got = overlaps(spark, docs, items)
    want = overlaps_by_hand(docs, items)
    assert {k: (r["n_equal"], r["n_item"], r["best_window"]) for k, r in got.items()} == want
    assert {(100 + i, i, 5) for i in range(len(items))} <= set(want)


def test_long_benchmarks_shuffle_seeds_without_tokens(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(spaced_seeds, "BROADCAST_ROWS", 0)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        frame = queries.QUERIES["op8_spaced_seeds"](spark, sf_dir)
        plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(limit, before)
    below = [plan[i + 1 : i + 3] for i, line in enumerate(plan) if "Exchange hashpartitioning(seed#" in line]
    assert below
    for lines in below:
        item = any(re.search(r"Project \[row#\d+L AS item_row#\d+L, at#\d+ AS item_at#\d+, size\(", x) for x in lines)
        doc = any(re.search(r", \[row#\d+L, at#\d+\], false, \[seed#\d+L\]$", x) for x in lines)
        assert item or doc, lines


def test_conversation_of_many_turns(spark):
    """One conversation of 50,000 turns, most of them of one role, ends in seconds."""
    n = 50_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 10 < 7, "assistant").otherwise("user").alias("role"),
        F.concat(F.lit("text <| "), F.col("id")).alias("text"),
    )
    start = time.time()
    made = chat_format.format_chats(rows).withColumn("turns", chat_format.read_turns(F.col("formatted")))
    loss = chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))
    row = made.select(F.size("turns").alias("n"), loss.alias("loss"), "turns").first()
    assert time.time() - start < 60
    texts = [f"text <| {i}" for i in range(n)]
    assert row["n"] == n and [t["text"] for t in row["turns"]] == texts
    assert row["loss"] == "".join(t for i, t in enumerate(texts) if i % 10 < 7)


def test_host_of_many_labels_and_many_rule_lengths(spark):
    """A URL of 60,000 labels takes seconds, and so do rules of a thousand lengths."""
    host = "a." * 60_000 + "example.net"
    rules = [("example.net", "/", "block")] + [("b.org", "/" + "x" * i, "allow") for i in range(1, 1001)]
    start = time.time()
    got = judged(spark, [f"http://{host}/p", "http://b.org/" + "x" * 700 + "/y", "http://b.org/"], rules)
    assert time.time() - start < 60
    assert got[0] == ("example.net/", "block")
    assert got[1] == ("b.org/" + "x" * 700, "allow") and got[2] == (None, "allow")


def test_filter_grows_with_the_list(spark, monkeypatch):
    """Beyond the broadcast size the filter is a table by block, of two bytes a key."""
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 4)
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key")).cache()
    blocks = -(-4000 * url_filter.BITS_PER_KEY // url_filter.BLOCK_BITS)
    others = spark.range(4000).select(F.concat(F.lit("other"), "id").alias("key"))
    hits = url_filter.possible_hits(keys.union(others), "key", url_filter.bloom_blocks(keys, "key", blocks), blocks)
    assert 4000 <= hits.count() < 4000 + 100
    assert "broadcast" not in hits._jdf.queryExecution().analyzed().toString().lower()
