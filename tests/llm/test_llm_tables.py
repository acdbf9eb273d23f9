"""Merkle manifest, fingerprints and spelling variants against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle_manifest, queries, ranks, spelling_variants, winnowing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(tmp_path, spark, rows, schema=DOCS):
    """A folder with these documents, and with columns whose names clash with those inside."""
    docs = spark.createDataFrame(rows, schema)
    for name in ("pos", "size", "tree", "key", "word", "id", "group"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, n_chars, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def way(levels, at):
    steps = []
    for level in levels[:-1]:
        run = at // 3 * 3
        steps.append((level[run:at], level[at + 1 : run + 3]))
        at //= 3
    return steps


def expected_manifest(rows):
    def null_first(v):
        return (v is not None, v.encode() if isinstance(v, str) else v or 0)

    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    trees = {}
    for source, own in groups.items():
        own.sort(key=lambda r: (null_first(r[0]), leaf_of(r)))
        trees[source] = own, levels_of([leaf_of(r) for r in own])
    order = sorted(groups, key=null_first)
    top = levels_of([trees[s][1][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        own, levels = trees[source]
        for at, row in enumerate(own):
            steps = way(levels, at) + way(top, k)
            digest = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                digest = leaf_of((row[0], row[1].replace("\n", ""), *row[2:]))
            for before, after in steps:
                digest = h(*before, digest, *after)
            proof = h(*("".join(b) + "".join(a) for b, a in steps))
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(count, rng):
    rows = []
    for i in range(count):
        source = rng.choice([None, "", "a", "a", "a", "é", "Z", "big", "big", "big", "big"])
        text = rng.choice([None, "", "x\ny", f"line {i}\n", "same", "-", "ü\n" * 3])
        rows.append((rng.choice([None, i, i, i, 7]), text, rng.choice([None, "de"]), source, rng.choice([None, i])))
    return rows + rows[:5]


@pytest.mark.parametrize("height", [1, 2, 5])
def test_manifest_equals_plain_python(spark, tmp_path, monkeypatch, height):
    rows = manifest_rows(90, random.Random(height))
    sf = tables(tmp_path, spark, rows)
    monkeypatch.setattr(
        merkle_manifest.seal, "__defaults__", (height,)
    )
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, sf).collect()]
    assert sorted(got, key=repr) == expected_manifest(rows)


def test_manifest_of_one_and_of_none(spark, tmp_path):
    row = (2, "a\n", None, None, 2)
    sf = tables(tmp_path / "one", spark, [row])
    (got,) = queries.op11_merkle_manifest(spark, sf).collect()
    assert got["leaf"] == got["subroot"] == got["root"] == leaf_of(row) and got["proof_sha256"] == h()
    sf = tables(tmp_path / "none", spark, [])
    assert queries.op11_merkle_manifest(spark, sf).collect() == []


def test_versions_share_all_other_nodes():
    digests = [h(str(i)) for i in range(27)]
    first = merkle_manifest._grown(digests, 3)
    copies = []
    version = merkle_manifest._copied(first, 14, 3, h("new"), copies)
    assert len(copies) == 3 and version.digest == copies[-1] != first.digest

    def nodes(node):
        yield node
        for child in node.children:
            yield from nodes(child)

    shared = {id(n) for n in nodes(first)}
    made = [n for n in nodes(version) if id(n) not in shared]
    assert len(made) == 4  # the leaf and its three ancestors
    again = merkle_manifest._copied(first, 14, 3, digests[14], [])
    assert again.digest == first.digest


def test_copies_and_groups_are_returned(spark):
    rows = [(i, "g", h(str(i)), h(f"x{i}") if i == 4 else None) for i in range(10)]
    records = spark.createDataFrame(rows, "id long, group string, leaf string, changed string")
    made = merkle_manifest.seal(records, block_height=1)
    by_id = {r["id"]: r for r in made.leaves.collect()}
    assert by_id[3]["copies"] is None and by_id[4]["copies"] == [h(h("3"), h("x4"), h("5"))]
    assert by_id[3]["folded_root"] == by_id[3]["root"] != by_id[4]["folded_root"]
    (group,) = made.groups.collect()
    assert group["records"] == 10 and group["subroot"] == group["root"] == by_id[0]["root"]


def test_places_in_groups_with_a_hot_group(spark):
    rows = [(("hot" if i % 3 else f"g{i % 7}"), i % 50) for i in range(2000)] + [(None, None)] * 20
    placed = ranks.place_in_groups(
        spark.createDataFrame(rows, "group string, v long"), "group", [F.col("v").asc_nulls_first()], "t"
    ).collect()
    by_group = {}
    for r in placed:
        by_group.setdefault((r["tree"], r["group"]), []).append(r)
    assert [g for _, g in sorted(by_group)] == [None, *sorted({r[0] for r in rows if r[0]})]
    for own in by_group.values():
        own.sort(key=lambda r: r["pos"])
        assert [r["pos"] for r in own] == list(range(len(own))) and {r["size"] for r in own} == {len(own)}
        values = [-1 if r["v"] is None else r["v"] for r in own]
        assert values == sorted(values)


def kept_by_hand(text):
    words = winnowing_words(text or "")
    if not words:
        return []
    codes = [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words]
    codes += [0] * (winnowing.GRAM - len(codes))
    grams = []
    for i in range(len(codes) - winnowing.GRAM + 1):
        value = 0
        for c in codes[i : i + winnowing.GRAM]:
            value = (value * winnowing.BASE + c) % winnowing.PRIME
        grams.append(value)
    kept = set()
    for i in range(max(len(grams) - winnowing.WINDOW + 1, 1)):
        window = grams[i : i + winnowing.WINDOW]
        least = min(window)
        kept.add((i + max(j for j, v in enumerate(window) if v == least), least))
    return sorted(kept)


def winnowing_words(text):
    words = []
    for run in text.replace("\t", " ").replace("\n", " ").split(" "):
        words += [run[i : i + winnowing.LONGEST] for i in range(0, len(run), winnowing.LONGEST)]
    return words


def texts_for_winnowing():
    rng = random.Random(3)
    stock = ["a", "b", "ß", "😀", "word", "x" * 70, "é" * 33, "\u00a0"]
    some = [rng.choice(" \n\t").join(rng.choices(stock, k=n)) for n in (*range(1, 12), 300, 3000)]
    return [None, "", " \n", "a " * 500, "ab " * 3000, "字" * 5000, " lead", *some]


def test_fingerprints_equal_plain_python(spark):
    texts = texts_for_winnowing()
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = frame.select("i", winnowing.fingerprint(F.col("t")).alias("k")).collect()
    for r in got:
        kept = [(v >> winnowing.HASH_BITS, v & winnowing.PRIME) for v in r["k"]]
        assert kept == kept_by_hand(texts[r["i"]]), r["i"]
    shown = frame.select(winnowing.as_text(winnowing.fingerprint(F.col("t"))).alias("s")).collect()
    assert shown[0]["s"] == shown[1]["s"] == "" and shown[3]["s"].count("@") == len(kept_by_hand("a " * 500))


def test_common_passages_are_always_found(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        shared = rng.choices(["the", "of", "and", "a"], k=winnowing.GRAM + winnowing.WINDOW - 1)
        left, right = ([f"{c}{rng.random()}" for _ in range(rng.randrange(30))] for c in "xy")
        rows.append((" ".join(left + shared + right[:5]), " ".join(right + shared)))
    kept = [winnowing.hashes(winnowing.fingerprint(F.col(c))) for c in ("a", "b")]
    found = spark.createDataFrame(rows, "a string, b string").select(F.arrays_overlap(*kept).alias("x"))
    assert all(r["x"] for r in found.collect())


def test_next_documents(spark, tmp_path):
    rows = [(5, "five five", None, None, 0), (9, None, None, None, 0), (1, "one", None, None, 0),
            (None, "no id", None, None, 0), (5, "five five", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("next_head", F.lit("clash")).withColumn("key", F.lit(1))
    got = winnowing.with_next(docs).select("doc_id", "text", "next_id", "next_head").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(9, "", 5, ""), (5, "five five", 1, "one"), (5, "five five", 1, "one"), (1, "one", None, "n"),
         (None, "no id", 9, "")], key=repr)
    changed = {
        r["doc_id"]: r["edited_sha256"]
        for r in queries.op12_winnowing(spark, tables(tmp_path / "some", spark, rows)).collect()
    }
    assert changed == {9: h(""), 5: h("five one"), 1: h("onn"), None: h("no ")}
    alone = queries.op12_winnowing(spark, tables(tmp_path / "one", spark, [rows[0]])).collect()
    assert alone[0]["near_next"] == 1.0 and alone[0]["edited_sha256"] == h("five five"[:5] + "five")
    assert queries.op12_winnowing(spark, tables(tmp_path / "none", spark, [])).collect() == []


def test_next_documents_over_many_ranges(spark):
    ids = [*random.Random(2).sample(range(10**6), 3000), -(2**63), 2**63 - 1, -5]
    docs = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string").repartition(40)
    got = {r["doc_id"]: r["next_id"] for r in winnowing.with_next(docs).collect()}
    ids.sort(reverse=True)
    assert got == dict(zip(ids, [*ids[1:], ids[0]]))


def test_texts_are_shuffled_twice_at_most(spark, sf_dir):
    frame = queries.op12_winnowing(spark, sf_dir)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    wide = [line for line in plan.splitlines() if " Exchange " in line]
    assert "ReusedExchange" in plan and len(wide) <= 4


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize("crowd", [200, 2])
def test_near_pairs_equal_plain_python(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling_variants, "CROWD", crowd)
    rng = random.Random(crowd)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(500)}
    words |= {"x" * n for n in range(5, 12)} | {"ÿ" * 60, "ÿ" * 61}
    got = {(r["a"], r["b"]) for r in spelling_variants.near_pairs(
        spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and is_near(a, b)}


def test_crowded_heads_do_not_make_all_pairs(spark, monkeypatch):
    """A third of all words under one rare gram: what meets stays near the number of words."""
    rng = random.Random(1)
    words = {"qz" + "".join(rng.choices("abcdefgh", k=9)) for _ in range(3000)}
    words |= {"".join(rng.choices("abcdefgh", k=11)) for _ in range(6000)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    met = spelling_variants.near_pairs(frame)
    assert met.count() < len(words)


def test_disjoint_grams_of_least_weight():
    choose = spelling_variants.cheapest_disjoint
    assert choose([0, 1, 2], [1, 0, 5]) == [0, 2]
    assert choose([0, 2, 5], [9, 1, 1]) == [2, 5]
    assert choose([3, 4], [1, 1]) == []
    rng = random.Random(0)
    for _ in range(200):
        places = sorted(rng.sample(range(12), 5))
        weights = [rng.randrange(20) for _ in places]
        pairs = [(w + v, [p, q]) for p, w in zip(places, weights) for q, v in zip(places, weights) if p + 2 <= q]
        chosen = choose(places, weights)
        assert sum(weights[places.index(p)] for p in chosen) == min(pairs)[0]


def test_words_and_roots(spark, tmp_path):
    rng = random.Random(8)
    stock = ["running", "runing", "Running", "ruNNing", "abcde", "ÀÉÈÊË", "àéèêë", "four", "a×÷bc", "tests", "testes"]
    rows = [(i, " ".join(rng.choices(stock, k=60)) + rng.choice(["", "\n", "1", "_x"]), None, None, 0) for i in range(120)]
    rows += [(None, "running " * 50, None, None, 0), (3, None, None, None, 0), (4, "", None, None, 0), rows[0]]
    counted = Counter()
    for doc_id, text, *_ in rows:
        for run in spelling_variants.re.findall(spelling_variants.RUN, text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None and (v := zlib.crc32(f"{doc_id}:{run}".encode())) % 97 == 0:
                run = run[: v % len(run)] + run[v % len(run) + 1 :]
            counted[run] += 1
    words = {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}
    forms = {}
    for w, n in words.items():
        near = [(-words[v], v) for v in words if is_near(w, v)]
        forms[w] = (min(near)[1] if near and -min(near)[0] >= 2 * n else None, len(near))
    expected = set()
    for w, n in words.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        form = forms[w][0]
        expected.add((w, form, root, n, forms[w][1], words[form] if form else None))
    got = queries.op13_spelling_variants(spark, tables(tmp_path / "some", spark, rows)).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert queries.op13_spelling_variants(spark, tables(tmp_path / "none", spark, [])).collect() == []


def test_chains_of_forms_reach_their_root(spark):
    words = [("a" * (5 + i), 2**i) for i in range(20)]
    got = spelling_variants.group_variants(spark.createDataFrame(words, "word string, n long")).collect()
    assert {r["root"] for r in got} == {"a" * 24}
    assert {r["word"]: r["form"] for r in got}["a" * 24] is None


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(spelling_variants, "PIECE", 10)
    rng = random.Random(4)
    text = "".join(rng.choices("abcé  1", k=3000)) + "x" * 50
    pieces = list(spelling_variants._pieces(text))
    assert "".join(pieces) == text and len(pieces) > 50
    runs = [r for p in pieces for r in spelling_variants.re.findall(spelling_variants.RUN, p)]
    assert runs == spelling_variants.re.findall(spelling_variants.RUN, text)
