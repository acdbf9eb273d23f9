"""Packing, language, quality, language model and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marquee.llm import attention_lm, fourier_quality, gru_langid, harmonic_packing, queries
from marquee.llm.common import bit_table, bits_for, marked
from marquee.llm.subwords import Subwords
from marquee.session import stage

BPE, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = [None, "", " ", "  a  b \n\n c ", "a<|endoftext|> b <|endoftext|>", " lead", "trail ", "x　y z", "a" * 9000,
       "x \x1c y", "é́ \U0001f600‍!", "it's  12,000\t\r\n"]


def table(spark, rows, extra="lang_pred"):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn(extra, F.lit("clash"))


# --- packing ------------------------------------------------------------------------


def test_subwords_equal_the_library():
    own, library = Subwords(BPE, PATTERN), Tokenizer.from_file(BPE)
    rng = random.Random(1)
    letters = ["a", "é", " ", "  ", "\n", "1", "!", "'s", " the", "<|endoftext|>", "\xa0", "ß"]
    texts = [t or "" for t in ODD] + ["".join(rng.choices(letters, k=40)) for _ in range(300)]
    for t in texts * 2:
        assert np.frombuffer(own(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_packed_pieces(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["the", "a", "tion", "12", "zq"], k=rng.choice([1, 30, 300, 2500])))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y"), (None, "x y"), (3, rows[3][1])]
    pieces = harmonic_packing.pack(table(spark, rows, "ids").repartition(3), BPE, PATTERN).collect()
    library = Tokenizer.from_file(BPE)
    sequences, documents = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4")
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], len(ids)))
        documents.setdefault(p["doc_id"], []).append((p["start"], p["doc_tokens"], ids.tolist()))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= 1024
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        if doc not in (None, 3):
            parts = sorted(documents[doc])
            assert sum((x for _, _, x in parts), []) == ids and {t for _, t, _ in parts} == {len(ids)}
            assert [s for s, _, _ in parts] == list(np.cumsum([0] + [len(x) for _, _, x in parts[:-1]]))
    assert Counter(d for d, _ in rows) == Counter({d: sum(s == 0 for s, _, _ in x) for d, x in documents.items()})
    lengths = [sum(n for _, n in parts) for parts in sequences.values()]
    padding = sum(1024 - n for n in lengths if n & (n - 1))
    assert padding < 0.03 * sum(lengths)
    assert harmonic_packing.pack(table(spark, []), BPE, PATTERN).count() == 0


def test_bins_of_a_class_hold_a_fixed_number():
    bins = harmonic_packing.Bins(0, 1024, 64, 0.95)
    for i in range(60):
        bins.add(i, b"\0" * 4 * 340)  # of the class of three to a bin
    assert Counter(s for s, _, _ in bins.closed) == {i: 3 for i in range(20)}
    bins.add(99, b"\0" * 4 * 600)  # gives up 512 tokens and a rest of 88
    bins.finish()
    assert sum(len(p[2]) // 4 for _, _, p in bins.closed) == 60 * 340 + 600


# --- language ---------------------------------------------------------------------------


def numeric_gradients(model, loss, grad, at):
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    got = grad()
    for key, i in at.items():
        e, own = 1e-5, model.p[key][i]
        model.p[key][i] = own + e
        up = loss()
        model.p[key][i] = own - e
        down = loss()
        model.p[key][i] = own
        assert (up - down) / 2 / e == pytest.approx(got[key][i], rel=1e-3, abs=1e-8), key


def test_gru_gradients():
    rng = np.random.default_rng(0)
    model = gru_langid.BiGru(["a", "b", "c"], hidden=3)
    x, y = rng.integers(97, 110, (7, 4)), rng.integers(0, 3, 4)
    at = {k: tuple(rng.integers(0, s) for s in v.shape) for k, v in model.p.items()}
    at |= {"Ef": (x[2, 1], 4), "Eb": (x[3, 2], 1)}
    gru_langid.np.float32, keep = np.float64, np.float32
    try:
        numeric_gradients(model, lambda: model.gradients(x, y)[0], lambda: model.gradients(x, y)[1], at)
    finally:
        gru_langid.np.float32 = keep


def test_every_letter_counts_once():
    model = gru_langid.BiGru(["a", "b"])
    text = ("ab cd " * 60).encode()[:201]
    got = model.documents([text, b"", b"12", b"ab"])
    assert got.sum(axis=1) == pytest.approx([1, 0, 0, 1], abs=1e-5)
    fold, window = gru_langid._fold, gru_langid.WINDOW
    total, count = np.zeros(2), 0
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(text), window):
        own = min(start, len(text) - window)
        p = model.probabilities(fold[data[own : own + window]][:, None])[:, 0]
        for i in range(start - own, window):
            if gru_langid._letter[data[own + i]]:
                total, count = total + p[i], count + 1
    assert got[0] == pytest.approx(total / count, rel=1e-4)


def test_languages_of_held_out_documents(spark, sf_dir):
    found = queries.QUERIES["op5_gru_language"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "12 345"), (None, "abc"), (None, "abc")]
    model = gru_langid.BiGru(["xx", "yy"])
    got = gru_langid.identify(table(spark, rows, "lang"), model).collect()
    assert len(got) == len(rows)
    for (_, text), r in zip(rows, got):
        letters = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] != "und") == letters and (letters or r["score"] == 0)
    nothing = spark.createDataFrame([(1, None, "en"), (2, "abc", None), (None, "abc", "en")],
                                    "doc_id long, text string, lang string")
    assert gru_langid.train(nothing) is None
    assert gru_langid.identify(nothing, None).first()["lang_pred"] == "und"
    assert gru_langid.identify(table(spark, [], "lang"), model).count() == 0


# --- quality ------------------------------------------------------------------------------


def test_isotonic_values_rise_and_keep_the_mean():
    rng = np.random.default_rng(0)
    x, y, w = np.sort(rng.random(200)), rng.random(200), rng.integers(1, 5, 200).astype(float)
    knots, values = fourier_quality.isotonic(x, y * w, w)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()
    knots, values = fourier_quality.isotonic(np.arange(4.0), np.array([0, 1, 0, 1.0]), np.ones(4))
    assert values.tolist() == [0, 0.5, 1] and knots.tolist() == [0, 1.5, 3]


def test_cosines_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, fourier_quality.N))
    z = fourier_quality.cosines(x, np.zeros(fourier_quality.N), np.ones(fourier_quality.N))[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 2 / fourier_quality.N)
    assert np.abs(z @ z.T - exact).mean() < 0.08


def test_quality_of_held_out_documents(spark, sf_dir):
    found = queries.QUERIES["op10_fourier_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.93 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_edges(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "abc"), (None, "abc")]
    stats = fourier_quality.statistics(table(spark, rows, "stats2"))
    values = [list(r["stats"]) for r in stats.collect()]
    assert values[0] == values[1] == [0.0] * fourier_quality.N and all(np.isfinite(values).ravel())
    assert fourier_quality.fit(stats.withColumn("y", F.lit(1)), F.lit(True)) is None
    assert fourier_quality.fit(stats.limit(0).withColumn("y", F.lit(1)), F.lit(True)) is None
    assert {r["score"] for r in fourier_quality.score(stats, None).collect()} == {0.5}
    one = F.when(F.col("doc_id") % 2 == 0, 1).when(F.col("doc_id") > 8, None).otherwise(0)
    model = fourier_quality.fit(stats.withColumn("y", one), F.lit(None).cast("boolean"))
    scores = fourier_quality.score(stats, model).collect()
    assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 for r in scores)


# --- language model ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lm():
    encode = attention_lm.WordIds(BPE, PATTERN)
    return encode, attention_lm.AttentionLm(encode.classes, encode.first_begin)


def test_attention_gradients(lm):
    encode, _ = lm
    model = attention_lm.AttentionLm(encode.classes, encode.first_begin)
    rng, n = np.random.default_rng(0), encode.classes * attention_lm.CLASS
    x, y = rng.integers(0, n, (3, 9)), rng.integers(0, n, (3, 9))
    at = {k: tuple(rng.integers(0, s) for s in v.shape) for k, v in model.p.items()}
    group, place = divmod(int(y[0, 0]), attention_lm.CLASS)
    at |= {"E": (x[1, 3], 2), "P": (4, 1), "M": (group, 3, place), "m": (group, place)}
    numeric_gradients(model, lambda: model.gradients(x, y)[0], lambda: model.gradients(x, y)[1], at)


def test_chances_add_up(lm):
    encode, model = lm
    n = encode.classes * attention_lm.CLASS
    ids = np.tile(encode([b"the", b"word"])[None], (n, 1))
    chance, begins = model.log_probabilities(ids, np.arange(n)[:, None])
    assert np.exp(chance).sum() == pytest.approx(1, abs=1e-3)
    inside = np.exp(chance[encode.first_begin * attention_lm.CLASS :]).sum()
    assert np.exp(begins[0, 0]) == pytest.approx(inside, abs=1e-3)


def test_each_id_is_scored_once(lm):
    encode, model = lm
    rng = random.Random(5)
    texts = [encode(["".join(rng.choices("abcdetion", k=rng.randint(1, 9))).encode() for _ in range(n)])
             for n in (0, 1, 7, 30, 100)]
    words, first = model.score(texts)
    assert len(words) == 0 + 1 + 7 + 30 + 100 + 5
    at = 0
    for ids in texts:
        seq, n = np.concatenate([[encode.end], ids]), int((ids >= encode.first_begin * 32).sum())
        total = 0.0
        for j in range(len(ids)):
            s = 0 if j < attention_lm.WINDOW else ((j - attention_lm.WINDOW) // attention_lm.STRIDE + 1) * attention_lm.STRIDE
            chance, begins = model.log_probabilities(seq[s : j + 1][None], seq[j + 1].reshape(1, 1))
            total += chance[0, 0] - (begins[0, 0] if j == 0 else 0)
        assert words[at : at + n].sum() == pytest.approx(total, rel=1e-3, abs=1e-3)
        at += n


def scored(spark, rows, steps=5):
    learns = F.col("doc_id") % 3 != 0
    found = attention_lm.score_texts(table(spark, rows, "block"), learns, BPE, PATTERN, steps=steps)
    return found.collect()


def test_baseline_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["the", "The", "of", "é", "zebra", "q1", " x"], k=rng.randint(0, 60)))) for i in range(80)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "the of"), (None, "the of"), (4, rows[4][1])]
    tokens = [(t or "").encode().lower().split() for _, t in rows]
    count, ends = Counter(), 0
    for (d, _), words in zip(rows, tokens):
        if d is not None and d % 3:
            count.update(words)
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    want = Counter()
    for (d, _), words in zip(rows, tokens):
        c = np.array([count[w] for w in words] + [ends], float)
        want[d, len(c), int((c > 0).sum()), n, round(float(np.log10((c + 1) / (n + v + 1)).sum()), 6)] += 1
    got = scored(spark, rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scoring_without_training_rows(spark):
    got = scored(spark, [(3, "a b"), (6, None)])
    assert [r["train_tokens"] for r in got] == [0, 0] and all(r["n_known"] == 0 for r in got)
    assert scored(spark, []) == []


def test_training_helps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    learns = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    sums = []
    for steps in (1, 150):
        found = attention_lm.score_texts(docs, learns, BPE, PATTERN, steps=steps)
        sums.append(found.agg(F.sum("score") / F.sum("n_tokens")).first()[0])
    assert sums[1] > sums[0] + 0.3


def test_quality_fit_and_scores_equal_plain_numpy(spark, sf_dir):
    """Ridge weights from all rows at once, calibration by the min-max formula of isotonic regression."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stats = stage(fourier_quality.statistics(docs.repartition(7)), "stats").withColumn(
        "y", (F.pmod(F.xxhash64("doc_id"), F.lit(100)) < 30 + 40 * (F.get("stats", F.lit(0)) > 4).cast("int")).cast("int")
    )
    later = F.col("doc_id") % 3 == 0
    model = fourier_quality.fit(stats, later)
    rows = sorted((r["doc_id"], r["stats"], r["y"]) for r in stats.collect())
    ids, x, y = (np.array(c, np.float64) for c in zip(*rows))
    first = ids % 3 != 0
    mean, scale = x[first].mean(axis=0), np.maximum(x[first].std(axis=0), 1e-6)
    z = fourier_quality.cosines(x, mean, scale)
    gram = z[first].T @ z[first] + fourier_quality.RIDGE * first.sum() / fourier_quality.FEATURES * np.eye(z.shape[1])
    weights = np.linalg.solve(gram, z[first].T @ y[first])
    assert np.allclose(model.weights, weights, rtol=1e-3, atol=1e-4)
    raw = z @ weights
    bins = np.round(np.clip(raw[~first], fourier_quality.LOW, fourier_quality.HIGH) / fourier_quality.BIN).astype(int)
    at, n = np.unique(bins, return_counts=True)
    total = np.array([y[~first][bins == b].sum() for b in at])
    best = [
        max(min(total[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(at))) for a in range(i + 1))
        for i in range(len(at))
    ]
    knots, values = [], []
    for value in sorted(set(np.round(best, 9))):
        own = np.isclose(best, value)
        knots.append((at[own] * n[own]).sum() / n[own].sum() * fourier_quality.BIN)
        values.append(value)
    expected = np.clip(np.interp(raw, knots, values), 0, 1)
    got = {r["doc_id"]: r["score"] for r in fourier_quality.score(stats, model).collect()}
    difference = np.abs(np.array([got[int(d)] for d in ids]) - expected)
    # A raw score at the edge of a bin may fall on either side of it.
    assert np.median(difference) < 1e-3 and difference.max() < 0.05


def test_languages_are_bounded(spark, monkeypatch):
    """A dirty column of many values: the most frequent are learnt."""
    monkeypatch.setattr(gru_langid, "MAX_LANGUAGES", 2)
    texts = {"en": "the cat and the dog of the house", "de": "der Hund und das Haus ist nicht", "xx": "zzz qqq"}
    rows = [(i, texts[l], l) for i, l in enumerate(["en", "de"] * 30 + ["xx"])]
    rows += [(100 + i, "odd text here", f"value {i}") for i in range(20)]
    model = gru_langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), steps=2)
    assert model.languages == ["de", "en"]


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    """Columns stay, decisions take effect, clean documents stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(step(spark, kept[-1], sf_dir), "stage"))
        assert kept[-1].columns == columns
        assert kept[-1].exceptAll(kept[-2]).count() == 0
    languages, quality, copies, clean = kept[1:]
    assert languages.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    part = quality.select("doc_id").withColumn("kept", F.lit(1))
    share = {
        r["quality"]: r["share"]
        for r in labels.join(languages.select("doc_id"), "doc_id").join(part, "doc_id", "left")
        .groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(0))).alias("share")).collect()
    }
    assert share[1] > 0.95 and share[0] < 0.3
    from test_llm_joins import brute_members

    rows = [tuple(r) for r in quality.select("doc_id", "text").collect()]
    want = {d for d, n, c in brute_members(rows) if d == c}
    assert {r[0] for r in copies.select("doc_id").collect()} == want
    dropped = {r[0] for r in queries.QUERIES["op8_spaced_seeds"](spark, sf_dir).select("doc_id").collect()}
    assert {r[0] for r in clean.select("doc_id").collect()} == want - dropped
    packed = corpus_pipeline.pack(spark, clean, sf_dir)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == want - dropped


def test_pipeline_tells_rows_apart_by_id_and_text(spark, sf_dir):
    """Two texts under one id are judged each for itself, copies without an id leave one row."""
    rng = random.Random(6)
    a, b, c = (" ".join(f"{w}{rng.randrange(10**6)}" for w in ["word"] * 60) for _ in range(3))
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [(1, a, "s"), (2, b, "s"), (2, near, "s"), (None, c, "s"), (None, c, "t"), (None, c, None), (7, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=repr) == sorted(
        [(1, a), (2, b), (None, c), (7, "")], key=repr
    )
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter(F.size(F.split("text", " ")) > 30).first()["text"]
    rows = [(1, a, "s"), (1, item, "s"), (None, item, "s"), (None, b, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = corpus_pipeline.decontaminate(spark, docs, sf_dir).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=repr) == sorted([(1, a), (None, b)], key=repr)


def test_quality_is_judged_by_one_worker_a_task(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200)
    kept = corpus_pipeline.judge_quality(spark, docs.unionByName(docs.limit(3).withColumn("text", F.lit(None))), sf_dir)
    assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rng = np.random.default_rng(3)
    model = fourier_quality.Quality(
        np.full(fourier_quality.N, 0.2), np.ones(fourier_quality.N), rng.normal(size=fourier_quality.FEATURES + 1),
        np.array([-3.0, 3.0]), np.array([0.0, 1.0]),
    )
    docs = docs.select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("text"))
    apart = fourier_quality.score(fourier_quality.statistics(docs), model)
    at_once = fourier_quality.score(docs, model, text="text")
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, apart.collect()))


def test_near_copies_are_dropped_without_a_shuffle_of_the_others(spark, sf_dir):
    """However many rows stay, only those that share a bit with a row that goes are moved."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(600)]
    near = [f"{t} more" for t in texts[:40]]
    rows = [(i, t, "s") for i, t in enumerate([*texts, *near, texts[50], "", None])]
    # Copies without an id, one row twice, and names the tables of bits use as well.
    rows += [(None, texts[60], "s"), (None, texts[60], "t"), (599, texts[599], "u"), (None, None, "s"), (None, None, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string").withColumn("word", F.lit(1))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        left = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
        plan = left._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr)
    finally:
        spark.conf.set(key, before)
    want = [*enumerate(texts), (641, ""), (642, None), (None, None)]
    assert left.columns == docs.columns and got == sorted(want, key=repr)
    # The rows that stay for certain come first, and no exchange but that of the bits is below.
    sure = plan[plan.index("Union") :].split("BroadcastHashJoin")[1]
    assert "LeftAnti" in sure and " Exchange " not in sure.split("+- Project")[0]
    moved = [x for x in plan.splitlines() if " Exchange " in x and "number" in x]
    assert moved and "LeftSemi" in plan
    table = bit_table(docs.filter("doc_id < 40"), "doc_id", bits_for(600))
    may, others = (marked(docs, "doc_id", table, bits_for(600), how) for how in ("left_semi", "left_anti"))
    assert may.count() + others.count() == docs.count()
    assert may.filter("doc_id < 40").count() == 40 and may.count() < 150


def test_pipeline_with_odd_rows(spark, sf_dir):
    """Nulls in any column, repeats, clashing columns, and nothing at all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    odd = spark.createDataFrame(
        [(None, "Some words that stand here twice without a number", None, None, None)] * 2
        + [(5_000_000, None, None, None, None), (5_000_001, "", "en", "s", 0)],
        docs.schema,
    )
    twice = docs.limit(5)
    mixed = docs.unionByName(odd).unionByName(twice)
    for name in ("number", "langid", "score", "lang_pred", "stats", "key", "row", "_text"):
        mixed = mixed.withColumn(name, F.lit(1))
    columns, now = mixed.columns, mixed
    for _, step in corpus_pipeline.STAGES[:-1]:
        now = stage(step(spark, now, sf_dir), "odd")
        assert now.columns == columns
    ids = [r["doc_id"] for r in now.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    assert corpus_pipeline.pack(spark, now, sf_dir).count() >= now.count()
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, sf_dir).count() == 0
