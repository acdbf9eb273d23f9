"""Edge rows: NULLs, empty input, rounding, three-valued logic."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from marquee import functions as fn
from marquee.operators import aggregates as agg
from marquee.operators import profile as prof
from marquee.operators.columns import (
    constant_columns,
    drop_constant_columns,
    fill_sentinel,
    max_normalize,
    rename_columns,
)
from marquee.operators.encode import split_train_test, topk_categories, topk_onehot, topk_values
from marquee.operators.lookup import fits_in_map, lookup_array_dim
from marquee.operators import quantiles, setops
from marquee.operators.profile import (
    correlation,
    describe,
    null_profile,
    schema_profile,
    summary,
)
from marquee.operators.quantiles import exact_quantiles
from marquee.operators.setops import dedup_rows, distinct_count, union_all
from marquee.plans.eda import age_group
from marquee.plans.features import SCORE_BOUNDS, SCORE_OTHERWISE


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize(
    ("items", "expected"),
    [
        (["a", "b", "c"], "a, b and c"),
        (["a", "b"], "a and b"),
        (["a"], "a"),
        ([], None),
        (None, None),
        ([None, "b"], " and b"),
        (["a", None], None),
    ],
)
def test_english_list(spark, items, expected):
    df = spark.createDataFrame([(items,)], "x array<string>")
    assert df.select(fn.english_list("x")).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("", (None, None, None)),
        ("2024-13-01", (None, None, None)),
        ("soon", (None, None, None)),
        (None, (None, None, None)),
        ("2024-02-29", (2024, 2, 29)),
        ("2024", (2024, 1, 1)),
    ],
)
def test_date_parts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    assert tuple(df.select(*fn.date_parts("d", "release").values()).first()) == expected


@pytest.mark.parametrize(
    ("score", "label"),
    [(8.0, "High"), (7.999, "Medium"), (5.0, "Medium"), (4.99, "Low"), (None, "Low")],
)
def test_score_buckets(spark, score, label):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(fn.bucketize("s", SCORE_BOUNDS, SCORE_OTHERWISE)).first()[0] == label


@pytest.mark.parametrize(
    ("age", "label"),
    [(9.99, "New"), (10.0, "Modern"), (30.0, "Classic"), (None, "Classic"), (-0.42, "New")],
)
def test_age_buckets(spark, age, label):
    df = spark.createDataFrame([(age,)], "movie_age double")
    assert df.select(age_group()).first()[0] == label


def test_age_of_a_future_date_is_negative(spark):
    df = spark.createDataFrame([("2024-06-01",), ("",)], "d string")
    ages = values(df.select(fn.age_years("d", "2024-01-01").alias("a")), "a")
    assert ages == [-0.42, None]


def test_age_defaults_to_today(spark):
    df = spark.createDataFrame([("2000-01-01",)], "d string")
    assert df.select(fn.age_years("d")).first()[0] > 24


def test_round_is_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.125,)], "x double")
    assert values(df.select(F.round("x", 2).alias("r")), "r") == [0.13, 2.68, -0.13]


def test_flags(spark):
    df = spark.createDataFrame([(None, "x"), ("x", "x"), ("y", "x")], "a string, b string")
    assert values(df.select(fn.differs_flag("a", "b").alias("f")), "f") == [0, 0, 1]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert values(flags.select(fn.bool_to_int("b").alias("i")), "i") == [1, 0, 1]


def test_prefixed_null_path(spark):
    df = spark.createDataFrame([(None,), ("/p.jpg",)], "p string")
    assert values(df.select(fn.prefixed("http://h", "p").alias("u")), "u") == [None, "http://h/p.jpg"]


def test_max_normalize(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    assert values(max_normalize(df, "x", "n"), "n") == [0.333, 1.0, None]
    zero = spark.createDataFrame([(0.0,)], "x double")
    assert values(max_normalize(zero, "x", "n"), "n") == [None]
    empty = spark.createDataFrame([], "x double")
    assert values(max_normalize(empty, "x", "n"), "n") == []


@pytest.mark.parametrize("how", ["map", "join", "auto"])
def test_lookup(spark, how):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "B")], "id int, name string")
    rows = [(i, ids) for i, ids in enumerate([[1, 9], None, [], [2, 1], [1, 1], [1, None]])]
    df = spark.createDataFrame(rows, "i int, ids array<int>")
    named = lookup_array_dim(df, "ids", dim, how=how).orderBy("i")
    assert named.columns == ["i", "ids", "names"]
    assert values(named, "names") == [
        ["a", None],
        None,
        [],
        ["b", "a"],
        ["a", "a"],
        ["a", None],
    ]


@pytest.mark.parametrize("how", ["map", "join"])
def test_lookup_in_an_empty_dimension(spark, how):
    dim = spark.createDataFrame([], "id int, name string")
    df = spark.createDataFrame([([1, 2],)], "ids array<int>")
    assert values(lookup_array_dim(df, "ids", dim, how=how), "names") == [[None, None]]


def test_lookup_form_follows_the_dimension_size(spark):
    small = spark.range(512).selectExpr("cast(id as int) id", "'n' || id as name")
    large = spark.range(513).selectExpr("cast(id as int) id", "'n' || id as name")
    wide = spark.range(3).selectExpr("cast(id as int) id", "repeat('x', 1000000) as name")
    assert fits_in_map(small, "id", "name")
    assert not fits_in_map(large, "id", "name")
    assert not fits_in_map(wide, "id", "name")


def test_lookup_with_a_hot_array(spark):
    """A third of the rows share one array; every row must come back once."""
    dim = spark.range(600).selectExpr("cast(id as int) id", "'n' || id as name")
    df = spark.range(3000).selectExpr(
        "id", "IF(id % 3 = 0, array(7, 8), array(cast(id % 700 as int))) AS ids"
    )
    got = {r["id"]: r["names"] for r in lookup_array_dim(df, "ids", dim).collect()}
    want = {
        i: ["n7", "n8"] if i % 3 == 0 else [f"n{i % 700}" if i % 700 < 600 else None]
        for i in range(3000)
    }
    assert got == want


def test_correlation_modes(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.5), (3.0, None), (4.0, 7.0)], "a double, b double"
    )
    assert correlation(df, "a", "b", "zero").first()[0] == pytest.approx(0.446203, abs=1e-6)
    assert correlation(df, "a", "b", "skip").first()[0] == pytest.approx(0.981981, abs=1e-6)
    assert correlation(df, "a", "b", "zero").first()[0] == pytest.approx(df.stat.corr("a", "b"))
    assert correlation(df, "a", "b", "skip").first()[0] == pytest.approx(
        df.select(F.corr("a", "b")).first()[0]
    )
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert correlation(constant, "a", "b").first()[0] is None
    with pytest.raises(ValueError):
        correlation(df, "a", "b", "other")


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([("en",), ("fr",), (None,), ("en",)], "l string")
    assert distinct_count(df, "l").first()[0] == 3


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_dedup_of_stored_tables(spark, tmp_path, monkeypatch, limit):
    """Against whole rows compared: nulls, arrays, both zeros, copies in one table and across, other column order."""
    monkeypatch.setattr(setops, "BROADCAST_PLACES", limit)
    rng = random.Random(4)
    schema = "a long, t string, x double, l array<string>"
    values = [(1, 2, None), ("u", "", None, 'q"\\'), (0.0, -0.0, 1.5, float("nan"), None), ([], ["u"], [None], None)]
    frames, rows = [], []
    for i in range(3):
        part = [tuple(rng.choice(v) for v in values) for _ in range(150)]
        rows += part
        spark.createDataFrame(part, schema).repartition(3).write.parquet(f"{tmp_path}/{i}")
        frame = spark.read.parquet(f"{tmp_path}/{i}")
        frames.append(frame.select("l", "x", "t", "a") if i == 1 else frame)
    changed = frames[2].withColumn("a", F.col("a") + 1)
    for some in (frames, [frames[0]], [frames[0], frames[0]], [frames[0], frames[2].filter("a = 1"), changed]):
        got = setops.dedup_stored(some).collect()
        want = dedup_rows(union_all(some)).collect()
        assert sorted(map(repr, got)) == sorted(repr(r) for r in want) or (
            # Which of two zeros stays is open.
            sorted(repr(r).replace("-0.0", "0.0") for r in got) == sorted(repr(r).replace("-0.0", "0.0") for r in want)
        )
    wide = frames[0].withColumn("a", F.col("a").cast("int"))
    assert setops.dedup_stored([wide, frames[0]]).count() == dedup_rows(frames[0]).count()
    positions = [frames[0], frames[0].toDF("q", "r", "s", "u")]
    assert setops.dedup_stored(positions, "position").count() == dedup_rows(frames[0]).count()
    made = spark.createDataFrame(rows[:9], schema)
    assert setops.dedup_stored([made, made]).count() == dedup_rows(made).count()


def test_dedup_rows_with_arrays(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2],), ([2, 1],)], "x array<int>")
    assert dedup_rows(df).count() == 2


def test_union_by_name_and_position(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    assert sorted(map(tuple, union_all([a, b]).collect())) == [(1, 2), (4, 3)]
    assert sorted(map(tuple, union_all([a, b], "position").collect())) == [(1, 2), (3, 4)]
    with pytest.raises(ValueError):
        union_all([a, b], "luck")


def test_onehot_null_quote_and_other(spark):
    df = spark.createDataFrame(
        [("it's",)] * 3 + [("b",)] * 2 + [("c",)] + [(None,)] * 2, "g string"
    )
    encoded, names = topk_onehot(df, "g", k=3)
    # Ranked: it's, b, NULL - NULL takes a place and is left out.
    assert names == ["it's", "b", "other_g"]
    by_value = {r["g"]: tuple(r[n] for n in names) for r in encoded.collect()}
    assert by_value == {"it's": (1, 0, 0), "b": (0, 1, 0), "c": (0, 0, 1), None: (0, 0, 0)}


def test_onehot_refuses_to_overwrite(spark):
    df = spark.createDataFrame([(1, "ID")], "id int, lang string")
    with pytest.raises(ValueError, match="exists already"):
        topk_onehot(df, "lang")
    _, names = topk_onehot(df, "lang", prefix="lang_")
    assert names == ["lang_ID", "other_lang"]


def test_onehot_of_only_nulls(spark):
    df = spark.createDataFrame([(None,)], "g string")
    encoded, names = topk_onehot(df, "g")
    assert names == ["other_g"]
    assert values(encoded, "other_g") == [0]


def test_topk_values_match_topk_categories(spark):
    df = spark.createDataFrame([(c,) for c in "aabbcd"] + [(None,)] * 3, "g string")
    ranked = [(r["rank"], r["g"], r["n"]) for r in topk_values(df, "g", 4).orderBy("rank").collect()]
    assert ranked == [(2, "a", 2), (3, "b", 2), (4, "c", 1)]
    assert topk_categories(df, "g", 4) == ["a", "b", "c"]


def test_not_in_without_list(spark):
    df = spark.createDataFrame([("a",), (None,)], "g string")
    assert values(df.select(fn.not_in_flag("g", []).alias("o")), "o") == [1, 0]


def test_constant_columns(spark):
    df = spark.createDataFrame(
        [(False, None, 1, "a"), (False, None, None, "b")], "a boolean, b string, c int, d string"
    )
    assert constant_columns(df) == ["a", "b"]
    assert drop_constant_columns(df).columns == ["c", "d"]


def test_rename_ignores_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rename_columns(df, {"a": "x", "zzz": "y"}).columns == ["x"]


def test_fill_sentinel_leaves_other_columns(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert tuple(fill_sentinel(df, ["a"], "none").first()) == ("none", None)


def test_group_ordering(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 1.0), ("c", 5.0), ("d", None), (None, 3.0)], "k string, v double"
    )
    down = agg.group_agg(df, "k", {"m": ("avg", "v")}, sort_by="m")
    assert values(down, "k") == ["c", None, "a", "b", "d"]
    up = agg.group_agg(df, "k", {"m": ("avg", "v")}, sort_by="m", ascending=True)
    assert values(up, "k") == ["d", "a", "b", None, "c"]
    assert values(agg.group_count(df, "k", n=2), "k") == ["a", "b"]
    with pytest.raises(ValueError):
        agg.group_agg(df, "k", {"m": ("avg", "v")}, n=3)


def test_preview_rows(spark):
    df = spark.range(10)
    assert agg.preview_rows(df, 3).count() == 3
    assert values(agg.preview_rows(df, 2, ["id"]), "id") == [0, 1]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (3, None), (None, None)], "n int, s string")
    assert tuple(null_profile(df).first()) == (1, 2)
    assert [tuple(r) for r in schema_profile(df).collect()] == [("n", "int", 2), ("s", "string", 1)]
    row = describe(df).first()
    assert (row["column"], row["count"], row["mean"], row["min"], row["max"]) == ("n", 2, 2.0, 1.0, 3.0)
    assert summary(df, ["n"]).first()["p50"] == 1.0


def test_describe_matches_spark(spark):
    df = spark.range(100).selectExpr("id * 1.5 AS x")
    ours = describe(df, ["x"]).first()
    theirs = {r["summary"]: float(r["x"]) for r in df.describe().collect()}
    for ours_name, theirs_name in [
        ("count", "count"),
        ("mean", "mean"),
        ("stddev", "stddev"),
        ("min", "min"),
        ("max", "max"),
    ]:
        assert ours[ours_name] == pytest.approx(theirs[theirs_name])


def test_split_is_stable_disjoint_and_complete(spark):
    df = spark.range(2000)
    parts = []
    for n in (1, 7):
        train, test = split_train_test(df.repartition(n))
        a, b = set(values(train, "id")), set(values(test, "id"))
        assert not a & b and len(a | b) == 2000
        parts.append(a)
    assert parts[0] == parts[1]
    assert 1300 < len(parts[0]) < 1500


def test_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None,), (1,)], "id long")
    train, test = split_train_test(df)
    assert train.count() + test.count() == 2


def test_random_split(spark):
    train, test = split_train_test(spark.range(1000), key=None)
    assert train.count() + test.count() == 1000


@pytest.mark.parametrize("size", [64, 1000, quantiles.LARGEST])
def test_exact_quantiles_against_sorting(spark, size):
    """A third of the values are one number; outliers stretch the range."""
    rng = random.Random(7)
    rows = [5.0] * 1000 + [rng.gauss(0, 1) for _ in range(1990)] + [1e12, -1e9, *[0.1] * 8]
    df = spark.createDataFrame([(x,) for x in rows] + [(None,)], "x double")
    df = df.withColumn("y", -F.col("x"))
    ordered = sorted(rows)
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.75, 1.0]
    at = [max(math.ceil(p * len(rows)), 1) - 1 for p in probabilities]
    want = [ordered[i] for i in at]
    mirrored = [-ordered[-1 - i] for i in at]
    assert exact_quantiles(df, ["x", "y"], probabilities, size) == {"x": want, "y": mirrored}


def test_exact_quantiles_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, ["x"]) == {"x": [None, None, None]}
    assert summary(empty, ["x"], accuracy=None).first()["p50"] is None
    same = spark.createDataFrame([(2,), (2,)], "x int")
    assert exact_quantiles(same, ["x"]) == {"x": [2.0, 2.0, 2.0]}
    assert summary(same, ["x"], accuracy=None).first()["p75"] == 2.0


def test_approximate_quartiles_are_within_the_rank_error(spark):
    df = spark.range(300_000).selectExpr("cast(id as double) x").repartition(20)
    for accuracy in (10_000, 200):
        row = summary(df, ["x"], accuracy).first()
        for share, p in zip((0.25, 0.5, 0.75), ("p25", "p50", "p75")):
            assert abs(row[p] - share * 300_000) <= 2 * 300_000 / accuracy + 1
    few = summary(spark.range(9), ["id"]).first()
    assert (few["count"], few["p25"], few["p50"], few["p75"], few["max"]) == (9, 2, 4, 6, 8)


def test_summary_matches_sparks_statistics_over_many_partitions(spark):
    df = spark.range(5000).selectExpr("IF(id % 7 = 0, NULL, 1e9 + id % 100) AS x", "CAST(NULL AS DOUBLE) AS y")
    for accuracy in (10_000, None):
        ours = {r["column"]: r for r in summary(df.repartition(30), accuracy=accuracy).collect()}
        theirs = df.agg(F.count("x"), F.avg("x"), F.stddev_samp("x"), F.min("x"), F.max("x")).first()
        for name, value in zip(("count", "mean", "stddev", "min", "max"), theirs):
            assert ours["x"][name] == pytest.approx(value, rel=1e-9)
        assert ours["y"]["count"] == 0
        assert all(ours["y"][c] is None for c in ("mean", "stddev", "min", "max", "p25", "p50"))


def test_quartiles_take_two_passes_and_copy_no_rows(spark, monkeypatch):
    passes = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    df = spark.range(400_000).select(
        F.xxhash64("id").alias("x"), (F.col("id") % 3).alias("y"), F.lit(7.5).alias("z")
    )
    exact = exact_quantiles(df, ["x", "y", "z"])
    assert len(passes) == 1  # after the first
    ordered = sorted(values(df, "x"))
    assert exact["x"] == [ordered[100_000 - 1], ordered[200_000 - 1], ordered[300_000 - 1]]
    assert exact["y"] == [0, 1, 2] and exact["z"] == [7.5] * 3
    plan = quantiles.merged(df, {"n": F.count("x")}, {"n": F.sum("n")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "Expand" not in text


INF = float("inf")


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("double", [1.0, 2.0, 3.0, INF]),
        ("double", [-INF, 1.0, 2.0]),
        ("double", [-1.7e308, 0.0, 1.0, 1.7e308]),
        ("double", [(-1) ** i * 10.0 ** (i % 600 - 300) for i in range(1000)]),
        ("double", [float("nan"), None, 5.0]),
        ("double", [1.0, 1.0 + 2**-52, 1.0 + 2**-51]),
        ("bigint", [2**53, 2**53 + 1, 2**53 + 2, 2**53 + 3]),
        ("bigint", [-(2**63), 0, 5, 2**63 - 1]),
    ],
)
def test_exact_quantiles_of_any_distribution(spark, monkeypatch, kind, values):
    passes = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    known = sorted(v for v in values if v is not None and v == v)
    expected = [known[max(math.ceil(p * len(known)), 1) - 1] for p in quantiles.QUARTILES]
    for size in (64, quantiles.LARGEST):
        assert exact_quantiles(df, ["x"], size=size)["x"] == expected
    assert len(passes) <= 12


def test_describe_keeps_64_bit_extremes(spark):
    df = spark.createDataFrame([(2**53 + 1,), (-(2**53) - 1,)], "x bigint")
    row = prof.describe(df).first()
    assert (row["min"], row["max"]) == (-(2**53) - 1, 2**53 + 1)
    assert prof.summary(df, accuracy=None).first()["p75"] == 2**53 + 1


def test_onehot_of_a_dotted_value_reaches_a_model(spark):
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(1, "a.b"), (2, "c")], "id int, c string")
    rows, names = topk_onehot(df, "c", 5, "c_")
    assert names == ["c_a_b", "c_c", "other_c"]
    assert rows.schema["c_a_b"].metadata == {"category": "a.b"}
    out = VectorAssembler(inputCols=names, outputCol="f").transform(rows).orderBy("id")
    assert [list(r["f"]) for r in out.collect()] == [[1, 0, 0], [0, 1, 0]]
    clash = spark.createDataFrame([("a.b",), ("a_b",)], "c string")
    with pytest.raises(ValueError, match="a_b"):
        topk_onehot(clash, "c")


def test_a_large_dimension_is_refused_as_a_map(spark):
    large = spark.range(513).selectExpr("cast(id as int) id", "'n' || id as name")
    df = spark.createDataFrame([([1, 2],)], "ids array<int>")
    with pytest.raises(ValueError, match="512 rows"):
        lookup_array_dim(df, "ids", large, how="map")
