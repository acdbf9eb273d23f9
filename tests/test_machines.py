"""Searches over factorization machines: the library's fits, in a bounded number of passes."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.regression import FMRegressor

from marquee.plans import machines
from marquee.plans import modeling as ml
from marquee.plans.machines import search


def rows(spark, n=300):
    rng = random.Random(4)
    made = [(i, rng.random(), rng.choice([0.0, 1.0, 3.0]), rng.gauss(2, 1)) for i in range(n)]
    made = [(i, a, b, c, 2 + a - b + a * c + rng.gauss(0, 0.3)) for i, a, b, c in made]
    return spark.createDataFrame(made, "id long, a double, b double, c double, vote_average double").repartition(5)


@pytest.fixture(scope="module")
def parts(spark):
    whole = rows(spark)
    prepared = ml.create_pipeline(ml.preparation(["a", "b", "c"])[:-1], ml.preparation(["a", "b", "c"])[-1]).fit(whole)
    done = prepared.transform(whole).select("id", "vote_average", ml.SCALED).cache()
    return done.filter("id % 4 <> 0"), done.filter("id % 4 = 0")


@pytest.mark.parametrize(
    "settings",
    [{}, {"regParam": 0.3}, {"fitLinear": False}, {"fitIntercept": False}, {"tol": 0.05, "maxIter": 40}],
)
def test_search_equals_the_library(spark, parts, settings):
    base = {"solver": "gd", "maxIter": 7, "tol": 0.0, "initStd": 0.3, "seed": 42, **settings}
    regressor = FMRegressor(featuresCol=ml.SCALED, labelCol=ml.LABEL, **base)
    grid = ml.param_grid(regressor, {"stepSize": [0.002, 0.01, 0.05], "factorSize": [2, 5]})
    assert machines.full_batch(regressor, grid)
    want = [
        ml.regression_metrics(regressor.copy(point).fit(parts[0]).transform(parts[1])).first()["rmse"] for point in grid
    ]
    assert search(*parts, regressor, grid, machines.width(parts[0], ml.SCALED)) == pytest.approx(want, rel=1e-9, nan_ok=True)


def test_passes_do_not_grow_with_the_grid(spark):
    """Steps, points and folds of a search add no jobs but those of the last fit."""
    whole = rows(spark).cache()
    whole.count()
    regressor = FMRegressor(featuresCol=ml.SCALED, labelCol=ml.LABEL, solver="gd", maxIter=3, tol=0.0, seed=42)
    spark.sparkContext.setJobGroup("machines", "search")
    counts = []
    tracker = spark.sparkContext.statusTracker()
    for n in (1, 6):
        group = f"machines-{n}"
        spark.sparkContext.setJobGroup(group, "search")
        grid = ml.param_grid(regressor, {"stepSize": [0.001 * (i + 1) for i in range(n)]})
        ml.tune("fm", ml.preparation(["a", "b"]), regressor, grid, whole, whole, folds=2)
        counts.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1] > 0


def test_missing_labels_are_an_error(spark, parts):
    from pyspark.sql import functions as F

    bad = parts[0].withColumn("vote_average", F.when(F.col("id") != 5, F.col("vote_average")))
    regressor = FMRegressor(featuresCol=ml.SCALED, labelCol=ml.LABEL, solver="gd", maxIter=2)
    with pytest.raises(Exception, match="NULL, NaN"):
        search(bad, parts[1], regressor, ml.param_grid(regressor, {"factorSize": [2]}), 3)


def test_models_of_a_fold_are_scored_in_one_pass(spark, monkeypatch):
    """Every point gets its own rmse, and points add no passes over the held rows."""
    from pyspark.ml.regression import DecisionTreeRegressor

    whole, calls, metrics = rows(spark).cache(), [], ml._metrics
    monkeypatch.setattr(ml, "_metrics", lambda *a: (calls.append(a), metrics(*a))[1])
    regressor = DecisionTreeRegressor(featuresCol=ml.SCALED, labelCol=ml.LABEL, seed=42)
    grid = ml.param_grid(regressor, {"maxDepth": [0, 2, 4]})
    fitted = ml.tune("tree", ml.preparation(["a", "b"]), regressor, grid, whole, whole, folds=2)
    assert len(calls) == 2 + 1
    fold = ml.hash_bucket("id", 2, salt="fold:")
    for point, (_, mean) in zip(grid, fitted.search):
        by_hand = []
        for i in range(2):
            chain = ml.create_pipeline(ml.preparation(["a", "b"]), regressor.copy(point))
            held = chain.fit(whole.filter(fold != i)).transform(whole.filter(fold == i))
            by_hand.append(ml.regression_metrics(held).first()["rmse"])
        assert mean == pytest.approx(sum(by_hand) / 2)


@pytest.mark.parametrize("settings", [{}, {"regParam": 0.01, "fitLinear": False}, {"tol": 0.02, "maxIter": 60}])
def test_adaptive_steps_equal_the_library(spark, parts, settings):
    """The library's default solver, whose every step sees all rows too."""
    base = {"maxIter": 30, "seed": 42, **settings}
    regressor = FMRegressor(featuresCol=ml.SCALED, labelCol=ml.LABEL, **base)
    grid = ml.param_grid(regressor, {"stepSize": [0.001, 0.1], "factorSize": [2, 5]})
    assert machines.full_batch(regressor, grid)
    want = [
        ml.regression_metrics(regressor.copy(point).fit(parts[0]).transform(parts[1])).first()["rmse"] for point in grid
    ]
    assert search(*parts, regressor, grid, machines.width(parts[0], ml.SCALED)) == pytest.approx(want, rel=1e-8)


def test_mini_batches_are_left_to_the_library(spark):
    regressor = FMRegressor(featuresCol=ml.SCALED, labelCol=ml.LABEL)
    assert not machines.full_batch(regressor, ml.param_grid(regressor, {"miniBatchFraction": [0.5]}))
