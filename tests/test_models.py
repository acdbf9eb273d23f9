"""Models: metrics, leak, stored pipelines, run log, tuning."""

from __future__ import annotations

import os
from math import inf
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor

from oracle import compare, connect, oracle_rows

from marquee.lake import LakePaths
from marquee.plans import modeling as ml
from marquee.sources import models as store
from workload.model_queries import model_data


@pytest.fixture(scope="module")
def data(spark):
    # The scores' floors need more rows than the other tests' tables have.
    return model_data(spark, os.environ.get("TEST_MODEL_DIR", "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def tree(data):
    frame, train, test = data
    pipeline = ml.create_pipeline(ml.preparation(frame.features()), ml.regressors()["tree"])
    return ml.train_and_evaluate("tree", pipeline, train, test)


def test_feature_list(data):
    frame, _, _ = data
    assert frame.features()[:9] == list(ml.NUMERIC_FEATURES)
    assert ml.CATEGORY_INDEX not in frame.features(leak_free=True)
    assert "other_genre_names" in frame.features() and "other_original_language" in frame.features()
    assert set(ml.feature_nulls(frame).first()) == {0}


def test_metrics_equal_the_evaluator(data, tree):
    _, _, test = data
    predictions = tree.model.transform(test)
    evaluator = RegressionEvaluator(labelCol=ml.LABEL)
    for name, value in tree.metrics.items():
        assert value == pytest.approx(evaluator.setMetricName(name).evaluate(predictions))


def test_same_seed_same_predictions(data, tree):
    frame, train, test = data
    pipeline = ml.create_pipeline(ml.preparation(frame.features()), ml.regressors()["tree"])
    again = ml.train_and_evaluate("tree", pipeline, train, test)
    assert again.metrics == tree.metrics


@pytest.mark.parametrize(
    ("name", "floor"), [("tree", 0.8), ("gbt", 0.8), ("forest", 0.7), ("linear", 0.24)]
)
def test_label_leak_is_what_scores_well(data, name, floor):
    frame, train, test = data
    scores = {}
    for leak_free in (False, True):
        stages = ml.preparation(frame.features(leak_free))
        pipeline = ml.create_pipeline(stages, ml.regressors()[name])
        scores[leak_free] = ml.train_and_evaluate(name, pipeline, train, test).metrics["r2"]
    assert scores[False] >= floor > scores[True]


def test_factorization_machine_on_all_features(data):
    """Years that are not centred make its default steps far too large; smaller ones come close to a line."""
    frame, train, test = data
    scores = []
    for step in (1.0, 0.001):
        regressor = ml.regressors()["fm"].setStepSize(step).setMaxIter(200)
        pipeline = ml.create_pipeline(ml.preparation(frame.features()), regressor)
        scores.append(ml.train_and_evaluate("fm", pipeline, train, test).metrics["rmse"])
    assert scores[1] < 0.1 * scores[0] < inf


def test_saved_model_predicts_the_same(data, tree, tmp_path):
    _, _, test = data
    path = str(tmp_path / store.BEST_MODEL)
    store.save_model(tree.model, path)
    store.save_model(tree.model, path)
    before = {r["id"]: r["prediction"] for r in tree.model.transform(test).collect()}
    after = {r["id"]: r["prediction"] for r in store.load_model(path).transform(test).collect()}
    assert before == after


def test_tune_picks_the_lowest_mean_rmse(data):
    frame, train, test = data
    regressor = ml.regressors()["tree"]
    grid = ml.param_grid(regressor, {"maxDepth": [1, 6]})
    stages = ml.preparation(frame.features(leak_free=True))
    fitted = ml.tune("tree", stages, regressor, grid, train, test, folds=2)
    shallow, deep = (mean for _, mean in fitted.search)
    assert deep < shallow
    assert fitted.model.stages[-1].getOrDefault("maxDepth") == 6
    # The mean by hand: one full pipeline per fold.
    fold = ml.hash_bucket("id", 2, salt="fold:")
    by_hand = []
    for i in range(2):
        model = Pipeline(stages=[*stages, regressor.copy(grid[1])]).fit(train.filter(fold != i))
        held = model.transform(train.filter(fold == i))
        by_hand.append(RegressionEvaluator(labelCol=ml.LABEL).evaluate(held))
    assert deep == pytest.approx(sum(by_hand) / 2)


def test_tune_refuses_foreign_parameters(data):
    frame, train, test = data
    stages = ml.preparation(frame.features())
    grid = ml.param_grid(stages[-1], {"withMean": [True, False]})
    with pytest.raises(ValueError, match="regressor"):
        ml.tune("tree", stages, ml.regressors()["tree"], grid, train, test)


def test_fold_sizes_are_those_of_the_search(data):
    _, train, _ = data
    fold = ml.hash_bucket("id", 3, salt="fold:")
    total = train.count()
    for r in ml.fold_sizes(train, 3).collect():
        assert r["n_held"] == train.filter(fold == r["fold"]).count() == total - r["n_fitted"]


def test_a_search_that_ignores_its_grid_is_noticed(spark, monkeypatch):
    """The registered searches' points differ, so the SQL sees which point was fitted."""
    import workload.model_queries as queries
    from workload.registry import ORACLES

    con = connect("/root/testdata/sf0.001")
    for name in ("tune_tree", "tune_forest", "tune_gbt", "tune_fm", "tune_cv"):
        _, rows = oracle_rows(con, ORACLES[name])
        assert len({r[0] for r in rows}) >= 3, name
    monkeypatch.setattr(DecisionTreeRegressor, "copy", lambda self, extra=None: self)
    problem, _ = compare(spark, con, "/root/testdata/sf0.001", queries.tune_cv, ORACLES["tune_cv"])
    assert problem


def test_grid_sizes():
    models = ml.regressors()
    sizes = {n: len(ml.param_grid(models[n], v)) for n, (v, _) in ml.GRIDS.items()}
    assert sizes == {"fm": 9, "linear": 9, "tree": 9, "forest": 2, "gbt": 3}


def test_run_log_and_selection(spark, tree, tmp_path):
    lake = LakePaths(str(tmp_path))
    first = store.log_run(spark, lake, tree, "training")
    worse = ml.Fitted("tree", tree.model, tree.metrics | {"rmse": 99.0})
    store.log_run(spark, lake, worse, "training", keep_model=False)
    runs = store.read_runs(spark, lake)
    assert runs.select("run_id").distinct().count() == 2
    assert store.select_best(store.run_metrics(runs)).first()["run_id"] == first
    names = {r["value"] for r in runs.filter("key = 'Model Name'").collect()}
    assert names == {"DecisionTreeRegressionModel"}
    assert runs.filter("key = 'DecisionTreeRegressionModel_maxDepth'").count() == 2
    store.load_model(lake.gold(f"runs/{first}/model"))


def test_publish_counts_versions(spark, data, tree, tmp_path):
    lake = LakePaths(str(tmp_path))
    assert [store.publish_model(spark, lake, tree.model, "p") for _ in range(2)] == [1, 2]
    assert store.publish_model(spark, lake, tree.model, "q") == 1
    loaded = store.load_published(spark, lake, "p")
    _, _, test = data
    assert loaded.transform(test).count() == test.count()
    assert type(store.load_published(spark, lake, "p", 1).stages[-1]) is type(tree.model.stages[-1])
    with pytest.raises(LookupError):
        store.load_published(spark, lake, "p", 9)
    with pytest.raises(LookupError):
        store.load_published(spark, lake, "none")


def test_two_publishers_at_once_get_two_versions(spark, tree, tmp_path, monkeypatch):
    """One publishes between the other's reading of the last version and its writing of the next."""
    lake = LakePaths(str(tmp_path / "a lake"))
    listed = store.published_models
    store.publish_model(spark, lake, tree.model, "a b/c%")
    between = []

    def read_then_wait(*args):
        table = listed(*args)
        if not between:
            rows = table.collect()
            between.append(1)
            between.append(store.publish_model(spark, lake, tree.model, "a b/c%"))
            return spark.createDataFrame(rows, store.MODEL_TABLE)
        return table

    monkeypatch.setattr(store, "published_models", read_then_wait)
    assert store.publish_model(spark, lake, tree.model, "a b/c%") == 3 and between[1] == 2
    monkeypatch.undo()
    rows = store.published_models(spark, lake, "a b/c%").collect()
    assert sorted(r["version"] for r in rows) == [1, 2, 3] and len({r["path"] for r in rows}) == 3
    assert type(store.load_published(spark, lake, "a b/c%").stages[-1]) is type(tree.model.stages[-1])


def test_a_version_is_created_once(spark, tmp_path):
    record = store._record(LakePaths(str(tmp_path)), "m", 1)
    with ThreadPool(8) as pool:
        won = pool.map(lambda i: store._claim(spark, record, ["m", 1, "k", f"path{i}"]), range(16))
    assert sum(won) == 1
    (row,) = store.published_models(spark, LakePaths(str(tmp_path)), "m").collect()
    assert row["path"] == f"path{won.index(True)}"


def test_a_failed_publisher_blocks_nothing(spark, tree, tmp_path, monkeypatch):
    lake = LakePaths(str(tmp_path / "lake"))
    with monkeypatch.context() as broken:
        broken.setattr(store, "MODEL_TABLE", "no such type")
        with pytest.raises(Exception):  # noqa: B017
            store.publish_model(spark, lake, tree.model, "m")
    assert store.publish_model(spark, lake, tree.model, "m") == 1
    assert store.publish_model(spark, lake, tree.model, "m") == 2


def test_a_run_whose_model_cannot_be_saved_is_not_logged(spark, tree, tmp_path, monkeypatch):
    lake = LakePaths(str(tmp_path / "lake"))

    def fail(*_):
        raise OSError("disk full")

    monkeypatch.setattr(store, "save_model", fail)
    with pytest.raises(OSError):
        store.log_run(spark, lake, tree, "training")
    assert not (tmp_path / "lake").exists()


def test_tune_raises_where_every_point_diverges(data, monkeypatch):
    frame, train, test = data
    regressor = ml.regressors()["tree"]
    monkeypatch.setattr(ml, "_metrics", lambda *_: {"rmse": float("nan")})
    with pytest.raises(ArithmeticError, match="tree"):
        ml.tune("tree", ml.preparation(["vote_count"]), regressor,
                ml.param_grid(regressor, {"maxDepth": [1]}), train, test, folds=2)


WHOLE = ["fm", "tree"]


@pytest.mark.parametrize("name", WHOLE)
def test_whole_searches_leave_nothing_out(spark, monkeypatch, name):
    """All features, the regressor as the library has it, the whole grid."""
    from workload.registry import QUERIES

    class Called(Exception):
        pass

    def tune(name, stages, regressor, grid, train, test, folds=3, **_):
        raise Called(stages, regressor, grid, folds)

    monkeypatch.setattr(ml, "tune", tune)
    with pytest.raises(Called) as got:
        QUERIES[f"tune_{name}"](spark, "/root/testdata/sf0.001")
    stages, regressor, grid, folds = got.value.args
    inputs = next(s for s in stages if s.hasParam("inputCols") and s.isDefined("inputCols")).getInputCols()
    assert set(ml.NUMERIC_FEATURES) < set(inputs) and any(c.startswith("genre_") for c in inputs)
    assert {"other_genre_names", "other_original_language"} < set(inputs)
    plain = ml.regressors()[name]
    assert {p.name: v for p, v in regressor.extractParamMap().items()} == {
        p.name: v for p, v in plain.extractParamMap().items()
    }
    values, n = ml.GRIDS[name]
    assert (len(grid), folds) == (len(ml.param_grid(plain, values)), n)
    for key, listed in values.items():
        assert {v for point in grid for p, v in point.items() if p.name == key} == set(listed)
