"""Registered queries for regression, tuning, selection and stored models."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.lake import LakePaths
from marquee.operators.encode import split_train_test
from marquee.plans import modeling as ml
from marquee.session import scratch_path, stage
from marquee.sources import models as store
from workload import fixture as fx
from workload.encode_queries import BUCKET_SQL, PREFIXES, fold_sql
from workload.fixture import over_catalog, over_processed
from workload.model_sql import (
    CELLS_SQL,
    ERRORS,
    FRAME_SQL,
    MACHINE,
    TWO,
    boosted_sql,
    errors_sql,
    linear,
    machine_sql,
    machines_sql,
    rows_sql,
    solved_sql,
    tree_sql,
    trees_sql,
)
from workload.registry import register

METRICS = ("rmse", "mae", "mse", "r2")
LABEL = ml.LABEL


def model_data(spark: SparkSession, sf_dir: str) -> tuple[ml.ModelFrame, DataFrame, DataFrame]:
    """Model frame, training and test rows, over a staged narrow table.

    Few overviews are known in this catalogue and the assembler refuses NULLs,
    so an unknown overview has length 0.
    """
    derived = {ml.CATEGORY_INDEX, "normalized_popularity"}
    needed = ["id", LABEL, ml.CATEGORY, *ml.ENCODED]
    needed += [c for c in ml.NUMERIC_FEATURES if c not in derived]
    movies = fx.processed_narrow(spark, sf_dir, needed)
    known = movies.withColumn("overview_length", F.coalesce("overview_length", F.lit(0)))
    frame = ml.build_model_frame(known, prefixes=PREFIXES)
    inputs = [c for c in frame.features() if c != ml.CATEGORY_INDEX]
    # A second 0/1 feature beside ``is_remake``, for models that SQL repeats cell by cell.
    half = (F.col("release_month") > 6).cast("int").alias("second_half")
    rows = stage(frame.rows.select("id", LABEL, ml.CATEGORY, *inputs, half), "model_frame")
    frame = ml.ModelFrame(rows, frame.encoded)
    return frame, *split_train_test(rows)


def _pipeline(frame: ml.ModelFrame, name: str, leak_free: bool = False) -> Pipeline:
    stages = ml.preparation(frame.features(leak_free))
    return ml.create_pipeline(stages, ml.regressors()[name])


# What the tree models learn from two 0/1 features, and a factorization machine from its moments, SQL
# can repeat; least squares it repeats on all numeric features, a search over trees or machines on all.  Scores
# of the others with all features are in the tests.
ALL_NUMERIC = list(ml.NUMERIC_FEATURES)
LEAK_FREE = [c for c in ALL_NUMERIC if c != ml.CATEGORY_INDEX]
STEPS, SPREAD = 20, 0.3
# The solver's sums are not centred, and an age says nearly what a date does: its scores have some four
# digits that do not depend on the order of rows.
SURE = 3
# Trees learn from labels in steps of this part of 1: sums of them are exact in any order of rows, and with them
# which of two equal splits is taken.
TICKS = 1 << 16


def small(name: str) -> Estimator:
    """A regressor for ``TWO`` that neither samples rows nor stops before what SQL computes."""
    regressor = ml.regressors()[name]
    if name == "tree":
        return regressor.setMaxDepth(2)
    if name == "gbt":
        return regressor.setMaxDepth(1).setMaxIter(2)
    if name == "forest":
        return regressor.setMaxDepth(2).setBootstrap(False).setFeatureSubsetStrategy("all")
    if name == "fm":
        # Full-batch steps from a start that is far enough from 0 for the product term to count.
        return regressor.setSolver("gd").setMaxIter(STEPS).setTol(0.0).setInitStd(SPREAD).setStepSize(0.02)
    return regressor


LINEAR_SQL = f"""{FRAME_SQL}, known AS (SELECT * FROM indexed WHERE is_train),
{solved_sql("full_weights", ALL_NUMERIC, "known")},
{solved_sql("free_weights", LEAK_FREE, "known")}"""
FULL_SCORED = f"SELECT vote_average AS y, {linear(ALL_NUMERIC)} AS p FROM indexed CROSS JOIN full_weights WHERE NOT is_train"
FREE_SCORED = f"SELECT vote_average AS y, {linear(LEAK_FREE)} AS p FROM indexed CROSS JOIN free_weights WHERE NOT is_train"

DEEP = "SELECT 'deep', 2, 1"
TREE_SQL = f"""{rows_sql()}, {CELLS_SQL}, {tree_sql("leaves", DEEP)},
scored AS (SELECT id, y, p FROM held JOIN leaves USING (part, a, b))"""
BOOSTED_SQL = f"""{rows_sql()}, {CELLS_SQL}, {boosted_sql("SELECT 'boosted', 0.1")},
scored AS (SELECT y, p FROM held JOIN leaves USING (part, a, b))"""
MACHINE_SQL = f"""{rows_sql()}, {machine_sql([("one", 0.02, 8)], STEPS, SPREAD)},
scored AS (SELECT y, {MACHINE} AS p FROM held JOIN machines USING (part))"""


def _scores(spark: SparkSession, rows: list[tuple[str, dict[str, float]]], digits: int = 6) -> DataFrame:
    scores = spark.createDataFrame(
        [(model, *(scores[m] for m in METRICS)) for model, scores in rows],
        "model string, " + ", ".join(f"{m} double" for m in METRICS),
    )
    return scores.select("model", *(F.round(m, digits).alias(m) for m in METRICS))


@register(
    "ml_linear",
    over_processed(
        f"""{LINEAR_SQL}
        SELECT 'linear' AS model, {errors_sql(SURE)} FROM ({FULL_SCORED})
        UNION ALL SELECT 'linear_leak_free' AS model, {errors_sql(SURE)} FROM ({FREE_SCORED})"""
    ),
)
def ml_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out scores of least squares on all numeric features, with the label's bucket and without."""
    _, train, test = model_data(spark, sf_dir)
    rows = []
    for name, features in (("linear", ALL_NUMERIC), ("linear_leak_free", LEAK_FREE)):
        pipeline = ml.create_pipeline(ml.preparation(features), ml.regressors()["linear"])
        rows.append((name, ml.train_and_evaluate(name, pipeline, train, test).metrics))
    return _scores(spark, rows, SURE)


def _register_model(name: str, sql: str) -> None:
    """Held-out scores of a model on two features."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, train, test = model_data(spark, sf_dir)
        pipeline = ml.create_pipeline(ml.preparation(TWO), small(name))
        fitted = ml.train_and_evaluate(name, pipeline, train, test)
        return _scores(spark, [(name, fitted.metrics)])

    register(f"ml_{name}", over_processed(f"{sql} SELECT '{name}' AS model, {ERRORS} FROM scored"))(run)


for _name, _sql in (("tree", TREE_SQL), ("forest", TREE_SQL), ("gbt", BOOSTED_SQL), ("fm", MACHINE_SQL)):
    _register_model(_name, _sql)


def _linear_search_sql(folds: int, values: dict[str, list[float]]) -> str:
    """Elastic net on one feature: the correlation, softened by L1 and shrunk by L2."""
    listed = ", ".join(
        f"('elasticNetParam={a}, regParam={r}', {r}, {a})"
        for r in values["regParam"]
        for a in values["elasticNetParam"]
    )
    return over_processed(
        f"""{FRAME_SQL},
        folded AS (SELECT is_remake, vote_average AS y, {fold_sql(folds)} AS fold FROM frame WHERE is_train),
        fits AS (SELECT i AS fold, y, is_remake FROM folded JOIN range({folds}) r(i) ON folded.fold <> i),
        grid AS (SELECT * FROM (VALUES {listed}) AS v(point, reg, mix)),
        moments AS (SELECT fold, avg(y) AS my, stddev_pop(y) AS sy, avg(is_remake) AS mx,
                           stddev_pop(is_remake) AS sx, corr(is_remake, y) AS c FROM fits GROUP BY fold),
        lines AS (SELECT *, sign(c) * greatest(abs(c) - mix * reg / sy, 0) / (1 + (1 - mix) * reg / sy)
                            * sy / sx AS slope FROM moments CROSS JOIN grid),
        errors AS (SELECT point, fold, sqrt(avg((y - my - slope * (is_remake - mx)) ** 2)) AS rmse
                   FROM folded JOIN lines USING (fold) GROUP BY point, fold)
        SELECT 'linear' AS model, point, round(avg(rmse), 6) AS cv_rmse FROM errors GROUP BY point"""
    )


def _point(values: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(values.items()))


# The searches of the registered queries.  Machines and trees search their whole grids on all features; the
# forests' points differ in what a model on two features learns.
SEARCHES: dict[str, tuple[dict[str, list], int]] = {
    "fm": ml.GRIDS["fm"],
    "linear": ml.GRIDS["linear"],
    "tree": ml.GRIDS["tree"],
    "forest": ({"numTrees": [5, 10], "maxDepth": [0, 1, 2]}, 2),
    "gbt": ml.GRIDS["gbt"],
}


def _points(values: dict[str, list]) -> list[dict]:
    return [dict(zip(values, p)) for p in product(*values.values())]


def _search_sql(name: str, folds: int, models: str) -> str:
    """The mean over the folds of each point's rmse; ``models`` gives ``leaves`` (part, point, a, b, p)."""
    return over_processed(
        f"""{rows_sql(folds)}, {models},
        errors AS (SELECT part, point, sqrt(avg((y - (p)) ** 2)) AS rmse FROM held JOIN leaves USING (part, a, b)
                   GROUP BY part, point)
        SELECT '{name}' AS model, point, round(avg(rmse), 6) AS cv_rmse FROM errors GROUP BY point"""
    )


def _tree_search_sql(name: str, values: dict[str, list], folds: int) -> str:
    listed = ", ".join(
        f"('{_point(p)}', {p['maxDepth']}, {p.get('minInstancesPerNode', 1)})" for p in _points(values)
    )
    return _search_sql(name, folds, f"{CELLS_SQL}, {tree_sql('leaves', f'VALUES {listed}')}")


def _boosted_search_sql(values: dict[str, list], folds: int) -> str:
    listed = ", ".join(f"('{_point(p)}', {p['stepSize']})" for p in _points(values))
    return _search_sql("gbt", folds, f"{CELLS_SQL}, {boosted_sql(f'VALUES {listed}')}")


def _whole_search_sql(name: str, errors: str) -> str:
    return over_processed(
        f"""{errors} SELECT '{name}' AS model, point, round(avg(rmse), 6) AS cv_rmse FROM errors GROUP BY point"""
    )


def _machine_search_sql(values: dict[str, list], folds: int) -> str:
    points = [(_point(p), p["stepSize"], p["factorSize"]) for p in _points(values)]
    # The library's defaults: 100 steps, from a start of deviation 0.01.
    return _whole_search_sql("fm", machines_sql(points, 100, 0.01, folds))


def _deep_search_sql(values: dict[str, list], folds: int) -> str:
    points = [(_point(p), p["maxDepth"], p["minInstancesPerNode"]) for p in _points(values)]
    label = f"round({LABEL} * {TICKS}) / {TICKS}"
    return _whole_search_sql("tree", trees_sql(points, folds, label))


def _search_rows(spark: SparkSession, fitted: ml.Fitted) -> DataFrame:
    rows = [(fitted.name, _point(point), mean) for point, mean in fitted.search]
    return spark.createDataFrame(rows, "model string, point string, cv_rmse double").select(
        "model", "point", F.round("cv_rmse", 6).alias("cv_rmse")
    )


def _search(spark: SparkSession, sf_dir: str, name: str, values: dict, folds: int) -> DataFrame:
    _, train, test = model_data(spark, sf_dir)
    regressor = small(name)
    grid = ml.param_grid(regressor, values)
    stages = ml.preparation(["is_remake"] if name == "linear" else TWO)
    fitted = ml.tune(name, stages, regressor, grid, train, test, folds, parallelism=8)
    return _search_rows(spark, fitted)


def _whole_search(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The library's regressor as it is, on all features, over the whole grid."""
    values, folds = SEARCHES[name]
    frame, train, test = model_data(spark, sf_dir)
    if name == "tree":
        train, test = (rows.withColumn(LABEL, F.round(F.col(LABEL) * TICKS) / TICKS) for rows in (train, test))
    regressor = ml.regressors()[name]
    grid = ml.param_grid(regressor, values)
    fitted = ml.tune(name, ml.preparation(frame.features()), regressor, grid, train, test, folds, parallelism=8)
    return _search_rows(spark, fitted)


def _register_search(name: str, sql: str) -> None:
    """Mean rmse of every grid point."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if name in ("fm", "tree"):
            return _whole_search(spark, sf_dir, name)
        return _search(spark, sf_dir, name, *SEARCHES[name])

    register(f"tune_{name}", sql)(run)


_register_search("fm", _machine_search_sql(*SEARCHES["fm"]))
_register_search("linear", _linear_search_sql(SEARCHES["linear"][1], SEARCHES["linear"][0]))
_register_search("gbt", _boosted_search_sql(*SEARCHES["gbt"]))
_register_search("tree", _deep_search_sql(*SEARCHES["tree"]))
_register_search("forest", _tree_search_sql("forest", *SEARCHES["forest"]))


@register(
    "ml_pipeline",
    over_processed(
        f"""{FRAME_SQL}
        SELECT id, vote_average, rating_category_index,
          round(vote_count / (SELECT stddev_samp(vote_count) FROM frame WHERE is_train), 6)
            AS scaled_votes, true AS is_predicted
        FROM indexed WHERE NOT is_train"""
    ),
)
def ml_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index, assemble, scale and regress in one fitted chain, over the test rows."""
    frame, train, test = model_data(spark, sf_dir)
    votes = F.get(vector_to_array(ml.SCALED), F.lit(frame.features().index("vote_count")))
    scored = _pipeline(frame, "linear").fit(train).transform(test)
    return scored.select(
        "id",
        LABEL,
        "rating_category_index",
        F.round(votes, 6).alias("scaled_votes"),
        F.col("prediction").isNotNull().alias("is_predicted"),
    )


def _deviations(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """What the fitted scaler divides the numeric features by."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    rows = [(n, float(d)) for n, d in zip(ml.NUMERIC_FEATURES, scaler.std)]
    return spark.createDataFrame(rows, "feature string, stddev double").select(
        "feature", F.round("stddev", 6).alias("stddev")
    )


DEVIATIONS_SQL = over_processed(
    FRAME_SQL
    + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, round(stddev_samp({c}), 6) AS stddev FROM indexed WHERE is_train"
        for c in ml.NUMERIC_FEATURES
    )
)


@register("ml_fit", DEVIATIONS_SQL)
def ml_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline learns from the training rows alone: the scaler's deviations show it."""
    frame, train, _ = model_data(spark, sf_dir)
    return _deviations(spark, _pipeline(frame, "linear").fit(train))


@register(
    "ml_score",
    over_processed(
        f"""{FRAME_SQL},
        line AS (SELECT regr_slope(vote_average, vote_count) AS b,
                        regr_intercept(vote_average, vote_count) AS a FROM frame WHERE is_train)
        SELECT id, vote_average, round(a + b * vote_count, 6) AS prediction
        FROM frame CROSS JOIN line WHERE NOT is_train"""
    ),
)
def ml_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A least-squares line fitted on the training rows, over the test rows."""
    _, train, test = model_data(spark, sf_dir)
    line = ml.create_pipeline(ml.preparation(["vote_count"]), ml.regressors()["linear"])
    scored = line.fit(train).transform(test)
    return scored.select("id", LABEL, F.round("prediction", 6).alias("prediction"))


@register(
    "ml_tree_one_split",
    over_processed(
        f"""{FRAME_SQL},
        leaves AS (SELECT is_remake, avg(vote_average) AS leaf FROM frame WHERE is_train
                   GROUP BY is_remake)
        SELECT id, round(leaf, 6) AS prediction FROM frame JOIN leaves USING (is_remake)
        WHERE NOT is_train"""
    ),
)
def ml_tree_one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split on a 0/1 feature: its leaves are the two training means."""
    _, train, test = model_data(spark, sf_dir)
    stump = ml.regressors()["tree"].setMaxDepth(1)
    pipeline = ml.create_pipeline(ml.preparation(["is_remake"]), stump)
    scored = pipeline.fit(train).transform(test)
    return scored.select("id", F.round("prediction", 6).alias("prediction"))


@register(
    "ml_linear_one_feature",
    over_catalog(
        "SELECT round(regr_slope(vote_average, vote_count), 6) AS slope,"
        " round(regr_intercept(vote_average, vote_count), 6) AS intercept FROM catalog"
    ),
)
def ml_linear_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature and no penalty: least squares, which SQL can repeat."""
    rows = stage(fx.catalog(spark, sf_dir, texts=False).select("vote_count", LABEL), "votes")
    assembled = VectorAssembler(inputCols=["vote_count"], outputCol="features").transform(rows)
    fitted = LinearRegression(labelCol=LABEL, solver="normal").fit(assembled)
    return spark.createDataFrame(
        [(float(fitted.coefficients[0]), float(fitted.intercept))],
        "slope double, intercept double",
    ).select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


# Fixed linear scorers: prediction = base + weight * column.
SCORERS = {
    "by_votes": (3.0, 0.02, "vote_count"),
    "by_price": (4.0, 0.00001, "popularity"),
    "constant": (5.0, 0.0, "vote_count"),
}


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scorer's prediction for the test rows, in one pass."""
    movies = fx.catalog(spark, sf_dir, texts=False).select("id", LABEL, "vote_count", "popularity")
    _, test = split_train_test(movies)
    predictions = [
        F.struct(
            F.lit(model).alias("model"),
            (F.lit(base) + F.lit(weight) * F.col(column)).alias("prediction"),
        )
        for model, (base, weight, column) in SCORERS.items()
    ]
    return test.select(LABEL, F.inline(F.array(*predictions)))


def _errors_sql() -> str:
    scored = " UNION ALL ".join(
        f"SELECT '{model}' AS model, vote_average AS y, {base} + {weight} * {column} AS p"
        f" FROM catalog WHERE NOT ({BUCKET_SQL})"
        for model, (base, weight, column) in SCORERS.items()
    )
    return f", scored AS ({scored})"


@register(
    "ml_metrics",
    over_catalog(
        f"""{_errors_sql()}
        SELECT round(sqrt(avg((y - p) ** 2)), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
          round(avg((y - p) ** 2), 6) AS mse,
          round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)), 6) AS r2
        FROM scored WHERE model = 'by_votes'"""
    ),
)
def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four metrics of one scorer."""
    predictions = _scored(spark, sf_dir).filter(F.col("model") == "by_votes")
    metrics = ml.regression_metrics(predictions)
    return metrics.select(*(F.round(m, 6).alias(m) for m in METRICS))


@register(
    "select_best",
    over_catalog(
        f"""{_errors_sql()}
        SELECT model, round(sqrt(avg((y - p) ** 2)), 6) AS rmse FROM scored
        GROUP BY model ORDER BY rmse, model LIMIT 1"""
    ),
)
def select_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest rmse among the scorers."""
    runs = ml.regression_metrics(_scored(spark, sf_dir), by=["model"])
    return store.select_best(runs.select("model", F.round("rmse", 6).alias("rmse")))


def _grid_sql() -> str:
    parts = []
    for name, (values, folds) in ml.GRIDS.items():
        points = ", ".join(f"('{_point(p)}')" for p in _points(values))
        parts.append(
            f"""SELECT '{name}' AS model, point, CAST(r.i AS INTEGER) AS fold,
              count(*) FILTER ({fold_sql(folds)} <> r.i) AS n_fitted, count(*) FILTER ({fold_sql(folds)} = r.i) AS n_held
            FROM frame CROSS JOIN range({folds}) r(i) CROSS JOIN (VALUES {points}) AS v(point)
            WHERE is_train GROUP BY point, r.i"""
        )
    return over_processed(FRAME_SQL + " UNION ALL ".join(parts))


@register("tune_grid", _grid_sql())
def tune_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of every search's grid, with the rows each fold fits it to and holds out."""
    _, train, _ = model_data(spark, sf_dir)
    models = ml.regressors()
    plans = []
    for name, (values, folds) in ml.GRIDS.items():
        grid = ml.param_grid(models[name], values)
        points = [(name, _point({p.name: v for p, v in point.items()})) for point in grid]
        listed = spark.createDataFrame(points, "model string, point string")
        sizes = ml.fold_sizes(train, folds).withColumn("model", F.lit(name))
        plans.append(listed.join(sizes, "model"))
    return reduce(DataFrame.unionByName, plans)


@register("tune_cv", _tree_search_sql("tree", {"maxDepth": [0, 1, 2]}, 2))
def tune_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-fold search over one tree parameter."""
    return _search(spark, sf_dir, "tree", {"maxDepth": [0, 1, 2]}, 2)


def _lake(spark: SparkSession) -> LakePaths:
    return LakePaths(scratch_path(spark, "lake"))


@register("sink_model", DEVIATIONS_SQL)
def sink_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a pipeline twice to one place; what the stored one has learnt."""
    frame, train, _ = model_data(spark, sf_dir)
    path = _lake(spark).gold(store.BEST_MODEL)
    model = _pipeline(frame, "linear").fit(train)
    store.save_model(model, path)
    store.save_model(model, path)
    return _deviations(spark, store.load_model(path))


@register("src_model", over_processed(f"{TREE_SQL} SELECT id, round(p, 6) AS prediction FROM scored"))
def src_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reloaded pipeline predicts, row by row."""
    _, train, test = model_data(spark, sf_dir)
    path = _lake(spark).gold(store.BEST_MODEL)
    store.save_model(ml.create_pipeline(ml.preparation(TWO), small("tree")).fit(train), path)
    return store.load_model(path).transform(test).select("id", F.round("prediction", 6).alias("prediction"))


# Two runs: least squares on all numeric features, a tree on two.
LOGGED = {"linear": ALL_NUMERIC, "tree": TWO}
LOGGED_SQL = f"""{LINEAR_SQL}, {rows_sql().removeprefix(FRAME_SQL).lstrip(", ")}, {CELLS_SQL}, {tree_sql("leaves", DEEP)},
scored AS (
  SELECT 'LinearRegressionModel' AS model, y, p FROM ({FULL_SCORED})
  UNION ALL SELECT 'DecisionTreeRegressionModel', y, p FROM held JOIN leaves USING (part, a, b))"""


@register(
    "run_log",
    over_processed(
        f"""{LOGGED_SQL}, errors AS (SELECT model, {errors_sql(SURE)} FROM scored GROUP BY model),
        metrics AS (UNPIVOT errors ON rmse, mae, mse, r2 INTO NAME key VALUE value)
        SELECT 'training' AS run_name, model, key, value FROM metrics"""
    ),
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs and the metrics that the log keeps of them."""
    _, train, test = model_data(spark, sf_dir)
    lake = _lake(spark)
    for name, features in LOGGED.items():
        pipeline = ml.create_pipeline(ml.preparation(features), small(name))
        fitted = ml.train_and_evaluate(name, pipeline, train, test)
        store.log_run(spark, lake, fitted, "training", keep_model=False)
    kept = store.read_runs(spark, lake).filter("kind = 'metric'")
    return kept.select("run_name", "model", "key", F.round(F.col("value").cast("double"), SURE).alias("value"))


@register(
    "model_publish",
    over_processed(
        f"""{LOGGED_SQL}
        SELECT name, version, model, round(sqrt(avg((y - p) ** 2)), {SURE}) AS rmse
        FROM scored JOIN (VALUES ('vote_predictor', 1, 'LinearRegressionModel'),
          ('vote_predictor', 2, 'DecisionTreeRegressionModel')) AS v(name, version, model) USING (model)
        GROUP BY name, version, model"""
    ),
)
def model_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions under one name, each loaded again and scored on the held-out rows."""
    _, train, test = model_data(spark, sf_dir)
    lake, rows = _lake(spark), []
    for name, features in LOGGED.items():
        model = ml.create_pipeline(ml.preparation(features), small(name)).fit(train)
        version = store.publish_model(spark, lake, model, "vote_predictor")
        loaded = store.load_published(spark, lake, "vote_predictor", version)
        rows.append((version, ml.regression_metrics(loaded.transform(test)).first()["rmse"]))
    scores = spark.createDataFrame(rows, "version int, rmse double")
    published = store.published_models(spark, lake, "vote_predictor").drop("path")
    return published.join(scores, "version").select(
        "name", "version", "model", F.round("rmse", SURE).alias("rmse")
    )


def _after_frame(folds: int = 0) -> str:
    return rows_sql(folds).removeprefix(FRAME_SQL).lstrip(", ")


DEPTHS = "VALUES ('1', 1, 1), ('2', 2, 1)"
# The candidates: a tree of depth 2, one of the depth that two folds prefer, least squares; all on two features.
BUILD_SQL = f"""{FRAME_SQL}, known AS (SELECT * FROM frame WHERE is_train), {solved_sql("weights", TWO, "known")},
chosen AS (
  WITH {_after_frame(2)}, {CELLS_SQL}, {tree_sql("leaves", DEPTHS)},
  errors AS (SELECT part, point, sqrt(avg((y - p) ** 2)) AS rmse FROM held JOIN leaves USING (part, a, b) GROUP BY ALL)
  SELECT point FROM errors GROUP BY point ORDER BY avg(rmse), point LIMIT 1),
{_after_frame()}, {CELLS_SQL}, {tree_sql("leaves", DEPTHS)},
candidates AS (
  SELECT 'DecisionTreeRegressionModel' AS model, sqrt(avg((y - p) ** 2)) AS rmse FROM held JOIN leaves USING (part, a, b)
  WHERE point = '2' OR point IN (SELECT point FROM chosen) GROUP BY point
  UNION ALL SELECT 'LinearRegressionModel', sqrt(avg((vote_average - ({linear(TWO)})) ** 2))
  FROM frame CROSS JOIN weights WHERE NOT is_train)"""


@register(
    "build_models",
    over_processed(
        f"""{BUILD_SQL} SELECT model, 1 AS version, round(rmse, 6) AS rmse FROM candidates
        ORDER BY round(rmse, 9), model LIMIT 1"""
    ),
)
def build_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composed job on small grids: fit, search, log, keep the best and register it."""
    _, train, test = model_data(spark, sf_dir)
    lake = _lake(spark)
    models = {name: small(name) for name in LOGGED}
    grids = {"tree": ({"maxDepth": [1, 2]}, 2)}
    ml.build_models(spark, lake, ml.preparation(TWO), train, test, models, grids)
    version = ml.register_best(spark, lake, "vote_predictor")
    loaded = store.load_published(spark, lake, "vote_predictor")
    rmse = ml.regression_metrics(loaded.transform(test)).select(F.round("rmse", 6).alias("rmse"))
    model = type(loaded.stages[-1]).__name__
    return rmse.select(F.lit(model).alias("model"), F.lit(version).alias("version"), "rmse")
