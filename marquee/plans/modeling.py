"""Silver table to regression models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from math import fsum, inf, isnan, nan
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    FMRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from marquee.functions import bool_to_int, hash_bucket
from marquee.lake import LakePaths
from marquee.operators.columns import drop_null_rows
from marquee.operators.encode import topk_onehot
from marquee.operators.profile import null_profile
from marquee.plans import machines
from marquee.sources import models as store

LABEL = "vote_average"
CATEGORY = "rating_category"
CATEGORY_INDEX = "rating_category_index"
SCALED = "scaled_features"
# Encoded columns, columns that may not be NULL, numeric features.
ENCODED = ("genre_names", "original_language")
REQUIRED = ("release_year", "release_month", "release_day", "movie_age")
NUMERIC_FEATURES = (
    "vote_count",
    "release_year",
    "release_month",
    "release_day",
    CATEGORY_INDEX,
    "normalized_popularity",
    "overview_length",
    "is_remake",
    "movie_age",
)
SEED = 42


@dataclass(frozen=True)
class ModelFrame:
    """Rows ready for a pipeline, and the columns that encode categories."""

    rows: DataFrame
    encoded: list[str]

    def features(self, leak_free: bool = False) -> list[str]:
        """Input columns of the assembler.

        ``rating_category`` is a bucket of the label.  The full list keeps its
        index, and scores with it are flattered; ``leak_free`` leaves it out.
        """
        numeric = [c for c in NUMERIC_FEATURES if not (leak_free and c == CATEGORY_INDEX)]
        return numeric + self.encoded


def build_model_frame(
    processed: DataFrame,
    k: int = 5,
    prefixes: Mapping[str, str] | None = None,
) -> ModelFrame:
    """Integer flag, one-hot columns of the frequent categories, known dates.

    ``processed`` is read once per encoded column to rank its values, so it
    should be a stored table.
    """
    prefixes = prefixes or {}
    rows = processed.withColumn("is_remake", bool_to_int("is_remake").cast("int"))
    encoded: list[str] = []
    for column in ENCODED:
        rows, names = topk_onehot(rows, column, k, prefixes.get(column, ""))
        encoded += names
    return ModelFrame(drop_null_rows(rows, REQUIRED), encoded)


def feature_nulls(frame: ModelFrame, leak_free: bool = False) -> DataFrame:
    """NULLs per input column: the assembler fails on any by default."""
    inputs = [c for c in frame.features(leak_free) if c != CATEGORY_INDEX]
    return null_profile(frame.rows.select(*inputs))


def preparation(
    features: Sequence[str], handle_invalid: str = "error"
) -> list[StringIndexer | VectorAssembler | StandardScaler]:
    """Index the bucket (only where it is a feature), assemble, scale."""
    stages: list[Any] = []
    if CATEGORY_INDEX in features:
        stages.append(
            StringIndexer(inputCol=CATEGORY, outputCol=CATEGORY_INDEX, handleInvalid="keep")
        )
    stages.append(
        VectorAssembler(
            inputCols=list(features), outputCol="features", handleInvalid=handle_invalid
        )
    )
    stages.append(StandardScaler(inputCol="features", outputCol=SCALED))
    return stages


def create_pipeline(stages: Sequence[Any], regressor: Estimator) -> Pipeline:
    return Pipeline(stages=[*stages, regressor])


def regressors(seed: int = SEED, label: str = LABEL) -> dict[str, Estimator]:
    """The five regressors with default parameters and a fixed seed."""
    common = {"featuresCol": SCALED, "labelCol": label}
    return {
        "linear": LinearRegression(**common),
        "tree": DecisionTreeRegressor(seed=seed, **common),
        "gbt": GBTRegressor(seed=seed, **common),
        "forest": RandomForestRegressor(seed=seed, **common),
        "fm": FMRegressor(seed=seed, **common),
    }


def regression_metrics(
    predictions: DataFrame,
    label: str = LABEL,
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """rmse, mae, mse and r2 in one pass: one row, or one for each value of ``by``."""
    return predictions.groupBy(*by).agg(*_errors(label, prediction))


def _errors(label: str, prediction: str) -> list[Column]:
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    squares = F.sum(error * error)
    n = F.count(error)
    return [
        F.sqrt(F.try_divide(squares, n)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.try_divide(squares, n).alias("mse"),
        (1 - F.try_divide(squares, n * F.var_pop(F.when(error.isNotNull(), y)))).alias("r2"),
    ]


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline and its scores on held-out rows."""

    name: str
    model: PipelineModel
    metrics: dict[str, float]
    search: list[tuple[dict[str, Any], float]] = field(default_factory=list)


def train_and_evaluate(
    name: str, pipeline: Pipeline, train: DataFrame, test: DataFrame, label: str = LABEL
) -> Fitted:
    model = pipeline.fit(train)
    return Fitted(name, model, _metrics(model.transform(test), label))


# The grids and fold counts of the five searches.
GRIDS: dict[str, tuple[dict[str, list[Any]], int]] = {
    "fm": ({"stepSize": [0.001, 0.01, 0.1], "factorSize": [4, 8, 12]}, 3),
    "linear": ({"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]}, 3),
    "tree": ({"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4]}, 3),
    "forest": ({"numTrees": [5, 10]}, 2),
    "gbt": ({"stepSize": [0.001, 0.01, 0.1]}, 2),
}


def param_grid(regressor: Estimator, values: Mapping[str, Sequence[Any]]) -> list[dict[Param, Any]]:
    """The Cartesian product of the values."""
    builder = ParamGridBuilder()
    for param, candidates in values.items():
        builder = builder.addGrid(regressor.getParam(param), list(candidates))
    return builder.build()


def tune(
    name: str,
    stages: Sequence[Any],
    regressor: Estimator,
    grid: Sequence[dict[Param, Any]],
    train: DataFrame,
    test: DataFrame,
    folds: int = 3,
    key: str = "id",
    label: str = LABEL,
    parallelism: int = 8,
) -> Fitted:
    """k-fold search for the lowest mean rmse, refit on all training rows.

    Folds come from the key's hash, so a rerun on other partitions draws the
    same ones.  The preparation stages do not depend on the grid: they are
    fitted once per fold and the grid shares the prepared rows.  Folds and
    points are fitted side by side, ``parallelism`` at a time; the prepared rows
    of all folds are kept, on disk where memory is short.  Factorization machines
    whose steps see all rows take them on sums of products, for all points of a
    fold at once (``machines``): their rows are read once and not kept.
    """
    foreign = {p.name for point in grid for p in point if p.parent != regressor.uid}
    if foreign:
        raise ValueError(f"the grid may only hold the regressor's parameters, not {sorted(foreign)}")
    fold = hash_bucket(key, folds, salt="fold:")
    columns = [label, regressor.getOrDefault("featuresCol")]
    spark = train.sparkSession
    summed = machines.full_batch(regressor, grid)

    def prepare(i: int) -> tuple[DataFrame, DataFrame]:
        fit_rows, held_rows = train.filter(fold != i), train.filter(fold == i)
        prepared = Pipeline(stages=list(stages)).fit(fit_rows)
        parts = (prepared.transform(rows).select(*columns) for rows in (fit_rows, held_rows))
        return tuple(parts if summed else (part.persist(_SPILLING) for part in parts))

    def fit(job: tuple[int, dict[Param, Any]]) -> Model:
        return regressor.copy(job[1]).fit(parts[job[0]][0])

    def score(fold_models: tuple[int, list[Model]]) -> list[float]:
        """The rmse of all models of a fold, in one pass over its held rows."""
        i, models = fold_models
        scored, columns = parts[i][1], [f"__p{j}" for j in range(len(models))]
        for column, model in zip(columns, models):
            scored = model.setPredictionCol(column).transform(scored)
        rmse = _metrics(scored, label, columns)["rmse"]
        return rmse if len(models) > 1 else [rmse]

    def at_once(i: int) -> list[float]:
        fit_part, held_part = parts[i]
        size = machines.width(fit_part, columns[1])
        if size is None or size > machines.MAX_FEATURES:
            return score((i, [fit((i, point)) for point in grid]))
        return machines.search(fit_part, held_part, regressor, grid, size)

    parts = _in_threads(spark, prepare, range(folds), parallelism)
    try:
        if summed:
            per_fold = _in_threads(spark, at_once, range(folds), parallelism)
        else:
            # All folds side by side: one that waits for its last trees leaves no executor idle.
            models = _in_threads(spark, fit, [(i, point) for i in range(folds) for point in grid], parallelism)
            of_folds = [(i, models[i * len(grid) : (i + 1) * len(grid)]) for i in range(folds)]
            per_fold = _in_threads(spark, score, of_folds, parallelism)
    finally:
        for part in (p for pair in parts for p in pair if not summed):
            part.unpersist()
    means = [fsum(scores) / folds for scores in zip(*per_fold)]
    if all(map(isnan, means)):
        raise ArithmeticError(f"no point of the {name} grid has an rmse in every fold")
    # A point that diverged has no rmse and comes last.
    best = min(range(len(grid)), key=lambda i: inf if isnan(means[i]) else means[i])
    fitted = train_and_evaluate(
        name, create_pipeline(stages, regressor.copy(grid[best])), train, test, label
    )
    search = [({p.name: v for p, v in point.items()}, mean) for point, mean in zip(grid, means)]
    return Fitted(name, fitted.model, fitted.metrics, search)


def fold_sizes(train: DataFrame, folds: int, key: str = "id") -> DataFrame:
    """``fold, n_fitted, n_held`` of a search over ``train``: one aggregate."""
    fold = hash_bucket(key, folds, salt="fold:")
    held = [F.count_if(fold == i).alias(f"n{i}") for i in range(folds)]
    total = F.count(F.lit(1)).alias("total")
    rows = [
        F.struct(
            F.lit(i).alias("fold"),
            (F.col("total") - F.col(f"n{i}")).alias("n_fitted"),
            F.col(f"n{i}").alias("n_held"),
        )
        for i in range(folds)
    ]
    return train.agg(total, *held).select(F.inline(F.array(*rows)))


def build_models(
    spark: SparkSession,
    lake: LakePaths,
    stages: Sequence[Any],
    train: DataFrame,
    test: DataFrame,
    models: Mapping[str, Estimator] | None = None,
    grids: Mapping[str, tuple[Mapping[str, Sequence[Any]], int]] | None = None,
) -> str:
    """Silver to gold: fit every model, search every grid, log each run, keep the best pipeline.

    Returns the id of the run of this job with the lowest rmse (earlier jobs in the log may have had
    other features); among equal ones a searched run's model comes
    first by name.  Its pipeline is stored as the best model.
    """
    models = regressors() if models is None else models
    grids = GRIDS if grids is None else grids
    own: list[str] = []
    for name, regressor in models.items():
        fitted = train_and_evaluate(name, create_pipeline(stages, regressor), train, test)
        own.append(store.log_run(spark, lake, fitted, "training"))
    for name, (values, folds) in grids.items():
        grid = param_grid(models[name], values)
        found = tune(name, stages, models[name], grid, train, test, folds)
        own.append(store.log_run(spark, lake, found, "cross_validation"))
    metrics = store.run_metrics(store.read_runs(spark, lake)).filter(F.col("run_id").isin(own))
    # The last digits of sums depend on the order of rows; runs that differ only there tie.
    best = store.select_best(metrics.withColumn("rmse", F.round("rmse", 9))).first()
    model = store.load_model(store.run_model_path(lake, best["run_id"]))
    store.save_model(model, lake.gold(store.BEST_MODEL))
    return best["run_id"]


def register_best(spark: SparkSession, lake: LakePaths, name: str) -> int:
    """Publish the stored best pipeline under ``name``; returns the version."""
    return store.publish_model(spark, lake, store.load_model(lake.gold(store.BEST_MODEL)), name)


_SPILLING = StorageLevel.MEMORY_AND_DISK


def _metrics(
    predictions: DataFrame, label: str, columns: Sequence[str] = ("prediction",)
) -> dict[str, Any]:
    """The metrics; of several columns of predictions, lists of them, in one pass."""
    found = predictions.agg(*(F.struct(*_errors(label, c)).alias(c) for c in columns)).first()
    scores = [{k: nan if v is None else v for k, v in row.asDict().items()} for row in found]
    return scores[0] if len(scores) == 1 else {k: [s[k] for s in scores] for k in scores[0]}


def _in_threads(
    spark: SparkSession, job: Callable[[Any], Any], items: Sequence[Any], parallelism: int
) -> list[Any]:
    """Submit Spark jobs side by side, as the library's own CV does."""
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(job), items)
