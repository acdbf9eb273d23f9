"""Searches over factorization machines whose steps see all rows at once.

The prediction is linear in ``phi``: 1, the features and their products two by
two.  Squared error and its gradient therefore need only the sums of
``phi phi'`` and ``phi y``, which one pass over the rows gives; all points of a
grid take their steps on these sums.  The steps are those of the library's
regressor, up to the rounding of sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import nan
from typing import Any

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import FMRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Beyond this many features the sums of products (their fourth power) are not worth a pass.
MAX_FEATURES = 32


def full_batch(regressor: Estimator, grid: Sequence[Mapping[Any, Any]]) -> bool:
    """Whether every point of the grid is a machine whose every step uses all rows."""
    if not isinstance(regressor, FMRegressor):
        return False
    points = [_settings(regressor, point) for point in grid]
    return all(p["solver"] in ("gd", "adamW") and p["miniBatchFraction"] == 1.0 for p in points)


def width(rows: DataFrame, features: str) -> int | None:
    """The number of features; None without rows."""
    first = rows.select(F.size(vector_to_array(features)).alias("n")).first()
    return None if first is None else first["n"]


def search(
    fit_rows: DataFrame, held_rows: DataFrame, regressor: Estimator, grid: Sequence[Mapping[Any, Any]], size: int
) -> list[float]:
    """The rmse on ``held_rows`` of each point, fitted to ``fit_rows``: one pass over either.

    As in the library, a label to be learnt from that is NULL or not finite, or such a feature,
    is an error; held rows without a label are left out.
    """
    label, features = regressor.getOrDefault("labelCol"), regressor.getOrDefault("featuresCol")
    phis = 1 + size + size * (size - 1) // 2
    pairs = np.triu_indices(size, 1)

    def sums(batches: Iterator) -> Iterator:
        total = np.zeros((phis + 1, phis))
        for x, y in _arrays(batches, size):
            if not (np.isfinite(y).all() and np.isfinite(x).all()):
                raise ValueError("labels and features to be learnt from may not be NULL, NaN or infinite")
            phi = _phi(x, pairs)
            total[:phis] += phi.T @ phi
            total[phis] += y @ phi
        yield _row(total)

    found = _summed(fit_rows, label, features, sums, (phis + 1) * phis).reshape(phis + 1, phis)
    moments, with_y, n = found[:phis], found[phis], found[0, 0]
    spark = fit_rows.sparkSession
    weights = np.stack(
        [_steps(spark, _settings(regressor, point), moments / n, with_y / n, size, pairs) for point in grid], axis=1
    )

    def errors(batches: Iterator) -> Iterator:
        total = np.zeros(len(grid) + 1)
        with np.errstate(over="ignore", invalid="ignore"):
            for x, y in _arrays(batches, size):
                known = ~np.isnan(y)
                off = y[known, None] - _phi(x[known], pairs) @ weights
                total[:-1] += (off * off).sum(axis=0)
                total[-1] += known.sum()
        yield _row(total)

    *squares, held = _summed(held_rows, label, features, errors, len(grid) + 1)
    return [float(np.sqrt(s / held)) if held else nan for s in squares]


def _settings(regressor: Estimator, point: Mapping[Any, Any]) -> dict[str, Any]:
    return {p.name: v for p, v in regressor.extractParamMap(dict(point)).items()}


def _arrays(batches: Iterator, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of each batch; a NULL label is NaN."""
    for batch in batches:
        if batch.num_rows:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            if batch.column(1).null_count:
                raise ValueError("a row has no features")
            yield batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size), y


def _phi(x: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.hstack([np.ones((len(x), 1)), x, x[:, pairs[0]] * x[:, pairs[1]]])


def _row(total: np.ndarray):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["v"])


def _summed(rows: DataFrame, label: str, features: str, work, size: int) -> np.ndarray:
    """The tasks' arrays added up, entry by entry."""
    plain = rows.select(F.col(label).cast("double"), vector_to_array(features))
    added = plain.mapInArrow(work, "v array<double>").select(F.posexplode("v").alias("i", "v"))
    entries = F.sort_array(F.collect_list(F.struct("i", "v")))
    out = np.zeros(size)
    for i, v in added.groupBy("i").agg(F.sum("v").alias("v")).agg(entries.alias("all")).first()["all"]:
        out[i] = v
    return out


def _steps(
    spark: SparkSession, p: Mapping[str, Any], moments: np.ndarray, with_y: np.ndarray, size: int,
    pairs: tuple[np.ndarray, np.ndarray],
) -> np.ndarray:
    """The weights of ``phi`` after gradient steps from the regressor's random start."""
    rng, factors = spark._jvm.java.util.Random(p["seed"]), p["factorSize"]
    v = np.array([rng.nextGaussian() for _ in range(size * factors)]).reshape(size, factors) * p["initStd"]
    linear, intercept = np.zeros(size), np.zeros(1)
    start = np.concatenate([v.ravel(), linear, intercept])
    # The running means of AdamW.
    mean, square, left, left2 = np.zeros(start.size), np.zeros(start.size), 1.0, 1.0

    def parts(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return flat[: size * factors].reshape(size, factors), flat[size * factors : -1], flat[-1:]

    def weights(flat: np.ndarray) -> np.ndarray:
        v, linear, intercept = parts(flat)
        return np.concatenate([intercept, linear, (v @ v.T)[pairs]])

    after = start
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(1, p["maxIter"] + 1):
            before = after
            slope = 2 * (moments @ weights(before) - with_y)
            cross = np.zeros((size, size))
            cross[pairs] = slope[1 + size :]
            v = parts(before)[0]
            grad = np.concatenate([((cross + cross.T) @ v).ravel(), slope[1 : 1 + size], slope[:1]])
            moved = np.ones(start.size, bool)
            moved[size * factors : -1] = p["fitLinear"]
            moved[-1] = p["fitIntercept"]
            if p["solver"] == "adamW":
                mean = 0.9 * mean + (1 - 0.9) * grad
                square = 0.999 * square + (1 - 0.999) * (grad * grad)
                left, left2 = left * 0.9, left2 * 0.999
                step = p["stepSize"] * (mean / (1 - left)) / (np.sqrt(square / (1 - left2)) + 1e-8)
                step += p["regParam"] * before
            else:
                rate = p["stepSize"] / np.sqrt(i)
                step = rate * p["regParam"] * before + rate * grad
            after = np.where(moved, before - step, before)
            if i > 1 and np.linalg.norm(before - after) < p["tol"] * max(np.linalg.norm(after), 1.0):
                break
        return weights(after)
