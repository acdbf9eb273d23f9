"""Category encoding and the train/test split."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import hash_bucket, not_in_flag
from marquee.operators.aggregates import group_count


def topk_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of a column, ranked from 1.

    NULL is ranked like any value and then left out, so fewer than ``k`` rows
    may come back.
    """
    top = group_count(df, column, n=k, name="n")
    # The window sees the k rows of the limit, not the table.
    order = Window.orderBy(F.col("n").desc(), F.col(column).asc_nulls_last())
    return (
        top.withColumn("rank", F.row_number().over(order))
        .filter(F.col(column).isNotNull())
        .select("rank", column, "n")
    )


def topk_categories(df: DataFrame, column: str, k: int = 5) -> list[Any]:
    """Those values in rank order; only ``k`` values reach the driver."""
    rows = group_count(df, column, n=k, name="n").collect()
    return [r[column] for r in rows if r[column] is not None]


def topk_onehot(
    df: DataFrame,
    column: str,
    k: int = 5,
    prefix: str = "",
    categories: Sequence[Any] | None = None,
) -> tuple[DataFrame, list[str]]:
    """A 0/1 column per frequent value and ``other_<column>`` for the rest.

    Returns the frame and the names added.  A NULL value is 0 in all of them.
    Dots and backticks of a value become underscores in its column's name, and
    names that meet raise; the value itself is in the column's metadata.
    ``categories`` fixes the values, for instance to encode new rows like the
    ones a model was trained on.
    """
    if categories is None:
        categories = topk_categories(df, column, k)
    # A dot would make the name a path into a struct for every later stage.
    names = [re.sub("[.`]", "_", f"{prefix}{c}") for c in categories]
    added = [*names, f"other_{column}"]
    taken = {c.lower() for c in df.columns}
    for name in added:
        if name.lower() in taken:
            raise ValueError(f"column {name!r} exists already; pass another prefix")
        taken.add(name.lower())
    flags = [
        F.when(F.col(column) == F.lit(c), F.lit(1))
        .otherwise(F.lit(0))
        .alias(name, metadata={"category": str(c)})
        for c, name in zip(categories, names)
    ]
    other = not_in_flag(column, categories).alias(f"other_{column}")
    return df.select("*", *flags, other), added


def with_split(
    df: DataFrame, key: str = "id", train_percent: int = 70, out: str = "is_train"
) -> DataFrame:
    """Mark training rows by the key's hash: stable on any partitioning."""
    return df.withColumn(out, hash_bucket(key, 100) < train_percent)


def split_train_test(
    df: DataFrame,
    key: str | None = "id",
    train_percent: int = 70,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, disjoint and complete.

    With ``key=None`` rows are drawn by ``randomSplit``, whose parts change
    with the partitioning.
    """
    if key is None:
        train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
        return train, test
    marked = with_split(df, key, train_percent, "__train")
    return (
        marked.filter(F.col("__train")).drop("__train"),
        marked.filter(~F.col("__train")).drop("__train"),
    )


def split_counts(df: DataFrame, key: str = "id", train_percent: int = 70) -> DataFrame:
    """Rows of both parts, in one pass."""
    return (
        with_split(df, key, train_percent)
        .groupBy("is_train")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
