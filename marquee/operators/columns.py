"""Projections, renames, fills, filters and normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in one projection; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def fill_sentinel(df: DataFrame, columns: Sequence[str], sentinel: str) -> DataFrame:
    """NULLs of the named string columns become ``sentinel``."""
    return df.fillna({c: sentinel for c in columns})


def filter_all(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition."""
    return df.filter(reduce(and_, conditions))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any named column."""
    return df.dropna(how="any", subset=list(columns))


def constant_columns(df: DataFrame) -> list[str]:
    """Columns that hold one value in every row, NULL being a value.

    One aggregate pass; maps have no order and are never reported.
    """
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    checks = []
    for i, name in enumerate(names):
        c = F.col(f"`{name}`")
        known = F.count(c)
        checks.append(
            ((known == 0) | ((known == F.count(F.lit(1))) & (F.min(c) == F.max(c)))).alias(f"c{i}")
        )
    row = df.agg(*checks).first()
    return [name for i, name in enumerate(names) if row[f"c{i}"]]


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def max_normalize(df: DataFrame, column: str, out: str, digits: int = 3) -> DataFrame:
    """Add ``out`` = column / its maximum over the frame, rounded.

    The maximum is an uncorrelated scalar subquery: partial maxima on the
    executors, one value into the row pass, no join and no driver round trip.
    It reads ``df`` a second time (that column only), so give it a stored
    table.  A maximum of zero or NULL gives NULL.
    """
    peak = df.agg(F.max(column)).scalar()
    return df.withColumn(out, F.round(F.try_divide(F.col(column), peak), digits))
