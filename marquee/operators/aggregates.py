"""Row counts, grouped aggregates, ordering and top-k.

Everything is a declarative aggregate, so Spark combines map-side first: a
key that holds a third of the rows crosses the shuffle once per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGGREGATES = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def global_max(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.agg(F.max(column).alias(name or f"max_{column}"))


def null_count(df: DataFrame, column: str, name: str = "n_null") -> DataFrame:
    """Rows in which ``column`` is NULL."""
    return df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias(name))


def order_rows(df: DataFrame, column: str, ties: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """Sort by ``column``, then by ``ties``; NULLs first up, last down."""
    return df.orderBy(*_sort_keys(column, ties, ascending))


def top_rows(
    df: DataFrame, column: str, n: int, ties: Sequence[str] = (), ascending: bool = False
) -> DataFrame:
    """The first ``n`` rows of that order, taken per task before they meet."""
    return order_rows(df, column, ties, ascending).limit(n)


def preview_rows(df: DataFrame, n: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows; any, or the first in the order of ``by``."""
    return (df.orderBy(*by) if by else df).limit(n)


def group_count(
    df: DataFrame,
    key: str,
    n: int | None = None,
    name: str = "count",
    ascending: bool = False,
) -> DataFrame:
    """Rows per key (NULL is a key), most frequent first."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return _ranked(counted, name, key, n, ascending)


def group_agg(
    df: DataFrame,
    key: str,
    measures: Mapping[str, tuple[str, str]],
    digits: int | None = None,
    sort_by: str | None = None,
    ascending: bool = False,
    n: int | None = None,
) -> DataFrame:
    """``measures`` maps output name to (aggregate, column).

    ``digits`` rounds every average; ``sort_by`` and ``n`` give a ranking.
    """
    columns = [_measure(name, fn, c, digits) for name, (fn, c) in measures.items()]
    grouped = df.groupBy(key).agg(*columns)
    if sort_by is None:
        if n is not None:
            raise ValueError("n needs sort_by")
        return grouped
    return _ranked(grouped, sort_by, key, n, ascending)


def _measure(name: str, fn: str, column: str, digits: int | None) -> Column:
    value = _AGGREGATES[fn](F.col(column))
    if fn == "avg" and digits is not None:
        value = F.round(value, digits)
    return value.alias(name)


def _sort_keys(column: str, ties: Sequence[str], ascending: bool) -> list[Column]:
    c = F.col(column)
    first = c.asc_nulls_first() if ascending else c.desc_nulls_last()
    return [first, *(F.col(t).asc_nulls_last() for t in ties)]


def _ranked(df: DataFrame, column: str, key: str, n: int | None, ascending: bool) -> DataFrame:
    ordered = order_rows(df, column, [key], ascending)
    return ordered if n is None else ordered.limit(n)
