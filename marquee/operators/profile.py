"""Table profiles.  Each is one aggregate pass over the columns it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import quantiles as q


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column."""
    return df.select(*(_nulls(c).alias(c) for c in df.columns))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Name, type and number of known values of every column."""
    counts = df.agg(*(F.count(_named(c)).alias(f"n{i}") for i, c in enumerate(df.columns)))
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column.

    If all columns are integers the extremes are 64-bit integers and exact;
    beside a fractional column they are doubles, exact up to 2^53.
    """
    columns, kind = _numeric(df, columns)
    measures, rows = [], []
    for i, name in enumerate(columns):
        c, double = _named(name).cast(kind), _named(name).cast("double")
        stats = {
            "count": F.count(c),
            "mean": F.avg(double),
            "stddev": F.stddev_samp(double),
            "min": F.min(c),
            "max": F.max(c),
        }
        measures += [value.alias(f"{stat}_{i}") for stat, value in stats.items()]
        fields = [F.col(f"{stat}_{i}").alias(stat) for stat in stats]
        rows.append(F.struct(F.lit(name).alias("column"), *fields))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def summary(
    df: DataFrame, columns: Sequence[str] | None = None, accuracy: int | None = 10_000
) -> DataFrame:
    """``describe`` and the quartiles, to a rank error of 1 / ``accuracy``.

    One pass: every scan task sends one row with a sketch per column, and these
    are merged in two levels.  A table of up to 32,767 known values has exact
    quartiles at the default accuracy; the sketch's error is met with 99 %
    confidence above.  ``None`` gives exact quartiles at once, at the price of
    a second pass and, above 10^8 rows, one or two more (``quantiles.select_exact``).
    """
    columns, kind = _numeric(df, columns)
    partial: dict[str, Column] = {}
    final: dict[str, Column] = {}
    for i, name in enumerate(columns):
        c, double = _named(name).cast(kind), _named(name).cast("double")
        partial |= {
            f"count_{i}": F.count(c),
            f"sum_{i}": F.sum(double),
            f"spread_{i}": F.struct(F.count(double).alias("n"), F.avg(double).alias("mean"), F.var_pop(double).alias("var")),
            f"min_{i}": F.min(c),
            f"max_{i}": F.max(c),
        }
        final |= {
            f"count_{i}": F.coalesce(F.sum(f"count_{i}"), F.lit(0).cast("long")),
            f"mean_{i}": F.try_divide(F.sum(f"sum_{i}"), F.sum(f"count_{i}")),
            # One entry for each group of scan tasks.
            f"parts_{i}": F.collect_list(f"spread_{i}"),
            f"min_{i}": F.min(f"min_{i}"),
            f"max_{i}": F.max(f"max_{i}"),
        }
    if accuracy is None:
        exact, one = q.select_exact(df, columns, partial, final)
        quartiles = [[F.lit(v).cast(kind) for v in exact[name]] for name in columns]
    else:
        size = q.sketch_size(accuracy)
        sketches = [q.Sketched(f"s{i}", q.known(df, c), q.is_whole(df, c), size) for i, c in enumerate(columns)]
        for sketch in sketches:
            partial |= sketch.partial
            final |= sketch.final
        one = q.merged(df, partial, final)
        quartiles = [
            [F.get(s.at(q.QUARTILES), F.lit(j)).cast(kind) for j in range(len(q.QUARTILES))] for s in sketches
        ]
    rows = []
    for i, name in enumerate(columns):
        shares = [f"p{int(p * 100)}" for p in q.QUARTILES]
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                *(F.col(f"{stat}_{i}").alias(stat) for stat in ("count", "mean")),
                _deviation(F.col(f"parts_{i}"), F.col(f"mean_{i}"), F.col(f"count_{i}")).alias("stddev"),
                *(F.col(f"{stat}_{i}").alias(stat) for stat in ("min", "max")),
                *(v.alias(p) for v, p in zip(quartiles[i], shares)),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def rank_errors(df: DataFrame, summarised: DataFrame) -> DataFrame:
    """By how much the quartiles of ``summary`` miss their ranks: ``column, quartile, known, error``.

    ``error`` is a share of the known values, 0 where the quartile is exact; one pass over ``df``.
    NaN is greater than all other values here, as in any comparison.
    """
    measures, rows = [], []
    for i, r in enumerate(summarised.collect()):  # one row per column
        c = _named(r["column"])
        measures.append(F.count(c).alias(f"n{i}"))
        for p in q.QUARTILES:
            name = f"p{int(p * 100)}"
            value = F.lit(r[name])
            measures += [F.count_if(c < value).alias(f"{name}_below{i}"), F.count_if(c <= value).alias(f"{name}_upto{i}")]
            n = F.col(f"n{i}")
            misses = F.try_divide(F.col(f"{name}_below{i}"), n) - p, p - F.try_divide(F.col(f"{name}_upto{i}"), n)
            error = F.greatest(F.lit(0.0), *misses).alias("error")
            rows.append(
                F.struct(F.lit(r["column"]).alias("column"), F.lit(name).alias("quartile"), n.alias("known"), error)
            )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def _deviation(parts: Column, mean: Column, n: Column) -> Column:
    """The sample deviation of parts of which each has its number, mean and variance."""
    squares = F.aggregate(
        parts,
        F.lit(0.0),
        lambda total, p: F.when(p["n"] == 0, total).otherwise(
            total + p["n"] * (p["var"] + (p["mean"] - mean) * (p["mean"] - mean))
        ),
    )
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def correlation(
    df: DataFrame, left: str, right: str, nulls: str = "zero", name: str = "corr"
) -> DataFrame:
    """Pearson correlation of two columns, one row; see ``pearson``."""
    return df.agg(pearson(left, right, nulls).alias(name))


def pearson(left: str, right: str, nulls: str = "zero") -> Column:
    """Pearson correlation of two columns as an aggregate.

    ``nulls="zero"`` counts a NULL as 0, as ``DataFrame.stat.corr`` does;
    ``"skip"`` leaves out rows with a NULL on either side.  A constant column
    gives NULL.
    """
    a, b = F.col(left).cast("double"), F.col(right).cast("double")
    if nulls == "zero":
        a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
    elif nulls == "skip":
        a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    else:
        raise ValueError(f"nulls must be 'zero' or 'skip', not {nulls!r}")
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), spread)


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> tuple[list[str], str]:
    """The columns, and the type of their extremes.

    Integers alone keep their type; beside fractions all are doubles.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return list(columns), "long" if all(q.is_whole(df, c) for c in columns) else "double"


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def _nulls(name: str) -> Column:
    return F.count(F.when(_named(name).isNull(), F.lit(1)))
