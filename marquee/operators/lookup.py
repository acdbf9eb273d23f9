"""Names for arrays of dimension ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension within both limits travels with the plan as one map value.
MAP_ROWS = 512
MAP_BYTES = 1 << 20


def fits_in_map(dim: DataFrame, key: str, name: str) -> bool:
    """Whether the dimension is small enough to ride in every task.

    Reads at most ``MAP_ROWS + 1`` rows of it.
    """
    seen = (
        dim.select(key, name)
        .limit(MAP_ROWS + 1)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.octet_length(name)), F.lit(0)).alias("size"),
        )
        .first()
    )
    return seen["n"] <= MAP_ROWS and seen["size"] <= MAP_BYTES


def lookup_array_dim(
    df: DataFrame,
    ids: str,
    dim: DataFrame,
    key: str = "id",
    name: str = "name",
    out: str = "names",
    how: str = "auto",
) -> DataFrame:
    """Add ``out``: the name of every id in the array, in order, misses NULL.

    ``how="map"`` looks ids up in one map value and moves no fact row, and
    raises where the dimension is too large for that; ``how="join"`` works for
    a dimension of any size; ``"auto"`` checks the size first.  A NULL array
    stays NULL.  Of several names for one id the greatest is taken.
    """
    if how in ("auto", "map"):
        fits = fits_in_map(dim, key, name)
        if how == "map" and not fits:
            raise ValueError(f"the dimension has over {MAP_ROWS} rows or {MAP_BYTES} bytes of names")
        how = "map" if fits else "join"
    unique = (
        dim.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("k"))
        .agg(F.max(name).alias("v"))
    )
    if how == "map":
        return _by_map(df, ids, unique, out)
    if how == "join":
        return _by_join(df, ids, unique, out)
    raise ValueError(f"how must be 'auto', 'map' or 'join', not {how!r}")


def _by_map(df: DataFrame, ids: str, unique: DataFrame, out: str) -> DataFrame:
    names = unique.agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))).scalar()
    return (
        df.withColumn("__names", names)
        .withColumn(out, F.transform(ids, lambda i: F.try_element_at(F.col("__names"), i)))
        .drop("__names")
    )


def _by_join(df: DataFrame, ids: str, unique: DataFrame, out: str) -> DataFrame:
    """Resolve every different array once, then join the answers back.

    Collapsing the arrays first means a frequent array or id is resolved
    once, not per row; each task does so for its rows before the shuffle.
    Nothing is copied: rows that share one array in the join back, like
    arrays that share one id, are plain equi-joins with a unique side, whose
    large partitions the adaptive skew join splits.
    """
    arrays = df.select(F.col(ids).alias("a")).filter(F.size("a") > 0).distinct()
    resolved = (
        arrays.select("a", F.posexplode("a").alias("pos", "k"))
        .join(unique, "k", "left")
        .groupBy("a")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("found"))
        .select("a", F.transform("found", lambda x: x["v"]).alias("__names"))
    )
    matched = df.join(resolved, df[f"`{ids}`"] == resolved["a"], "left")
    empty = F.array().cast(T.ArrayType(unique.schema["v"].dataType))
    return matched.select(
        *(df[f"`{c}`"] for c in df.columns),
        F.when(F.size(df[f"`{ids}`"]) == 0, empty).otherwise(F.col("__names")).alias(out),
    )
