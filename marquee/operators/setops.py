"""Union, duplicate removal, distinct counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import stage

#: Places of copies that are broadcast at most: 24 bytes each, so 24 MB.
BROADCAST_PLACES = 1_000_000


def union_all(frames: Sequence[DataFrame], by: str = "name") -> DataFrame:
    """Bag union, matching columns ``by`` name or by position."""
    if by == "name":
        return reduce(DataFrame.unionByName, frames)
    if by == "position":
        return reduce(DataFrame.union, frames)
    raise ValueError(f"by must be 'name' or 'position', not {by!r}")


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop exact copies of whole rows, arrays included.

    Copies collapse in the map-side aggregate, so a row repeated any number
    of times reaches the shuffle once per task.
    """
    return df.dropDuplicates()


def dedup_stored(frames: Sequence[DataFrame], by: str = "name") -> DataFrame:
    """The different rows of the union of stored tables, by digests; wide rows stay where they are.

    Every row is read twice.  At first its digest (sha256 of its values) and its place (table, file,
    row of the file) are all that is shuffled, and give the places of copies.  Then the tables are
    read again without these.  Up to ``BROADCAST_PLACES`` copies, which are counted first, no row is
    moved at all; beyond that rows are joined with the copies' places, so each is moved once.

    Of equal rows the one of the first table stays.  -0.0 and 0.0 are equal at the top level.  Frames
    that are no scans of files (with filters and projections at most) have no places: they go through
    ``dedup_rows``.  So do frames with types that have no JSON form.
    """
    whole = union_all(frames, by)
    if not all(map(_has_places, frames)):
        return dedup_rows(whole)
    names = frames[0].columns
    typed = []
    for frame in frames:
        ordered = frame.columns if by == "position" else names
        typed.append(
            frame.select(
                *(F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(ordered, whole.schema.fields)),
                F.xxhash64("_metadata.file_path").alias("__file"),
                F.col("_metadata.row_index").alias("__row"),
            )
        )
    place = F.struct("table", "file", "row")
    placed = union_all(
        [
            frame.select(
                F.lit(i).alias("table"),
                F.col("__file").alias("file"),
                F.col("__row").alias("row"),
                _digest(whole.schema).alias("digest"),
            )
            for i, frame in enumerate(typed)
        ]
    )
    repeated = (
        placed.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    copies = stage(
        placed.join(repeated, "digest").filter(place != F.col("first")).select("table", "file", "row"), "copies"
    )
    few = copies.count() <= BROADCAST_PLACES
    kept = []
    for i, frame in enumerate(typed):
        own = copies.filter(F.col("table") == i).select(F.col("file").alias("__file"), F.col("row").alias("__row"))
        rest = frame.join(F.broadcast(own) if few else own, ["__file", "__row"], "left_anti")
        kept.append(rest.drop("__file", "__row"))
    return union_all(kept, "position")


def _has_places(df: DataFrame) -> bool:
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema
        df.select(_digest(df.schema)).schema
    except AnalysisException:
        return False
    return True


def _digest(schema: T.StructType) -> Column:
    """sha256 of a row's values in order; a fraction's two zeros are one."""
    fractions = (T.FloatType, T.DoubleType)
    values = (
        (F.col(f"`{f.name}`") + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, fractions) else F.col(f"`{f.name}`"))
        .alias(f"c{i}")
        for i, f in enumerate(schema.fields)
    )
    return F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)


def distinct_count(df: DataFrame, column: str, name: str = "n_distinct") -> DataFrame:
    """Number of different values, NULL counted as one."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(name))
