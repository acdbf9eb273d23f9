"""Places of rows in a sorted order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import stage


def spread_sorted(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` in ranges of ``order``, sorted, staged; ``part`` numbers the ranges in that order.

    Rows that are equal in ``order`` are told apart by their place in the scan, so that many equal
    ones are cut over several ranges too.  ``rows`` is read twice (Spark samples it for the ends
    of the ranges), so it should be a scan; a scan also makes that place the same when a task is
    run again.
    """
    keys = [*order, F.col("same")]
    return stage(
        rows.withColumn("same", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id()),
        name,
    )


def place_in_groups(rows: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Adds to every row ``tree`` (its group's number in order, null first), ``pos`` (its own place in
    the group) and ``size`` (rows of the group), all from 0.

    A group with most of all rows is cut over many tasks: a range counts its rows, the ranges'
    counts are summed, and a row's place is that sum and its place in its range.
    """
    first = F.col(group).asc_nulls_first()
    spread = spread_sorted(rows, [first, *order], name)
    counts = spread.groupBy("part", group).agg(F.count(F.lit(1)).alias("n"))
    # As many rows as there are ranges and groups.
    by_group = Window.partitionBy(group)
    counts = counts.select(
        "part",
        group,
        (F.sum("n").over(by_group.orderBy("part")) - F.col("n")).alias("before"),
        F.sum("n").over(by_group).alias("size"),
        F.min("part").over(by_group).alias("opened"),
    )
    counts = stage(counts, f"{name}-counts")
    # A group's number: groups opened by earlier ranges, and those before it in its own range.
    opening = counts.filter("part = opened").select(
        "part", group, F.row_number().over(Window.partitionBy("part").orderBy(first)).alias("nth")
    )
    opened = opening.groupBy("part").agg(F.count(F.lit(1)).alias("groups"))
    earlier = opened.select(
        F.col("part").alias("at"),
        # One row per range: the only window over all of something, and as long as there are ranges.
        (F.sum("groups").over(Window.orderBy("part")) - F.col("groups")).alias("earlier"),
    )
    numbered = opening.join(earlier, F.col("part") == F.col("at")).select(
        F.col(group).alias("g"), (F.col("earlier") + F.col("nth") - 1).cast("long").alias("tree")
    )
    counts = counts.join(numbered, F.col(group).eqNullSafe(F.col("g"))).select(
        F.col("part").alias("p"), "g", "before", "size", "tree"
    )
    in_range = Window.partitionBy("part", group).orderBy(*order, "same")
    return (
        spread.withColumn("nth", F.row_number().over(in_range))
        .join(counts, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
        .withColumn("pos", (F.col("before") + F.col("nth") - 1).cast("long"))
        .drop("same", "part", "nth", "p", "g", "before")
    )


def following(ids: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``next``: the following value of ``column`` in descending order (null last), after the last the first.

    ``ids`` has every value once.
    """
    order = [F.col(column).desc_nulls_last()]
    spread = spread_sorted(ids, order, name)
    in_range = Window.partitionBy("part").orderBy(*order)
    # A struct, so that a null value is still a value.
    value = F.struct(F.col(column).alias("v"))
    ahead = spread.withColumn("ahead", F.lead(value).over(in_range))
    # One row per range: what it begins with, and what the range after it does.
    over_ranges = Window.orderBy("part")
    # The greatest; a struct of null comes below all others.
    heads = spread.groupBy("part").agg(F.max(value).alias("head"))
    heads = heads.select(
        F.col("part").alias("p"),
        F.coalesce(
            F.lead("head").over(over_ranges),
            F.first("head").over(over_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("after"),
    )
    return (
        ahead.join(heads, F.col("part") == F.col("p"))
        .withColumn("next", F.coalesce("ahead", "after")["v"])
        .drop("same", "part", "p", "ahead", "after")
    )
