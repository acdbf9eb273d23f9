"""Bronze feeds to one silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.lake import LakePaths
from marquee.operators.setops import dedup_rows, dedup_stored, union_all
from marquee.plans.ingest import FEED_TABLES
from marquee.schemas import MOVIE
from marquee.sources.tables import read_table, write_table

CONSTANT_COLUMNS = ("adult", "video")
SILVER_ALL = "all_movies"


def combine_feeds(
    feeds: Sequence[DataFrame],
    drop: Sequence[str] = CONSTANT_COLUMNS,
    by: str = "name",
    in_place: bool = False,
) -> DataFrame:
    """Union the feeds, drop copies of whole rows, drop constant columns.

    Only exact copies go: an id whose popularity changed between two feeds
    keeps both rows.  With ``in_place`` the feeds are stored tables whose copies
    are found by digests, without shuffling their texts (``dedup_stored``).
    """
    different = dedup_stored(feeds, by) if in_place else dedup_rows(union_all(feeds, by))
    return different.drop(*drop)


def build_all_movies(
    spark: SparkSession,
    lake: LakePaths,
    tables: Sequence[str] = FEED_TABLES,
    record: T.StructType = MOVIE,
) -> None:
    feeds = [read_table(spark, lake.bronze(t), record) for t in tables]
    write_table(combine_feeds(feeds), lake.silver(SILVER_ALL))
