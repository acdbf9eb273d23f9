"""Landed pages to bronze tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.lake import LakePaths
from marquee.operators.columns import fill_sentinel
from marquee.schemas import MOVIE, page_schema
from marquee.sources.pages import movies_of, read_genres, read_pages, within_cap
from marquee.sources.tables import write_table

# Image columns and what stands for a missing image.
IMAGE_COLUMNS = ("backdrop_path", "poster_path")
DEFAULT_SENTINEL = "/no_image.jpg"
BARE_SENTINEL = "no_image"


@dataclass(frozen=True)
class Feed:
    """A movie list: its bronze table and what stands for a missing image."""

    table: str
    sentinel: str = DEFAULT_SENTINEL
    max_pages: int | None = None


# The four bronze tables.
FEED_TABLES = ("popular_movies", "top_rated_movies", "upcoming_movies", "present_movies")
GENRE_TABLE = "movie_genres"

FEEDS = tuple(Feed(t) for t in FEED_TABLES)

# As the feeds were stored before one sentinel was agreed on.
PARITY_FEEDS = tuple(
    Feed(t, DEFAULT_SENTINEL if t == "top_rated_movies" else BARE_SENTINEL) for t in FEED_TABLES
)


def typed_feed(
    spark: SparkSession,
    landing: str,
    feed: Feed,
    record: T.StructType = MOVIE,
    page_per_file: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The feed's bronze rows and the pages that could not be read."""
    pages = read_pages(spark, landing, page_schema(record), page_per_file, parse_once=True)
    rows = movies_of(pages.good.filter(within_cap(feed.max_pages)))
    return fill_sentinel(rows, IMAGE_COLUMNS, feed.sentinel), pages.bad


def ingest_feed(
    spark: SparkSession,
    landing: str,
    lake: LakePaths,
    feed: Feed,
    record: T.StructType = MOVIE,
    page_per_file: bool = False,
) -> None:
    """Write the feed's bronze table, and unreadable pages beside it."""
    rows, bad = typed_feed(spark, landing, feed, record, page_per_file)
    write_table(rows, lake.bronze(feed.table))
    write_table(bad, lake.bronze(f"{feed.table}_quarantine"))


def ingest_genres(
    spark: SparkSession, landing: str, lake: LakePaths, page_per_file: bool = False
) -> None:
    """Write the genre dimension, and unreadable envelopes beside it."""
    genres = read_genres(spark, landing, page_per_file)
    write_table(genres.good, lake.bronze(GENRE_TABLE))
    write_table(genres.bad, lake.bronze(f"{GENRE_TABLE}_quarantine"))
