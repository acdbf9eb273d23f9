"""Feeds landed as JSON pages.

A landed feed is a directory of text files, one page per line (or one page
per file).  Files are split over the executors; nothing passes the driver.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import GENRE_PAGE, MOVIE, page_schema
from marquee.session import stage

_CORRUPT = "_corrupt_record"


class Pages(NamedTuple):
    """Pages that parsed, and the text of those that did not."""

    good: DataFrame
    bad: DataFrame


def read_pages(
    spark: SparkSession,
    path: str,
    envelope: T.StructType,
    page_per_file: bool = False,
    parse_once: bool = False,
) -> Pages:
    """Parse landed pages with a declared schema.

    A page that is no JSON, that breaks the schema, or that lacks its payload
    array (an error reply) is kept whole in ``bad`` and the load goes on.
    ``parse_once`` stages the parsed pages, for jobs that write both parts.
    """
    lines = spark.read.text(path, wholetext=page_per_file)
    payload = next(f.name for f in envelope.fields if isinstance(f.dataType, T.ArrayType))
    reported = T.StructType([*envelope.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.filter(F.trim("value") != "").select(
        "value", F.from_json("value", reported, options).alias("p")
    )
    usable = F.col("p").isNotNull() & F.col(f"p.{_CORRUPT}").isNull() & F.col(f"p.{payload}").isNotNull()
    fields = [F.col(f"p.{f.name}").alias(f.name) for f in envelope.fields]
    told = parsed.select(*fields, F.when(~usable, F.col("value")).alias("value"))
    if parse_once:
        told = stage(told, "parsed-pages")
    names = [f.name for f in envelope.fields]
    return Pages(
        good=told.filter("value IS NULL").select(*names),
        bad=told.filter("value IS NOT NULL").select("value"),
    )


def within_cap(max_pages: int | None = None) -> Column:
    """A page limit, if one is wanted; a page without a number is within it.

    Limits belong to an API's paging; pages that have landed all count by default.
    """
    return F.lit(True) if max_pages is None else F.coalesce(F.col("page") <= max_pages, F.lit(True))


def movies_of(pages: DataFrame) -> DataFrame:
    """One row per record of every page."""
    return pages.select(F.inline("results"))


def read_movie_pages(
    spark: SparkSession,
    path: str,
    record: T.StructType = MOVIE,
    max_pages: int | None = None,
    page_per_file: bool = False,
) -> DataFrame:
    """The movies of a landed feed, all or up to ``max_pages``.

    Pages that cannot be read are left out here; ``read_pages`` gives them too.
    """
    good = read_pages(spark, path, page_schema(record), page_per_file).good
    return movies_of(good.filter(within_cap(max_pages)))


def read_genres(spark: SparkSession, path: str, page_per_file: bool = False) -> Pages:
    """The genre dimension from its landed envelopes, and the envelopes that cannot be read."""
    pages = read_pages(spark, path, GENRE_PAGE, page_per_file)
    return Pages(pages.good.select(F.inline("genres")), pages.bad)
