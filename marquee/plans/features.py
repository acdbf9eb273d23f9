"""The derived columns of a movie table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import (
    age_years,
    bucketize,
    date_or_null,
    date_parts,
    differs_flag,
    english_list,
    int_to_bool,
    prefixed,
    text_length,
)
from marquee.lake import LakePaths
from marquee.operators.columns import max_normalize
from marquee.operators.lookup import lookup_array_dim
from marquee.plans.combine import SILVER_ALL
from marquee.plans.ingest import GENRE_TABLE
from marquee.sources.tables import read_table, write_table

# Bucket bounds and labels.
SCORE_BOUNDS = ((8, "High"), (5, "Medium"))
SCORE_OTHERWISE = "Low"
AGE_BOUNDS = ((10, "New"), (30, "Modern"))
AGE_OTHERWISE = "Classic"

SILVER_PROCESSED = "movies_processed"


def engineer_features(
    movies: DataFrame,
    genres: DataFrame,
    image_base_url: str,
    as_of: dt.date | str | None = None,
    lookup: str = "auto",
) -> DataFrame:
    """Twelve movie columns to twenty-three.

    ``movies`` is read twice where ``normalized_popularity`` is used (once
    for its maximum), so it should be a stored table.
    """
    named = lookup_array_dim(movies, "genre_ids", genres, out="__genres", how=lookup)
    normalized = max_normalize(named, "popularity", "__normalized")
    parts = date_parts("release_date", "release")
    return normalized.select(
        *movies.columns,
        english_list("__genres").alias("genre_names"),
        *(c.alias(name) for name, c in parts.items()),
        bucketize("vote_average", SCORE_BOUNDS, SCORE_OTHERWISE).alias("rating_category"),
        F.col("__normalized").alias("normalized_popularity"),
        text_length("overview").alias("overview_length"),
        prefixed(image_base_url, "poster_path").alias("poster_url"),
        prefixed(image_base_url, "backdrop_path").alias("backdrop_url"),
        int_to_bool(differs_flag("title", "original_title")).alias("is_remake"),
        age_years("release_date", as_of).alias("movie_age"),
    )


def processed_nulls(movies: DataFrame, genres: DataFrame, lookup: str = "auto") -> DataFrame:
    """One row: the NULLs in every column that ``engineer_features`` would make of ``movies``.

    Each derived column's NULLs follow from its source columns, so nothing is derived, staged or
    read twice: one scan, and of a text only whether it is there.  A sentence of genres is NULL with
    its last name, so only the last id is looked up.
    """
    last = F.when(F.size("genre_ids") > 0, F.array(F.element_at("genre_ids", -1)))
    named = lookup_array_dim(movies.withColumn("__last", last), "__last", genres, out="__name", how=lookup)

    def missing(c: str | Column) -> Column:
        return F.count_if((F.col(c) if isinstance(c, str) else c).isNull())

    never = F.count_if(F.lit(False))
    undated = missing(date_or_null("release_date"))
    # Without a maximum, or with one of 0, nothing can be normalised.
    no_peak = F.coalesce(F.max("popularity"), F.lit(0)) == 0
    return named.agg(
        *(missing(c).alias(c) for c in movies.columns),
        missing(F.try_element_at("__name", F.lit(1))).alias("genre_names"),
        *(undated.alias(name) for name in date_parts("release_date", "release")),
        never.alias("rating_category"),
        F.when(no_peak, F.count(F.lit(1))).otherwise(missing("popularity")).alias("normalized_popularity"),
        missing("overview").alias("overview_length"),
        missing("poster_path").alias("poster_url"),
        missing("backdrop_path").alias("backdrop_url"),
        never.alias("is_remake"),
        undated.alias("movie_age"),
    )


def build_movies_processed(
    spark: SparkSession,
    lake: LakePaths,
    image_base_url: str,
    as_of: dt.date | str | None = None,
) -> None:
    movies = read_table(spark, lake.silver(SILVER_ALL))
    genres = read_table(spark, lake.bronze(GENRE_TABLE))
    write_table(
        engineer_features(movies, genres, image_base_url, as_of), lake.silver(SILVER_PROCESSED)
    )
