"""Declared schemas of the feeds, the genre dimension and their page envelopes."""

from __future__ import annotations

from pyspark.sql import types as T


def movie_schema(integer: T.DataType = T.IntegerType()) -> T.StructType:
    """The 14-field movie record, every field nullable.

    ``integer`` is the type of ``id`` and ``vote_count``.  Feeds use 32 bits;
    pass ``LongType()`` where the keys outgrow them.
    """
    # The feed's fields and types, in its order.
    return T.StructType(
        [
            T.StructField("adult", T.BooleanType()),
            T.StructField("backdrop_path", T.StringType()),
            T.StructField("genre_ids", T.ArrayType(T.IntegerType())),
            T.StructField("id", integer),
            T.StructField("original_language", T.StringType()),
            T.StructField("original_title", T.StringType()),
            T.StructField("overview", T.StringType()),
            T.StructField("popularity", T.DoubleType()),
            T.StructField("poster_path", T.StringType()),
            T.StructField("release_date", T.StringType()),
            T.StructField("title", T.StringType()),
            T.StructField("video", T.BooleanType()),
            T.StructField("vote_average", T.DoubleType()),
            T.StructField("vote_count", integer),
        ]
    )


MOVIE = movie_schema()
WIDE_MOVIE = movie_schema(T.LongType())

GENRE = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())]
)


def page_schema(record: T.StructType = MOVIE) -> T.StructType:
    """One page of a feed as it was landed; pages count in the record's key type."""
    number = record["id"].dataType
    return T.StructType(
        [
            T.StructField("page", number),
            T.StructField("total_pages", number),
            T.StructField("results", T.ArrayType(record)),
        ]
    )


GENRE_PAGE = T.StructType([T.StructField("genres", T.ArrayType(GENRE))])
