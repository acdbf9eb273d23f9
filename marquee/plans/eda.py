"""The exploratory questions, as frames over a processed movie table.

Every answer is a lazy plan: column pruning and filters reach the scan, and
rankings end in a limit that each task applies first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import bucketize
from marquee.operators.aggregates import (
    count_rows,
    group_agg,
    group_count,
    null_count,
)
from marquee.operators.columns import filter_all
from marquee.operators.profile import correlation, describe, null_profile, summary
from marquee.operators.setops import distinct_count, union_all
from marquee.plans.features import AGE_BOUNDS, AGE_OTHERWISE

# The columns of the numeric profile, and below the names of answer columns.
NUMERIC = ("popularity", "vote_average", "vote_count", "movie_age")


def numeric_describe(movies: DataFrame) -> DataFrame:
    return describe(movies, NUMERIC)


def language_distinct(movies: DataFrame) -> DataFrame:
    return distinct_count(movies, "original_language", "n_languages")


def rating_counts(movies: DataFrame) -> DataFrame:
    return group_count(movies, "rating_category")


def language_top(movies: DataFrame, n: int = 10) -> DataFrame:
    return group_count(movies, "original_language", n)


def remake_counts(movies: DataFrame) -> DataFrame:
    return group_count(movies, "is_remake")


def title_popularity(movies: DataFrame, n: int = 10, ascending: bool = False) -> DataFrame:
    """Titles with the highest (or lowest) mean normalised popularity."""
    return group_agg(
        movies,
        "title",
        {"avg_normalized_popularity": ("avg", "normalized_popularity")},
        digits=9,
        sort_by="avg_normalized_popularity",
        ascending=ascending,
        n=n,
    )


def sql_view_all(movies: DataFrame, view: str = "movies") -> DataFrame:
    """Publish the table as a session view and select from it."""
    movies.createOrReplaceTempView(view)
    return movies.sparkSession.sql(f"SELECT * FROM {view}")


def genre_top(movies: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent genre sentences, each a combination of genres."""
    return group_count(movies, "genre_names", n)


def language_rating(movies: DataFrame, n: int = 10) -> DataFrame:
    return _mean_score(movies, "original_language", n)


def month_counts(movies: DataFrame) -> DataFrame:
    return group_count(movies, "release_month")


def year_rating(movies: DataFrame, n: int | None = None) -> DataFrame:
    return _mean_score(movies, "release_year", n)


def overview_by_rating(movies: DataFrame) -> DataFrame:
    return group_agg(
        movies,
        "rating_category",
        {"avg_length": ("avg", "overview_length")},
        sort_by="avg_length",
    )


def corr_rating_popularity(movies: DataFrame, nulls: str = "zero") -> DataFrame:
    return correlation(movies, "vote_average", "normalized_popularity", nulls)


def corr_votes_popularity(movies: DataFrame, nulls: str = "zero") -> DataFrame:
    return correlation(movies, "vote_count", "normalized_popularity", nulls)


def corr_age_popularity(movies: DataFrame, nulls: str = "zero") -> DataFrame:
    return correlation(movies, "movie_age", "normalized_popularity", nulls)


def hidden_gems(
    movies: DataFrame, min_score: float = 8.0, max_popularity: float = 0.5
) -> DataFrame:
    """Well rated, little known."""
    return filter_all(
        movies,
        F.col("vote_average") > min_score,
        F.col("normalized_popularity") < max_popularity,
    ).select("title", "vote_average", "normalized_popularity")


def votes_by_title(movies: DataFrame, n: int = 10, ascending: bool = False) -> DataFrame:
    return group_agg(
        movies,
        "title",
        {"total_votes": ("sum", "vote_count")},
        sort_by="total_votes",
        ascending=ascending,
        n=n,
    )


def remake_rating(movies: DataFrame) -> DataFrame:
    return group_agg(movies, "is_remake", {"avg_rating": ("avg", "vote_average")})


def age_group() -> Column:
    return bucketize("movie_age", AGE_BOUNDS, AGE_OTHERWISE, compare="<")


def age_group_mean(movies: DataFrame, column: str, name: str) -> DataFrame:
    grouped = movies.withColumn("age_group", age_group())
    return group_agg(grouped, "age_group", {name: ("avg", column)}, sort_by=name)


def age_group_rating(movies: DataFrame) -> DataFrame:
    return age_group_mean(movies, "vote_average", "avg_votes")


def age_group_popularity(movies: DataFrame) -> DataFrame:
    return age_group_mean(movies, "popularity", "avg_popularity")


def poster_null_count(movies: DataFrame) -> DataFrame:
    return null_count(movies, "poster_url")


def backdrop_null_count(movies: DataFrame) -> DataFrame:
    return null_count(movies, "backdrop_url")


def year_counts(movies: DataFrame, n: int | None = None) -> DataFrame:
    return group_count(movies, "release_year", n, "num_movies")


def rating_profile(movies: DataFrame) -> DataFrame:
    return group_agg(
        movies,
        "rating_category",
        {
            "avg_votes": ("avg", "vote_average"),
            "avg_votes_count": ("avg", "vote_count"),
            "avg_popularity": ("avg", "popularity"),
        },
    )


def top_performers(
    movies: DataFrame, threshold: float = 0.8, period: str = "release_year", n: int | None = None
) -> DataFrame:
    """Rows above a score, per period."""
    return group_count(movies.filter(F.col("vote_average") > threshold), period, n)


def rating_summary(movies: DataFrame, accuracy: int | None = 10_000) -> DataFrame:
    return summary(movies, ["vote_average"], accuracy)


def rating_describe(movies: DataFrame) -> DataFrame:
    return describe(movies, ["vote_average"])


def nulls_per_column(movies: DataFrame) -> DataFrame:
    return null_profile(movies)


def feed_counts(feeds: dict[str, DataFrame], combined: DataFrame) -> DataFrame:
    """Rows of every feed and of their deduplicated union, each counted by itself."""
    counts = [
        count_rows(frame).select(F.lit(name).alias("feed"), "n_rows")
        for name, frame in [*feeds.items(), ("combined", combined)]
    ]
    return union_all(counts)


def membership_counts(rows: DataFrame, feeds: str = "feeds") -> DataFrame:
    """The same where one table holds all rows with the array of feeds they are in.

    One scan.  Equal rows are found by two 64-bit hashes of their content, so texts are not
    shuffled to be counted.
    """
    content = [F.col(f"`{c}`") for c in rows.columns if c != feeds]
    hashed = rows.select(
        F.col(feeds),
        F.xxhash64(*content, F.lit(1)).alias("h1"),
        F.xxhash64(*content, F.lit(2)).alias("h2"),
    )
    per_row = hashed.select("h1", "h2", F.explode(feeds).alias("feed")).groupBy("h1", "h2", "feed")
    counted = per_row.agg(F.count(F.lit(1)).alias("n"))
    # A row of hashes is combined once, whatever feeds hold it.
    firsts = counted.withColumn(
        "first", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("feed")) == 1
    )
    lines = F.array(
        F.struct(F.col("feed"), F.col("n").alias("n")),
        F.struct(F.lit("combined").alias("feed"), F.col("first").cast("long").alias("n")),
    )
    return (
        firsts.select(F.inline(lines)).groupBy("feed").agg(F.sum("n").alias("n_rows"))
    )


def genre_single_counts(
    movies: DataFrame, genres: DataFrame, n: int | None = None
) -> DataFrame:
    """Rows per single genre.

    Ids are counted before they meet their names, so the join sees one row
    per genre; an id without a name counts under NULL.
    """
    ids = movies.select(F.explode("genre_ids").alias("genre_id"))
    per_id = ids.groupBy("genre_id").agg(F.count(F.lit(1)).alias("n"))
    names = genres.groupBy(F.col("id").alias("genre_id")).agg(F.max("name").alias("genre"))
    named = per_id.join(names, "genre_id", "left")
    return group_agg(named, "genre", {"count": ("sum", "n")}, sort_by="count", n=n)


def rating_histogram(movies: DataFrame, width: float = 1.0) -> DataFrame:
    """Rows per score interval, by the interval's lower bound."""
    lower = (F.floor(F.col("vote_average") / width) * F.lit(width)).alias("score_from")
    return movies.groupBy(lower).agg(F.count(F.lit(1)).alias("count")).orderBy("score_from")


def popularity_by_year(movies: DataFrame) -> DataFrame:
    return group_agg(
        movies, "release_year", {"avg_popularity": ("avg", "popularity")}
    ).orderBy(F.col("release_year").asc_nulls_last())


def _mean_score(movies: DataFrame, key: str, n: int | None) -> DataFrame:
    return group_agg(
        movies, key, {"avg_votes": ("avg", "vote_average")}, digits=3, sort_by="avg_votes", n=n
    )
