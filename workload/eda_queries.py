"""Registered queries for the exploratory questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import eda
from marquee.plans.combine import CONSTANT_COLUMNS
from marquee.plans.features import processed_nulls
from marquee.schemas import WIDE_MOVIE
from marquee.session import stage
from workload import fixture as fx
from workload.fixture import over_catalog, over_processed
from workload.generic import FEEDS_SQL, describe_sql, flat, rounded
from workload.registry import register

# What answers with the normalised popularity need besides it.
NORMALIZED = {
    "title_popularity": ("title",),
    "corr_rating": ("vote_average",),
    "corr_votes": ("vote_count",),
    "corr_age": ("movie_age",),
    "gems": ("title", "vote_average"),
}


def _question(
    name: str,
    answer,
    sql: str,
    digits: int | None = None,
    twice: Sequence[str] | None = None,
    texts: bool = False,
) -> None:
    """Register ``answer(processed)``; ``twice`` names the columns to stage
    where the normalised popularity makes the plan read the table twice;
    ``texts`` tells whether overviews are asked for."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if twice is None:
            movies = fx.processed(spark, sf_dir, texts=texts)
        else:
            movies = fx.processed_narrow(spark, sf_dir, twice)
        result = answer(movies)
        return result if digits is None else rounded(result, digits)

    run.__name__ = name
    register(name, sql)(run)


def _count_sql(key: str, name: str = '"count"', n: int | None = None, where: str = "") -> str:
    top = "" if n is None else f" ORDER BY count(*) DESC, {key} NULLS LAST LIMIT {n}"
    return over_processed(
        f"SELECT {key}, count(*) AS {name} FROM processed {where} GROUP BY {key}{top}"
    )


def _title_sql(order: str) -> str:
    return over_processed(
        f"""SELECT title, round(avg(normalized_popularity), 9) AS avg_normalized_popularity
        FROM processed GROUP BY title
        ORDER BY avg_normalized_popularity {order}, title NULLS LAST LIMIT 10"""
    )


def _votes_sql(order: str) -> str:
    return over_processed(
        f"""SELECT title, CAST(sum(vote_count) AS BIGINT) AS total_votes FROM processed
        GROUP BY title ORDER BY total_votes {order}, title NULLS LAST LIMIT 10"""
    )


def _score_sql(key: str, n: int | None = None) -> str:
    limit = "" if n is None else f" LIMIT {n}"
    return over_processed(
        f"""SELECT {key}, round(avg(vote_average), 3) AS avg_votes FROM processed
        GROUP BY {key} ORDER BY avg_votes DESC NULLS LAST, {key} NULLS LAST{limit}"""
    )


def _corr_sql(column: str) -> str:
    return over_processed(
        f"SELECT round(corr(coalesce({column}, 0), coalesce(normalized_popularity, 0)), 6) AS corr"
        " FROM processed"
    )


def _age_group_sql(column: str, name: str, digits: int) -> str:
    return over_processed(
        f"""SELECT CASE WHEN movie_age < 10 THEN 'New' WHEN movie_age < 30 THEN 'Modern'
          ELSE 'Classic' END AS age_group, round(avg({column}), {digits}) AS {name}
        FROM processed GROUP BY ALL"""
    )


_question(
    "eda_numeric_describe",
    eda.numeric_describe,
    over_processed(describe_sql(list(eda.NUMERIC), "processed")),
    digits=4,
)
_question(
    "eda_language_distinct",
    eda.language_distinct,
    over_processed(
        "SELECT count(*) AS n_languages FROM (SELECT DISTINCT original_language FROM processed)"
    ),
)
_question("eda_rating_counts", eda.rating_counts, _count_sql("rating_category"))
_question("eda_language_top10", eda.language_top, _count_sql("original_language", n=10))
_question("eda_remake_counts", eda.remake_counts, _count_sql("is_remake"))
_question(
    "eda_title_popularity_top10",
    eda.title_popularity,
    _title_sql("DESC NULLS LAST"),
    twice=NORMALIZED["title_popularity"],
)
_question(
    "eda_title_popularity_bottom10",
    lambda movies: eda.title_popularity(movies, ascending=True),
    _title_sql("ASC NULLS FIRST"),
    twice=NORMALIZED["title_popularity"],
)
_question("eda_genre_top10", eda.genre_top, _count_sql("genre_names", n=10))
_question("eda_language_rating_top10", eda.language_rating, _score_sql("original_language", 10))
_question("eda_month_counts", eda.month_counts, _count_sql("release_month"))
_question("eda_year_rating", eda.year_rating, _score_sql("release_year"))
_question(
    "eda_overview_by_rating",
    eda.overview_by_rating,
    over_processed(
        "SELECT rating_category, round(avg(overview_length), 6) AS avg_length"
        " FROM processed GROUP BY rating_category"
    ),
    digits=6,
    texts=True,
)
_question(
    "eda_corr_rating_popularity",
    eda.corr_rating_popularity,
    _corr_sql("vote_average"),
    digits=6,
    twice=NORMALIZED["corr_rating"],
)
_question(
    "eda_corr_votes_popularity",
    eda.corr_votes_popularity,
    _corr_sql("vote_count"),
    digits=6,
    twice=NORMALIZED["corr_votes"],
)
_question(
    "eda_corr_age_popularity",
    eda.corr_age_popularity,
    _corr_sql("movie_age"),
    digits=6,
    twice=NORMALIZED["corr_age"],
)
_question(
    "eda_hidden_gems",
    eda.hidden_gems,
    over_processed(
        "SELECT title, round(vote_average, 6) AS vote_average, normalized_popularity"
        " FROM processed WHERE vote_average > 8 AND normalized_popularity < 0.5"
    ),
    digits=6,
    twice=NORMALIZED["gems"],
)
_question("eda_votes_top10", eda.votes_by_title, _votes_sql("DESC NULLS LAST"))
_question(
    "eda_votes_bottom10",
    lambda movies: eda.votes_by_title(movies, ascending=True),
    _votes_sql("ASC NULLS FIRST"),
)
_question(
    "eda_remake_rating",
    eda.remake_rating,
    over_processed(
        "SELECT is_remake, round(avg(vote_average), 6) AS avg_rating FROM processed GROUP BY is_remake"
    ),
    digits=6,
)
_question(
    "eda_age_group_rating",
    eda.age_group_rating,
    _age_group_sql("vote_average", "avg_votes", 6),
    digits=6,
)
_question(
    "eda_age_group_popularity",
    eda.age_group_popularity,
    _age_group_sql("popularity", "avg_popularity", 4),
    digits=4,
)
_question(
    "eda_poster_null_count",
    eda.poster_null_count,
    over_processed("SELECT count(*) AS n_null FROM processed WHERE poster_url IS NULL"),
)
_question(
    "eda_backdrop_null_count",
    eda.backdrop_null_count,
    over_processed("SELECT count(*) AS n_null FROM processed WHERE backdrop_url IS NULL"),
)
_question("eda_year_counts", eda.year_counts, _count_sql("release_year", "num_movies"))
_question(
    "eda_rating_profile",
    eda.rating_profile,
    over_processed(
        """SELECT rating_category, round(avg(vote_average), 4) AS avg_votes,
          round(avg(vote_count), 4) AS avg_votes_count, round(avg(popularity), 4) AS avg_popularity
        FROM processed GROUP BY rating_category"""
    ),
    digits=4,
)
_question(
    "eda_top_performers_by_year",
    eda.top_performers,
    _count_sql("release_year", where="WHERE vote_average > 0.8"),
)
_question(
    "eda_rating_describe",
    eda.rating_describe,
    over_processed(describe_sql(["vote_average"], "processed")),
    digits=4,
)
_question(
    "eda_rating_histogram",
    eda.rating_histogram,
    over_processed(
        'SELECT floor(vote_average) * 1.0::DOUBLE AS score_from, count(*) AS "count"'
        " FROM processed GROUP BY ALL"
    ),
)
_question(
    "eda_popularity_by_year",
    eda.popularity_by_year,
    over_processed(
        "SELECT release_year, round(avg(popularity), 4) AS avg_popularity"
        " FROM processed GROUP BY release_year"
    ),
    digits=4,
)

# The stored catalogue without its constants, and what feature engineering adds.
PROCESSED_COLUMNS = (
    *(f.name for f in WIDE_MOVIE.fields if f.name not in CONSTANT_COLUMNS),
    "genre_names",
    "release_year",
    "release_month",
    "release_day",
    "rating_category",
    "normalized_popularity",
    "overview_length",
    "poster_url",
    "backdrop_url",
    "is_remake",
    "movie_age",
)


@register(
    "eda_sql_view_all",
    over_processed("SELECT * REPLACE (array_to_string(genre_ids, ',') AS genre_ids) FROM processed"),
)
def eda_sql_view_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(eda.sql_view_all(fx.processed_full(spark, sf_dir)))


@register(
    "eda_rating_summary",
    over_processed(describe_sql(["vote_average"], "processed", quartiles=True)),
)
def eda_rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles take several passes, so the scores are staged."""
    scores = stage(fx.catalog(spark, sf_dir, texts=False).select("vote_average"), "scores")
    return rounded(eda.rating_summary(scores, accuracy=None), 4)


@register(
    "eda_rating_summary_default",
    over_processed(describe_sql(["vote_average"], "processed", quartiles=True)),
)
def eda_rating_summary_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notebook's call: quartiles by a sketch, in one pass."""
    scores = fx.catalog(spark, sf_dir, texts=False).select("vote_average")
    return rounded(eda.rating_summary(scores), 4)


@register(
    "eda_null_profile",
    over_processed(
        "SELECT "
        + ", ".join(f"count(*) - count({c}) AS {c}" for c in PROCESSED_COLUMNS)
        + " FROM processed"
    ),
)
def eda_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a catalogue that is not stored: the derived columns' NULLs from their sources, in one scan."""
    movies = fx.all_movies(spark, sf_dir, texts="known")
    return processed_nulls(movies, fx.genre_dim(spark, sf_dir))


@register(
    "eda_feed_counts",
    over_catalog(
        f"""{FEEDS_SQL}
        SELECT 'popular' AS feed, count(*) AS n_rows FROM catalog WHERE id % 2 = 0
        UNION ALL SELECT 'top_rated', count(*) FROM catalog WHERE id % 2 = 1
        UNION ALL SELECT 'upcoming', count(*) FROM catalog WHERE id % 5 = 0
        UNION ALL SELECT 'present', count(*) FROM catalog WHERE id % 7 = 0
        UNION ALL SELECT 'combined', count(*) FROM (SELECT DISTINCT * FROM feeds)"""
    ),
)
def eda_feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a movie, as it is and with its later popularity, each with its feeds."""
    movies = fx.catalog(spark, sf_dir)
    early = F.array_compact(
        F.array(*(F.when(F.expr(r), F.lit(n)) for n, r in fx.FEED_RULES.items() if n != "present"))
    )
    late = F.array_compact(F.array(F.when(F.expr(fx.FEED_RULES["present"]), F.lit("present"))))
    versions = F.array(
        F.struct(F.col("popularity").alias("popularity"), early.alias("feeds")),
        F.struct((F.col("popularity") + 1).alias("popularity"), late.alias("feeds")),
    )
    others = [c for c in movies.columns if c != "popularity"]
    return eda.membership_counts(movies.select(*others, F.inline(versions)))


@register(
    "eda_genre_single_counts",
    over_catalog(
        """, ids AS (SELECT unnest(genre_ids) AS genre_id FROM catalog)
        SELECT n_name AS genre, count(*) AS "count"
        FROM ids LEFT JOIN nation ON n_nationkey = genre_id GROUP BY n_name"""
    ),
)
def eda_genre_single_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.genre_single_counts(fx.catalog(spark, sf_dir, texts=False), fx.genre_dim(spark, sf_dir))
