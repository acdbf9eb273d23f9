"""Registered queries for feature encoding and the split."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.encode import split_counts, topk_onehot, with_split
from marquee.plans.modeling import ENCODED, REQUIRED, build_model_frame
from marquee.session import stage
from workload import fixture as fx
from workload.fixture import over_catalog, over_processed
from workload.registry import register

PREFIXES = {"genre_names": "genre_", "original_language": "lang_"}


def _hot_sql(column: str, prefix: str) -> str:
    """The indicator that is 1 for a row: its category, ``other``, or NULL."""
    return (
        f"CASE WHEN {column} IS NULL THEN NULL"
        f" WHEN {column} IN (SELECT {column} FROM top_{column})"
        f" THEN '{prefix}' || {column} ELSE 'other_{column}' END"
    )


def _top_sql(column: str, source: str) -> str:
    return f"""
    top_{column} AS (
      SELECT {column} FROM (
        SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column} NULLS LAST) AS r
        FROM {source} GROUP BY {column}) WHERE r <= 5 AND {column} IS NOT NULL)"""


@register(
    "enc_topk_onehot",
    over_catalog(
        f""", {_top_sql('original_language', 'catalog')},
        names AS (SELECT 'lang_' || original_language AS name, original_language AS category
                  FROM top_original_language UNION ALL SELECT 'other_original_language', NULL)
        SELECT id, name, CAST(coalesce(CASE WHEN category IS NULL
            THEN original_language NOT IN (SELECT original_language FROM top_original_language)
            ELSE original_language = category END, false) AS INTEGER) AS flag
        FROM catalog CROSS JOIN names"""
    ),
)
def enc_topk_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form: which columns there are depends on the data."""
    movies = stage(fx.catalog(spark, sf_dir, texts=False).select("id", "original_language"), "languages")
    encoded, names = topk_onehot(movies, "original_language", 5, "lang_")
    return encoded.unpivot(["id"], names, "name", "flag")


@register(
    "enc_string_index",
    over_processed(
        """, ranked AS (
          SELECT rating_category, row_number() OVER (ORDER BY count(*) DESC, rating_category) - 1 AS i
          FROM processed GROUP BY rating_category)
        SELECT id, CAST(i AS DOUBLE) AS rating_category_index
        FROM processed JOIN ranked USING (rating_category)"""
    ),
)
def enc_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(fx.processed(spark, sf_dir, texts=False).select("id", "rating_category"), "ratings")
    indexer = StringIndexer(
        inputCol="rating_category", outputCol="rating_category_index", handleInvalid="keep"
    )
    return indexer.fit(rows).transform(rows).select("id", "rating_category_index")


ASSEMBLED = ("vote_count", "vote_average", "popularity")


@register(
    "enc_assemble",
    over_catalog(
        "SELECT id, CAST(vote_count AS DOUBLE) AS vote_count, vote_average, popularity FROM catalog"
    ),
)
def enc_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.catalog(spark, sf_dir, texts=False).select("id", *ASSEMBLED)
    assembled = VectorAssembler(inputCols=list(ASSEMBLED), outputCol="v").transform(rows)
    return _unpacked(assembled.select("id", "v"))


@register(
    "enc_standard_scale",
    over_catalog(
        "SELECT id, "
        + ", ".join(
            f"round({c} / (SELECT stddev_samp({c}) FROM catalog), 6) AS {c}" for c in ASSEMBLED
        )
        + " FROM catalog"
    ),
)
def enc_standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(fx.catalog(spark, sf_dir, texts=False).select("id", *ASSEMBLED), "numbers")
    assembled = VectorAssembler(inputCols=list(ASSEMBLED), outputCol="raw").transform(rows)
    scaled = StandardScaler(inputCol="raw", outputCol="v").fit(assembled).transform(assembled)
    return _unpacked(scaled.select("id", "v"), digits=6)


def _unpacked(df: DataFrame, digits: int | None = None) -> DataFrame:
    values = vector_to_array("v")
    elements = [F.get(values, F.lit(i)) for i in range(len(ASSEMBLED))]
    if digits is not None:
        elements = [F.round(e, digits) for e in elements]
    return df.select("id", *(e.alias(c) for e, c in zip(elements, ASSEMBLED)))


FRAME_COLUMNS = ("id", "vote_average", "is_remake", *REQUIRED)


@register(
    "enc_model_frame",
    over_processed(
        f""", {_top_sql('genre_names', 'processed')}, {_top_sql('original_language', 'processed')}
        SELECT id, vote_average, CAST(is_remake AS INTEGER) AS is_remake, {', '.join(REQUIRED)},
          {_hot_sql('genre_names', 'genre_')} AS hot_genre_names,
          {_hot_sql('original_language', 'lang_')} AS hot_original_language
        FROM processed WHERE release_year IS NOT NULL AND release_month IS NOT NULL
          AND release_day IS NOT NULL AND movie_age IS NOT NULL"""
    ),
)
def enc_model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per encoded column the one indicator that is set."""
    rows = stage(
        fx.processed(spark, sf_dir, texts=False).select(
            "id", "vote_average", "is_remake", *REQUIRED, *ENCODED
        ),
        "processed",
    )
    frame = build_model_frame(rows, prefixes=PREFIXES)
    hot = []
    for column in ENCODED:
        own = [
            n
            for n in frame.encoded
            if n == f"other_{column}" or n.startswith(PREFIXES[column])
        ]
        hot.append(
            F.coalesce(*(F.when(F.col(f"`{n}`") == 1, F.lit(n)) for n in own)).alias(
                f"hot_{column}"
            )
        )
    return frame.rows.select(*FRAME_COLUMNS, *hot)


def fold_sql(folds: int) -> str:
    """The fold of a search a row's id falls in."""
    digest = "md5('fold:' || CAST(id AS VARCHAR))"
    return f"CAST(('0x' || substr({digest}, 1, 4)) AS INTEGER) % {folds}"


BUCKET_SQL = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 4)) AS INTEGER) % 100 < 70"


@register("split_train_test", over_catalog(f"SELECT id, {BUCKET_SQL} AS is_train FROM catalog"))
def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(fx.catalog(spark, sf_dir, texts=False).select("id"))


@register(
    "split_counts",
    over_catalog(f"SELECT {BUCKET_SQL} AS is_train, count(*) AS n_rows FROM catalog GROUP BY ALL"),
)
def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(fx.catalog(spark, sf_dir, texts=False).select("id"))
