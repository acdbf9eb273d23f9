"""Registered queries for sources, sinks and generic operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import (
    age_years,
    bool_to_int,
    bucketize,
    date_parts,
    differs_flag,
    english_list,
    int_to_bool,
    not_in_flag,
    prefixed,
    text_length,
)
from marquee.operators import aggregates as agg
from marquee.operators import columns as cols
from marquee.operators import profile as prof
from marquee.operators.lookup import lookup_array_dim
from marquee.operators.setops import dedup_rows, dedup_stored, distinct_count, union_all
from marquee.operators.encode import topk_values
from marquee.plans.combine import combine_feeds
from marquee.plans.eda import age_group
from marquee.plans.features import SCORE_BOUNDS, SCORE_OTHERWISE
from marquee.schemas import WIDE_MOVIE, page_schema
from marquee.session import scratch_path, stage
from marquee.sources.pages import read_genres, read_movie_pages, read_pages
from marquee.sources.tables import read_table, write_table
from workload import fixture as fx
from workload.fixture import AS_OF, IMAGES, over_catalog, table
from workload.registry import register

MOVIE_SQL = (
    "adult, backdrop_path, array_to_string(genre_ids, ',') AS genre_ids, id, original_language,"
    " original_title, overview, popularity, poster_path, release_date, title, video,"
    " vote_average, vote_count"
)
ALL_SQL = MOVIE_SQL.replace("adult, ", "").replace("video, ", "")
FEEDS_SQL = """,
feeds AS (
  SELECT * FROM catalog WHERE id % 2 = 0 UNION ALL SELECT * FROM catalog WHERE id % 2 = 1
  UNION ALL SELECT * FROM catalog WHERE id % 5 = 0
  UNION ALL SELECT * REPLACE (popularity + 1 AS popularity) FROM catalog WHERE id % 7 = 0)"""
PAGED_SQL = """,
paged AS (
  SELECT *, id // 20 + 1 AS page FROM catalog
  UNION ALL SELECT *, 1 AS page FROM catalog WHERE id // 20 = 0)"""


def joined(ids: Column | str) -> Column:
    """An id array as text, so every engine compares it alike."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


def flat(df: DataFrame) -> DataFrame:
    return df.withColumn("genre_ids", joined("genre_ids"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes)
    )


# --- sources and sinks -----------------------------------------------------


def landing(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "pages")
    fx.landed_pages(spark, sf_dir).write.text(path, compression="gzip")
    return path


@register("src_movie_pages", over_catalog(f"{PAGED_SQL} SELECT {MOVIE_SQL} FROM paged"))
def src_movie_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(read_movie_pages(spark, landing(spark, sf_dir), WIDE_MOVIE, max_pages=None))


@register(
    "src_page_cap", over_catalog(f"{PAGED_SQL} SELECT {MOVIE_SQL} FROM paged WHERE page <= 500")
)
def src_page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(read_movie_pages(spark, landing(spark, sf_dir), WIDE_MOVIE, max_pages=500))


@register(
    "src_genre_dim",
    """SELECT 'good' AS status, n_nationkey AS id, n_name AS name FROM nation
    UNION ALL SELECT 'bad', r_regionkey, r_name FROM region""",
)
def src_genre_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension lands as one envelope per region, and beside each one whose id is no number.

    Its genres are read; the bad envelopes come back whole.
    """
    path = scratch_path(spark, "genres")
    nation = table(spark, sf_dir, "nation")
    entry = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    envelopes = nation.groupBy("n_regionkey").agg(F.collect_list(entry).alias("genres"))
    region = table(spark, sf_dir, "region")
    broken = F.concat(
        F.lit('{"genres": [{"id": "?", "name": "'), "r_name", F.lit('"}], "key": '), "r_regionkey", F.lit("}")
    )
    envelopes.select(F.to_json(F.struct("genres")).alias("value")).unionByName(
        region.select(broken.alias("value"))
    ).write.text(path)
    genres = read_genres(spark, path)
    bad = genres.bad.select(
        F.lit("bad").alias("status"),
        F.get_json_object("value", "$.key").cast("int").alias("id"),
        F.get_json_object("value", "$.genres[0].name").alias("name"),
    )
    return genres.good.select(F.lit("good").alias("status"), "id", "name").unionByName(bad)


@register(
    "src_bad_page",
    over_catalog(
        f"""{PAGED_SQL},
        numbers AS (SELECT DISTINCT page FROM paged)
        SELECT 'good' AS status, count(*) + 1 AS n_pages FROM numbers
        UNION ALL SELECT 'bad', count(*) FROM numbers WHERE page % 50 = 7"""
    ),
)
def src_bad_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, landing(spark, sf_dir), page_schema(WIDE_MOVIE))
    counts = [
        agg.count_rows(part, "n_pages").select(F.lit(status).alias("status"), "n_pages")
        for status, part in (("good", pages.good), ("bad", pages.bad))
    ]
    return union_all(counts)


@register(
    "src_typed_schema",
    over_catalog(
        PAGED_SQL
        + " UNION ALL ".join(
            f" SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type,"
            f" count({f.name}) AS non_null FROM paged"
            for f in WIDE_MOVIE.fields
        )
    ),
)
def src_typed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.schema_profile(
        read_movie_pages(spark, landing(spark, sf_dir), WIDE_MOVIE, max_pages=None)
    )


@register("src_parquet", "SELECT * FROM part")
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/part.parquet")


@register("sink_parquet", "SELECT * FROM customer")
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer")
    write_table(source.limit(0), path)
    write_table(source, path)
    return read_table(spark, path, source.schema)


# --- projections -------------------------------------------------------------


@register("proj_select", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def proj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@register("proj_drop", over_catalog(f"SELECT {ALL_SQL} FROM catalog"))
def proj_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(fx.catalog(spark, sf_dir).drop("adult", "video"))


@register("proj_drop_constant", over_catalog(f"SELECT {ALL_SQL} FROM catalog"))
def proj_drop_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(cols.drop_constant_columns(stage(fx.catalog(spark, sf_dir), "catalog")))


@register("proj_rename", "SELECT p_partkey AS id, p_name AS title FROM part")
def proj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return cols.rename_columns(part, {"p_partkey": "id", "p_name": "title", "absent": "x"})


@register(
    "proj_alias",
    "SELECT p_brand, count(*) AS n_parts, round(avg(p_retailprice), 6) AS avg_price"
    " FROM part GROUP BY p_brand",
)
def proj_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n_parts"), F.round(F.avg("p_retailprice"), 6).alias("avg_price")
    )


@register("proj_cast_bool", "SELECT doc_id, quality = 1 AS quality, toxic = 1 AS toxic FROM labels")
def proj_cast_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        "doc_id", int_to_bool("quality").alias("quality"), int_to_bool("toxic").alias("toxic")
    )


@register(
    "proj_bool_to_int",
    over_catalog(
        "SELECT id, CASE WHEN title <> original_title THEN 1 ELSE 0 END AS is_remake FROM catalog"
    ),
)
def proj_bool_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = fx.catalog(spark, sf_dir, texts=False)
    remake = int_to_bool(differs_flag("title", "original_title"))
    return movies.select("id", remake.alias("is_remake")).select(
        "id", bool_to_int("is_remake").alias("is_remake")
    )


@register(
    "fill_sentinel",
    over_catalog(
        "SELECT id, coalesce(poster_path, '/no_image.jpg') AS poster_path,"
        " coalesce(backdrop_path, '/no_image.jpg') AS backdrop_path FROM catalog"
    ),
)
def fill_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = fx.catalog(spark, sf_dir, texts=False).select("id", "poster_path", "backdrop_path")
    return cols.fill_sentinel(images, ["poster_path", "backdrop_path"], "/no_image.jpg")


# --- filters -----------------------------------------------------------------


@register(
    "filt_chain",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem"
    " WHERE l_quantity > 40 AND l_discount < 0.03",
)
def filt_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return cols.filter_all(lines, F.col("l_quantity") > 40, F.col("l_discount") < 0.03).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )


@register(
    "filt_gt", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000"
)
def filt_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.filter(F.col("o_totalprice") > 200000).select("o_orderkey", "o_totalprice")


@register(
    "filt_isnull_count",
    over_catalog("SELECT count(*) AS n_null FROM catalog WHERE original_language IS NULL"),
)
def filt_isnull_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.null_count(fx.catalog(spark, sf_dir, texts=False), "original_language")


@register(
    "filt_dropna_subset",
    over_catalog(
        "SELECT id, poster_path, backdrop_path, original_language FROM catalog"
        " WHERE poster_path IS NOT NULL AND backdrop_path IS NOT NULL"
        " AND original_language IS NOT NULL"
    ),
)
def filt_dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    subset = ["poster_path", "backdrop_path", "original_language"]
    return cols.drop_null_rows(fx.catalog(spark, sf_dir, texts=False), subset).select("id", *subset)


@register(
    "pred_not_in",
    over_catalog(
        "SELECT id, CASE WHEN original_language NOT IN ('NATION_1', 'NATION_2', 'NATION_3')"
        " THEN 1 ELSE 0 END AS other FROM catalog"
    ),
)
def pred_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ["NATION_1", "NATION_2", "NATION_3"]
    return fx.catalog(spark, sf_dir, texts=False).select(
        "id", not_in_flag("original_language", listed).alias("other")
    )


# --- lookups -----------------------------------------------------------------

LOOKUP_SQL = over_catalog(
    f"{fx.NAMES_SQL} SELECT id, array_to_string("
    "list_transform(names, lambda x: coalesce(x, '?')), '|') AS names FROM named"
)


def _names_text(df: DataFrame) -> DataFrame:
    known = F.transform("names", lambda x: F.coalesce(x, F.lit("?")))
    return df.select("id", F.array_join(known, "|").alias("names"))


@register("lookup_array_dim", LOOKUP_SQL)
def lookup_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = fx.catalog(spark, sf_dir, texts=False).select("id", "genre_ids")
    return _names_text(lookup_array_dim(movies, "genre_ids", fx.genre_dim(spark, sf_dir)))


@register("lookup_array_dim_join", LOOKUP_SQL)
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form for a dimension too large to travel with the plan."""
    movies = stage(fx.catalog(spark, sf_dir, texts=False).select("id", "genre_ids"), "genre_ids")
    return _names_text(
        lookup_array_dim(movies, "genre_ids", fx.genre_dim(spark, sf_dir), how="join")
    )


@register(
    "udf_scalar",
    over_catalog(
        f"{fx.NAMES_SQL} SELECT id, len(names) AS n_names,"
        " len(list_filter(names, lambda x: x IS NOT NULL)) AS n_known FROM named"
    ),
)
def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """array<int> to array<string> without a Python worker."""
    movies = fx.catalog(spark, sf_dir, texts=False).select("id", "genre_ids")
    named = lookup_array_dim(movies, "genre_ids", fx.genre_dim(spark, sf_dir))
    return named.select(
        "id",
        F.size("names").cast("long").alias("n_names"),
        F.size(F.array_compact("names")).cast("long").alias("n_known"),
    )


# --- set operations ------------------------------------------------------------


def staged_feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return list(fx.feeds(stage(fx.catalog(spark, sf_dir), "catalog")).values())


@register("set_union_all", over_catalog(f"{FEEDS_SQL} SELECT {MOVIE_SQL} FROM feeds"))
def set_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(union_all(staged_feeds(spark, sf_dir), by="position"))


@register(
    "set_dedup_rows",
    over_catalog(f"{FEEDS_SQL} SELECT {MOVIE_SQL} FROM (SELECT DISTINCT * FROM feeds)"),
)
def set_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(dedup_rows(union_all(staged_feeds(spark, sf_dir))))


@register(
    "set_dedup_stored",
    over_catalog(f"{FEEDS_SQL} SELECT {MOVIE_SQL} FROM (SELECT DISTINCT * FROM feeds)"),
)
def set_dedup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by digests and places; rows are not shuffled."""
    return flat(dedup_stored(staged_feeds(spark, sf_dir)))


@register(
    "set_combine",
    over_catalog(f"{FEEDS_SQL} SELECT {ALL_SQL} FROM (SELECT DISTINCT * FROM feeds)"),
)
def set_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(stage(combine_feeds(staged_feeds(spark, sf_dir)), "all_movies"))


@register(
    "set_distinct_count",
    over_catalog(
        "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT original_language FROM catalog)"
    ),
)
def set_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(fx.catalog(spark, sf_dir, texts=False), "original_language")


# --- scalar functions ------------------------------------------------------------


@register(
    "fn_english_list",
    over_catalog(f"{fx.NAMES_SQL} SELECT id, {fx.SENTENCE_SQL} AS genre_names FROM named"),
)
def fn_english_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = fx.catalog(spark, sf_dir, texts=False).select("id", "genre_ids")
    named = lookup_array_dim(movies, "genre_ids", fx.genre_dim(spark, sf_dir))
    return named.select("id", english_list("names").alias("genre_names"))


@register(
    "fn_date_parts",
    over_catalog(
        f"""{fx.NAMES_SQL} SELECT id, CAST(year(released) AS INTEGER) AS release_year,
        CAST(month(released) AS INTEGER) AS release_month,
        CAST(day(released) AS INTEGER) AS release_day FROM named"""
    ),
)
def fn_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = date_parts("release_date", "release")
    return fx.catalog(spark, sf_dir, texts=False).select("id", *(c.alias(n) for n, c in parts.items()))


@register(
    "fn_bucket_score", over_catalog(f"SELECT id, {fx.SCORE_SQL} AS rating_category FROM catalog")
)
def fn_bucket_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = bucketize("vote_average", SCORE_BOUNDS, SCORE_OTHERWISE)
    return fx.catalog(spark, sf_dir, texts=False).select("id", bucket.alias("rating_category"))


@register(
    "fn_bucket_age",
    over_catalog(
        f"""{fx.NAMES_SQL},
        aged AS (SELECT id, {fx.AGE_SQL} AS movie_age FROM named)
        SELECT id, CASE WHEN movie_age < 10 THEN 'New' WHEN movie_age < 30 THEN 'Modern'
               ELSE 'Classic' END AS age_group FROM aged"""
    ),
)
def fn_bucket_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = fx.catalog(spark, sf_dir, texts=False)
    aged = movies.select("id", age_years("release_date", AS_OF).alias("movie_age"))
    return aged.select("id", age_group().alias("age_group"))


@register(
    "fn_max_normalize",
    "SELECT o_orderkey, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 3)"
    " AS normalized_price FROM orders",
)
def fn_max_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return cols.max_normalize(orders, "o_totalprice", "normalized_price").select(
        "o_orderkey", "normalized_price"
    )


@register(
    "fn_text_length",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM documents",
)
def fn_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text_length("text").alias("text_length")
    )


@register(
    "fn_url_concat",
    over_catalog(
        f"SELECT id, '{IMAGES}' || poster_path AS poster_url,"
        f" '{IMAGES}' || backdrop_path AS backdrop_url FROM catalog"
    ),
)
def fn_url_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.catalog(spark, sf_dir, texts=False).select(
        "id",
        prefixed(IMAGES, "poster_path").alias("poster_url"),
        prefixed(IMAGES, "backdrop_path").alias("backdrop_url"),
    )


@register(
    "fn_neq_flag",
    over_catalog(
        "SELECT id, CASE WHEN title <> original_title THEN 1 ELSE 0 END AS differs FROM catalog"
    ),
)
def fn_neq_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.catalog(spark, sf_dir, texts=False).select(
        "id", differs_flag("title", "original_title").alias("differs")
    )


@register(
    "fn_age_years", over_catalog(f"{fx.NAMES_SQL} SELECT id, {fx.AGE_SQL} AS movie_age FROM named")
)
def fn_age_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.catalog(spark, sf_dir, texts=False).select(
        "id", age_years("release_date", AS_OF).alias("movie_age")
    )


@register("fn_round", "SELECT event_id, round(value, 3) AS value_3, round(value, 2) AS value_2 FROM events")
def fn_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.round("value", 3).alias("value_3"), F.round("value", 2).alias("value_2")
    )


@register(
    "feat_movies_processed",
    fx.over_processed(
        "SELECT * REPLACE (array_to_string(genre_ids, ',') AS genre_ids) FROM processed"
    ),
)
def feat_movies_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(fx.processed_full(spark, sf_dir))


# --- aggregates --------------------------------------------------------------------


@register("agg_count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def agg_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.count_rows(table(spark, sf_dir, "lineitem"))


@register(
    "agg_group_count",
    'SELECT l_suppkey, count(*) AS "count" FROM lineitem GROUP BY l_suppkey',
)
def agg_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.group_count(table(spark, sf_dir, "lineitem"), "l_suppkey")


@register(
    "agg_group_avg",
    "SELECT l_returnflag, round(avg(l_quantity), 3) AS avg_quantity FROM lineitem GROUP BY l_returnflag",
)
def agg_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    measures = {"avg_quantity": ("avg", "l_quantity")}
    return agg.group_agg(lines, "l_returnflag", measures, digits=3, sort_by="avg_quantity")


@register(
    "agg_group_sum",
    "SELECT l_orderkey, sum(l_quantity) AS sum_quantity FROM lineitem GROUP BY l_orderkey",
)
def agg_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return agg.group_agg(lines, "l_orderkey", {"sum_quantity": ("sum", "l_quantity")})


@register(
    "agg_group_multi",
    "SELECT l_suppkey, round(avg(l_quantity), 3) AS avg_quantity,"
    " round(avg(l_discount), 3) AS avg_discount, max(l_tax) AS max_tax,"
    " count(l_orderkey) AS n FROM lineitem GROUP BY l_suppkey",
)
def agg_group_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "avg_quantity": ("avg", "l_quantity"),
        "avg_discount": ("avg", "l_discount"),
        "max_tax": ("max", "l_tax"),
        "n": ("count", "l_orderkey"),
    }
    return agg.group_agg(table(spark, sf_dir, "lineitem"), "l_suppkey", measures, digits=3)


@register("agg_global_max", "SELECT max(l_extendedprice) AS max_l_extendedprice FROM lineitem")
def agg_global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.global_max(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@register(
    "agg_null_profile",
    over_catalog(
        "SELECT "
        + ", ".join(f"count(*) - count({f.name}) AS {f.name}" for f in WIDE_MOVIE.fields)
        + " FROM catalog"
    ),
)
def agg_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.null_profile(fx.catalog(spark, sf_dir))


def describe_sql(columns: list[str], source: str, quartiles: bool = False, digits: int = 4) -> str:
    q = "".join(
        f", round(CAST(quantile_disc({{c}}, {p}) AS DOUBLE), {digits}) AS p{int(p * 100)}"
        for p in (0.25, 0.5, 0.75)
    )
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), {digits}) AS mean,"
        f" round(stddev_samp({c}), {digits}) AS stddev,"
        f" round(CAST(min({c}) AS DOUBLE), {digits}) AS min,"
        f" round(CAST(max({c}) AS DOUBLE), {digits}) AS max"
        + (q.format(c=c) if quartiles else "")
        + f" FROM {source}"
        for c in columns
    )


LINE_NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("agg_describe", describe_sql(LINE_NUMBERS, "lineitem"))
def agg_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prof.describe(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), 4)


SUMMARIZED = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


@register("agg_summary", describe_sql(SUMMARIZED, "lineitem", quartiles=True))
def agg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prof.summary(table(spark, sf_dir, "lineitem"), SUMMARIZED, accuracy=None), 4)


@register("agg_summary_default", describe_sql(LINE_NUMBERS, "lineitem", quartiles=True))
def agg_summary_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``summary`` is called without further arguments: quartiles by sketches.

    The SQL has the quartiles themselves: a column with few values has a value at every rank
    within the sketch's error, and up to 65,535 rows the sketch keeps all values.
    """
    return rounded(prof.summary(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), 4)


@register(
    "agg_summary_rank_error",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", 'p{p}' AS quartile, count({c}) AS known, true AS within"
        f" FROM lineitem"
        for c in LINE_NUMBERS
        for p in (25, 50, 75)
    ),
)
def agg_summary_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranks that the default quartiles really have: counted over the whole table."""
    lines = table(spark, sf_dir, "lineitem")
    return prof.rank_errors(lines, prof.summary(lines, LINE_NUMBERS)).select(
        "column", "quartile", "known", (F.col("error") <= 1 / 10_000).alias("within")
    )


@register(
    "agg_corr",
    """SELECT round(corr(coalesce(quality, 0), coalesce(toxic, 0)), 6) AS zero,
       round(corr(quality, toxic), 6) AS skip
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def agg_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways to treat NULLs; documents without a label have them."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(
        labelled.agg(
            prof.pearson("quality", "toxic", "zero").alias("zero"),
            prof.pearson("quality", "toxic", "skip").alias("skip"),
        )
    )


@register("agg_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def agg_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.shape(table(spark, sf_dir, "lineitem"))


@register(
    "agg_schema_profile",
    over_catalog(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type,"
            f" count({f.name}) AS non_null FROM catalog"
            for f in WIDE_MOVIE.fields
        )
    ),
)
def agg_schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.schema_profile(fx.catalog(spark, sf_dir))


# --- order and top-k -----------------------------------------------------------------


@register(
    "sort_desc",
    "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey",
)
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spent(spark, sf_dir, ascending=False)


@register(
    "sort_asc",
    "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey",
)
def sort_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spent(spark, sf_dir, ascending=True)


def _spent(spark: SparkSession, sf_dir: str, ascending: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    spent = agg.group_agg(orders, "o_custkey", {"spent": ("sum", "o_totalprice")})
    return agg.order_rows(rounded(spent, 2), "spent", ["o_custkey"], ascending)


@register(
    "topk_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100",
)
def topk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return agg.top_rows(orders, "o_totalprice", 100, ["o_orderkey"])


@register(
    "topk_categories",
    over_catalog(
        """SELECT rank, original_language, n FROM (
             SELECT original_language, count(*) AS n, CAST(row_number() OVER (
               ORDER BY count(*) DESC, original_language NULLS LAST) AS INTEGER) AS rank
             FROM catalog GROUP BY original_language)
           WHERE rank <= 5 AND original_language IS NOT NULL"""
    ),
)
def topk_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_values(fx.catalog(spark, sf_dir, texts=False), "original_language", 5)


@register(
    "preview_rows", "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 20"
)
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return agg.preview_rows(customers, 20, ["c_custkey"])
