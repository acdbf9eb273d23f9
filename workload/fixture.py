"""The driver tables in the shape of a movie catalogue, for Spark and for DuckDB.

One row per order that has line items; ``nation`` is the genre dimension.
Both forms must stay equal: the Spark form feeds the queries, the SQL form
opens every oracle string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators.columns import max_normalize
from marquee.plans.features import engineer_features
from marquee.session import stage
from marquee.sources.tables import read_table

IMAGES = "https://image.example.org/posters"
AS_OF = "2006-01-01"
#: The feeds overlap, and together hold every movie.
FEED_RULES = {
    "popular": "id % 2 = 0",
    "top_rated": "id % 2 = 1",
    "upcoming": "id % 5 = 0",
    "present": "id % 7 = 0",
}
PAGE_ROWS = 20


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footers are read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return read_table(spark, path, _schemas[path])


def catalog(spark: SparkSession, sf_dir: str, texts: bool | str = True) -> DataFrame:
    """Fourteen movie columns, lazily; unused ones are pruned down to the scans.

    Sides are left for Spark to size: at scale neither supplier nor part nor
    customer is a broadcast side.  Order keys need 64 bits there.  The three
    inputs keyed by order meet first, on one partitioning.  Without ``texts``
    overviews are NULL and no document is read; with ``"known"`` they are empty
    where there is one, so that no text takes part in a join.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    # Customers meet the four columns of orders, before lines, titles and texts are there to be moved.
    homes = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )

    lines = (
        lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            F.array_sort(F.collect_set("s_nationkey")).alias("nat_ids"),
            (F.avg("l_quantity") / 5).alias("vote_average"),
            F.sum("l_quantity").cast("long").alias("vote_count"),
            F.min("p_name").alias("title"),
            F.max("p_name").alias("original_title"),
        )
    )
    key = F.col("o_orderkey")
    text_key = key.cast("string")
    no_ids = F.array().cast("array<int>")
    keyed = homes.select("o_orderkey", "o_totalprice", "o_orderdate", "n_name").join(
        lines, key == F.col("l_orderkey")
    )
    if texts:
        text = F.when(F.col("text").isNotNull(), F.lit("")).alias("text") if texts == "known" else "text"
        documents = table(spark, sf_dir, "documents").select("doc_id", text)
        keyed = keyed.join(documents, F.col("doc_id") == key, "left")
    else:
        keyed = keyed.withColumn("text", F.lit(None).cast("string"))
    return (
        keyed.select(
            F.lit(False).alias("adult"),
            F.when(key % 31 != 0, F.concat(F.lit("/b"), text_key, F.lit(".jpg"))).alias(
                "backdrop_path"
            ),
            F.when(key % 17 == 0, no_ids)
            .when(key % 13 == 0, F.array_append("nat_ids", F.lit(99)))
            .otherwise(F.col("nat_ids"))
            .alias("genre_ids"),
            key.alias("id"),
            F.when(key % 29 != 0, F.col("n_name")).alias("original_language"),
            "original_title",
            F.col("text").alias("overview"),
            F.col("o_totalprice").alias("popularity"),
            F.when(key % 19 != 0, F.concat(F.lit("/"), text_key, F.lit(".jpg"))).alias(
                "poster_path"
            ),
            F.when(key % 23 == 0, F.lit(""))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
            .alias("release_date"),
            "title",
            F.lit(False).alias("video"),
            "vote_average",
            "vote_count",
        )
    )


def genre_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
    )


def all_movies(spark: SparkSession, sf_dir: str, texts: bool | str = True) -> DataFrame:
    return catalog(spark, sf_dir, texts).drop("adult", "video")


def processed(
    spark: SparkSession, sf_dir: str, source: DataFrame | None = None, texts: bool = True
) -> DataFrame:
    """The 23-column table as one lazy plan."""
    movies = all_movies(spark, sf_dir, texts) if source is None else source
    return engineer_features(movies, genre_dim(spark, sf_dir), IMAGES, AS_OF)


def processed_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a staged catalogue: the normalised popularity needs its
    maximum, a second read, and the catalogue's joins should run once."""
    return processed(spark, sf_dir, stage(all_movies(spark, sf_dir), "catalog"))


def processed_narrow(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Some processed columns and the normalised popularity, staging no more
    than these: texts, for one, only as their lengths."""
    texts = any(c.startswith("overview") for c in columns)
    rows = processed(spark, sf_dir, texts=texts).select(*columns, "popularity")
    narrow = max_normalize(stage(rows, "processed"), "popularity", "normalized_popularity")
    return narrow.drop("popularity")


def feeds(source: DataFrame) -> dict[str, DataFrame]:
    """Four overlapping lists; one holds a later snapshot of its movies."""
    lists = {name: source.filter(rule) for name, rule in FEED_RULES.items()}
    lists["present"] = lists["present"].withColumn("popularity", F.col("popularity") + 1)
    return lists


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as JSON pages of twenty ids: page 1 twice, and beside
    every fiftieth page a truncated copy.

    Ids are the orders' primary key, so no page outgrows its id range.
    """
    movies = catalog(spark, sf_dir)
    number = F.expr(f"id div {PAGE_ROWS} + 1")
    last = table(spark, sf_dir, "orders").agg(F.expr(f"max(o_orderkey) div {PAGE_ROWS} + 1"))
    total = last.scalar()
    pages = (
        movies.groupBy(number.alias("page"))
        .agg(F.collect_list(F.struct(*movies.columns)).alias("results"))
        .select("page", F.to_json(F.struct("page", total.alias("total_pages"), "results")).alias("body"))
    )
    half = F.substring("body", F.lit(1), (F.length("body") / 2).cast("int"))
    copies = F.array_compact(
        F.array(
            F.col("body"),
            F.when(F.col("page") == 1, F.col("body")),
            F.when(F.col("page") % 50 == 7, half),
        )
    )
    return pages.select(F.explode(copies).alias("value"))


# --- the same for DuckDB -------------------------------------------------

LINE_STATS_SQL = """
texts AS (SELECT doc_id, max(text) AS text FROM documents GROUP BY doc_id),
line_stats AS (
  SELECT l_orderkey, list_sort(list(DISTINCT s_nationkey)) AS nat_ids,
         avg(l_quantity) / 5 AS vote_average, CAST(sum(l_quantity) AS BIGINT) AS vote_count,
         min(p_name) AS title, max(p_name) AS original_title
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey)"""

CATALOG_SQL = (
    LINE_STATS_SQL
    + """,
catalog AS (
  SELECT false AS adult,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE concat('/b', CAST(o_orderkey AS VARCHAR), '.jpg') END AS backdrop_path,
    CASE WHEN o_orderkey % 17 = 0 THEN CAST([] AS INT[])
         WHEN o_orderkey % 13 = 0 THEN list_append(nat_ids, 99) ELSE nat_ids END AS genre_ids,
    o_orderkey AS id,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE n_name END AS original_language,
    original_title, text AS overview, o_totalprice AS popularity,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('/', CAST(o_orderkey AS VARCHAR), '.jpg') END AS poster_path,
    CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS release_date,
    title, false AS video, vote_average, vote_count
  FROM orders JOIN line_stats ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN texts ON doc_id = o_orderkey)"""
)

NAMES_SQL = """,
genre_names_of AS (SELECT map_from_entries(list((n_nationkey, n_name))) AS m FROM nation),
named AS (
  SELECT c.*, list_transform(genre_ids, lambda x: m[x]) AS names,
         try_cast(release_date AS DATE) AS released
  FROM catalog c CROSS JOIN genre_names_of)"""

SENTENCE_SQL = (
    "CASE WHEN len(names) > 1 THEN array_to_string(names[1:len(names) - 1], ', ')"
    " || ' and ' || names[len(names)] ELSE names[1] END"
)
SCORE_SQL = "CASE WHEN vote_average >= 8 THEN 'High' WHEN vote_average >= 5 THEN 'Medium' ELSE 'Low' END"
AGE_SQL = f"round(date_diff('day', released, DATE '{AS_OF}') / 365, 2)"

PROCESSED_SQL = (
    CATALOG_SQL
    + NAMES_SQL
    + f""",
processed AS (
  SELECT backdrop_path, genre_ids, id, original_language, original_title, overview, popularity,
    poster_path, release_date, title, vote_average, vote_count,
    {SENTENCE_SQL} AS genre_names,
    CAST(year(released) AS INTEGER) AS release_year,
    CAST(month(released) AS INTEGER) AS release_month,
    CAST(day(released) AS INTEGER) AS release_day,
    {SCORE_SQL} AS rating_category,
    round(popularity / (SELECT max(popularity) FROM catalog), 3) AS normalized_popularity,
    CAST(length(overview) AS INTEGER) AS overview_length,
    '{IMAGES}' || poster_path AS poster_url,
    '{IMAGES}' || backdrop_path AS backdrop_url,
    coalesce(title <> original_title, false) AS is_remake,
    {AGE_SQL} AS movie_age
  FROM named)"""
)


def over_catalog(body: str) -> str:
    return f"WITH {CATALOG_SQL.strip()}\n{body.strip()}"


def over_processed(body: str) -> str:
    return f"WITH {PROCESSED_SQL.strip()}\n{body.strip()}"
