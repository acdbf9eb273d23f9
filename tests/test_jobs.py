"""Landed pages to bronze, silver and back; properties of the composed jobs."""

from __future__ import annotations

import json

import pytest

from marquee.lake import LakePaths
from marquee.plans import eda
from marquee.plans.combine import SILVER_ALL, build_all_movies, combine_feeds
from marquee.operators.profile import null_profile
from marquee.plans.features import SILVER_PROCESSED, build_movies_processed, engineer_features, processed_nulls
from marquee.plans.ingest import (
    FEED_TABLES,
    FEEDS,
    PARITY_FEEDS,
    Feed,
    ingest_feed,
    ingest_genres,
)
from marquee.schemas import MOVIE, page_schema
from marquee.sources.pages import read_genres, read_movie_pages, read_pages
from marquee.sources.tables import read_table, write_table


def movie(i, **changes):
    record = {
        "adult": False,
        "backdrop_path": None,
        "genre_ids": [1, 2],
        "id": i,
        "original_language": "en",
        "original_title": f"T{i}",
        "overview": "text",
        "popularity": float(i),
        "poster_path": f"/{i}.jpg",
        "release_date": "2001-02-03",
        "title": f"T{i}",
        "video": False,
        "vote_average": 7,
        "vote_count": 10,
    }
    return record | changes


def land(folder, pages):
    folder.mkdir(parents=True)
    lines = [p if isinstance(p, str) else json.dumps(p) for p in pages]
    (folder / "pages.json").write_text("\n".join(lines) + "\n")
    return str(folder)


def page(number, movies, total=3):
    return {"page": number, "total_pages": total, "results": movies}


def test_pages_to_typed_rows(spark, tmp_path):
    path = land(tmp_path / "feed", [page(1, [movie(1), movie(2)]), page(2, [movie(3)]), ""])
    rows = read_movie_pages(spark, path)
    assert rows.schema == MOVIE
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    assert rows.first()["vote_average"] == 7.0


def test_page_cap(spark, tmp_path):
    path = land(tmp_path / "feed", [page(n, [movie(n)], 900) for n in (1, 499, 500, 501)])
    assert sorted(r["id"] for r in read_movie_pages(spark, path, max_pages=500).collect()) == [1, 499, 500]
    assert read_movie_pages(spark, path).count() == 4
    assert read_movie_pages(spark, path, max_pages=1).count() == 1


def test_bad_pages_are_kept_apart(spark, tmp_path):
    refused = {"success": False, "status_message": "Invalid key"}
    wrong_type = page(4, [movie(9, genre_ids="none")])
    path = land(tmp_path / "feed", [page(1, [movie(1)]), '{"page": 2, "resu', refused, wrong_type])
    good, bad = read_pages(spark, path, page_schema())
    assert [r["page"] for r in good.collect()] == [1]
    assert bad.count() == 3
    assert '{"page": 2, "resu' in [r["value"] for r in bad.collect()]
    assert read_movie_pages(spark, path).count() == 1


def test_one_page_per_file(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    for n in (1, 2):
        (folder / f"{n}.json").write_text(json.dumps(page(n, [movie(n)]), indent=2))
    assert read_movie_pages(spark, str(folder), page_per_file=True).count() == 2


def test_genres(spark, tmp_path):
    path = land(tmp_path / "genres", [{"genres": [{"id": 1, "name": "Drama"}, {"id": 2, "name": "War"}]}])
    genres = read_genres(spark, path)
    assert {tuple(r) for r in genres.good.collect()} == {(1, "Drama"), (2, "War")}
    assert genres.bad.count() == 0


def test_bad_genre_envelopes_are_kept(spark, tmp_path):
    whole = {"genres": [{"id": 1, "name": "Drama"}]}
    bad_id = {"genres": [{"id": "?", "name": "War"}, {"id": 3, "name": "Crime"}]}
    landing = land(tmp_path / "genres", [whole, '{"genres": [{"id": 4', bad_id])
    lake = LakePaths(str(tmp_path / "lake"))
    ingest_genres(spark, landing, lake)
    assert [tuple(r) for r in read_table(spark, lake.bronze("movie_genres")).collect()] == [(1, "Drama")]
    kept = {r["value"] for r in read_table(spark, lake.bronze("movie_genres_quarantine")).collect()}
    assert kept == {'{"genres": [{"id": 4', json.dumps(bad_id)}


def test_a_long_feed_arrives_whole(spark, tmp_path):
    landing = land(tmp_path / "feed", [page(n, [movie(n)], 900) for n in range(1, 901)])
    lake = LakePaths(str(tmp_path / "lake"))
    ingest_feed(spark, landing, lake, Feed("popular_movies"))
    assert read_table(spark, lake.bronze("popular_movies")).count() == 900


def test_overwrite_and_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    write_table(spark.range(3).selectExpr("id", "id % 2 AS p"), path, partition_by=["p"])
    assert read_table(spark, path).count() == 3
    assert (tmp_path / "t" / "p=0").is_dir()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    feeds = {
        "popular_movies": [page(1, [movie(1), movie(2)]), page(1, [movie(1), movie(2)])],
        "top_rated_movies": [page(1, [movie(2), movie(3, title="Other")]), "{broken"],
        "upcoming_movies": [page(1, [movie(4, release_date="", genre_ids=[])])],
        "present_movies": [page(1, [movie(1, popularity=9.0), movie(5, genre_ids=[2, 77])])],
    }
    paths = LakePaths(str(root / "lake"))
    for feed in FEEDS:
        ingest_feed(spark, land(root / feed.table, feeds[feed.table]), paths, feed)
    ingest_genres(
        spark,
        land(root / "genres", [{"genres": [{"id": 1, "name": "Drama"}, {"id": 2, "name": "War"}]}]),
        paths,
    )
    build_all_movies(spark, paths)
    build_movies_processed(spark, paths, "https://host/w500", as_of="2011-02-03")
    return paths


def test_quarantine_is_stored(spark, lake):
    bad = spark.read.parquet(lake.bronze("top_rated_movies_quarantine"))
    assert [r["value"] for r in bad.collect()] == ["{broken"]


def test_silver_drops_copies_and_keeps_changed_rows(spark, lake):
    silver = spark.read.parquet(lake.silver(SILVER_ALL))
    assert len(silver.columns) == 12
    assert sorted((r["id"], r["popularity"]) for r in silver.collect()) == [
        (1, 1.0),
        (1, 9.0),
        (2, 2.0),
        (3, 3.0),
        (4, 4.0),
        (5, 5.0),
    ]


def test_processed_table(spark, lake):
    rows = {
        (r["id"], r["popularity"]): r
        for r in spark.read.parquet(lake.silver(SILVER_PROCESSED)).collect()
    }
    first = rows[1, 9.0]
    assert len(first) == 23
    assert first["genre_names"] == "Drama and War"
    assert first["normalized_popularity"] == 1.0
    assert (first["release_year"], first["release_month"], first["release_day"]) == (2001, 2, 3)
    assert first["movie_age"] == 10.01
    assert first["rating_category"] == "Medium"
    assert first["poster_url"] == "https://host/w500/1.jpg"
    assert first["backdrop_url"] == "https://host/w500/no_image.jpg"
    assert first["overview_length"] == 4
    assert first["is_remake"] is False
    assert rows[3, 3.0]["is_remake"] is True
    assert rows[4, 4.0]["genre_names"] is None
    assert rows[4, 4.0]["release_year"] is None and rows[4, 4.0]["movie_age"] is None
    assert rows[5, 5.0]["genre_names"] is None


def test_combine_ignores_feed_order_and_repeats(spark, lake):
    feeds = [spark.read.parquet(lake.bronze(t)) for t in FEED_TABLES]
    once = {str(r) for r in combine_feeds(feeds).collect()}
    assert {str(r) for r in combine_feeds(feeds[::-1]).collect()} == once
    assert {str(r) for r in combine_feeds(feeds + feeds).collect()} == once


def test_nulls_follow_from_the_sources(spark):
    """The predicates over the source columns against the derived columns themselves."""
    odd = [
        movie(1),
        movie(2, genre_ids=[], release_date="", overview=None),
        movie(3, genre_ids=None, release_date="no date", poster_path=None),
        movie(4, genre_ids=[1, 99], original_language=None, popularity=None, vote_average=None),
        movie(5, genre_ids=[99], title=None, release_date=None),
        movie(6, genre_ids=[99, 1], backdrop_path="/b.jpg"),
    ]
    genres = spark.createDataFrame([(1, "Drama"), (2, "Crime")], "id int, name string")
    for rows in (odd, odd[:1], [movie(7, popularity=0.0)], [movie(8, popularity=None)], []):
        rows = [r | {"vote_average": r["vote_average"] and 7.0} for r in rows]
        movies = spark.createDataFrame([tuple(r[f.name] for f in MOVIE.fields) for r in rows], MOVIE)
        for lookup in ("map", "join"):
            derived = null_profile(engineer_features(movies, genres, "http://i", "2020-01-01", lookup))
            found = processed_nulls(movies, genres, lookup)
            assert found.columns == derived.columns
            assert found.first() == derived.first()


def test_two_sentinels_defeat_the_dedup(spark, tmp_path):
    """Why one sentinel is the default: the same movie survives twice."""
    lake = LakePaths(str(tmp_path / "lake"))
    pair = [f for f in PARITY_FEEDS if f.table in ("popular_movies", "top_rated_movies")]
    for feed in pair:
        ingest_feed(spark, land(tmp_path / feed.table, [page(1, [movie(1)])]), lake, feed)
    feeds = [spark.read.parquet(lake.bronze(f.table)) for f in pair]
    assert combine_feeds(feeds).count() == 2


def test_feed_cap_reaches_bronze(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    landing = land(tmp_path / "f", [page(1, [movie(1)]), page(2, [movie(2)])])
    ingest_feed(spark, landing, lake, Feed("popular_movies", max_pages=1))
    assert spark.read.parquet(lake.bronze("popular_movies")).count() == 1


def test_questions_on_the_stored_table(spark, lake):
    movies = spark.read.parquet(lake.silver(SILVER_PROCESSED))
    assert eda.sql_view_all(movies).count() == 6
    assert spark.table("movies").count() == 6
    assert eda.hidden_gems(movies, 6.0, 0.4).count() == 3
    assert eda.top_performers(movies, 0.8).collect()[0]["count"] == 5
    single = eda.genre_single_counts(movies, spark.read.parquet(lake.bronze("movie_genres")))
    assert {r["genre"]: r["count"] for r in single.collect()} == {"War": 5, "Drama": 4, None: 1}
