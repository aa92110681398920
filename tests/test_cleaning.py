"""Edge rows of the cleaning rules."""

import pytest

from pyspark.sql import functions as F

from reelhouse.functions import movies as movie_fn
from reelhouse.plans import bronze, gold, silver
from reelhouse.schemas import MOVIES_CSV, RATINGS_CSV, TAGS_CSV
from reelhouse.sources import csv_files
from tests.conftest import rows_of


@pytest.mark.parametrize(
    "title, year, clean",
    [
        ("Toy Story (1995)", 1995, "Toy Story"),
        ("No Year", None, ""),
        ("Trailing (1990) ", None, ""),
        ("", None, ""),
        (None, None, None),
        ("Twice (1990) (2001)", 2001, "Twice (1990)"),
    ],
)
def test_title(spark, title, year, clean):
    df = spark.createDataFrame([(title,)], "title string").select(
        movie_fn.release_year(F.col("title")), movie_fn.clean_title(F.col("title"))
    )
    assert rows_of(df) == [(year, clean)]


def test_recent_is_three_valued(spark):
    movies = spark.createDataFrame(
        [(1, "A (2018)", "X"), (2, "B (2019)", "X"), (3, "C", "X"), (None, "D (2020)", "X")],
        MOVIES_CSV,
    )
    got = silver.clean_movies(movies).orderBy("movieId").select("movieId", "is_recent", "decade")
    assert rows_of(got) == [(1, False, 2010), (2, True, 2010), (3, None, None)]


def test_latest_ingested_movie_wins(spark):
    rows = spark.createDataFrame(
        [(1, "Old (1990)", "A", "2024-01-01"), (1, "New (1991)", "B", "2024-01-02")],
        "movieId int, title string, genres string, ingestion_timestamp string",
    )
    assert rows_of(silver.clean_movies(rows).select("title_clean")) == [("New",)]


def test_rating_range_and_dedupe(spark):
    rows = [(1, i, r, 0) for i, r in enumerate([0.0, 0.5, 5.0, 5.5, None])]
    rows += [(2, 1, 3.0, 7), (2, 1, 4.0, 7), (2, 1, 2.0, 8), (None, 1, 3.0, 0), (3, None, 3.0, 0)]
    # The winner of a key is chosen before the range is checked.
    rows += [(4, 1, 4.0, 9), (4, 1, 9.0, 9)]
    got = silver.clean_ratings(spark.createDataFrame(rows, RATINGS_CSV))
    assert sorted(rows_of(got.select("userId", "movieId", "rating", "timestamp"))) == [
        (1, 1, 0.5, 0),
        (1, 2, 5.0, 0),
        (2, 1, 2.0, 8),
        (2, 1, 4.0, 7),
    ]
    scaled = {r.rating: r.rating_normalized for r in got.collect()}
    assert scaled[0.5] == 0.0 and scaled[5.0] == 1.0


def test_tags_fold_on_raw_text_only(spark):
    tags = ["Fun", " fun ", "FUN", "FUN", "   ", "", None]
    df = spark.createDataFrame([(1, 1, t, i) for i, t in enumerate(tags)], TAGS_CSV)
    assert sorted(rows_of(silver.clean_tags(df))) == [
        (1, 1, "fun", 0),
        (1, 1, "fun", 1),
        (1, 1, "fun", 2),
    ]


def test_unknown_movie_stays_but_has_no_genre_stats(spark):
    movies = silver.clean_movies(
        spark.createDataFrame(
            [(1, "A (1994)", "X|Y"), (2, "B (1995)", "(no genres listed)")], MOVIES_CSV
        )
    )
    ratings = silver.clean_ratings(
        spark.createDataFrame(
            [(1, 1, 4.0, 0), (2, 1, 3.5, 0), (1, 2, 2.0, 0), (1, 9, 5.0, 0)], RATINGS_CSV
        )
    )
    enriched = silver.enrich_ratings(ratings, movies)
    unknown = enriched.filter("movieId = 9").select("title_clean", "genres", "decade")
    assert rows_of(unknown) == [(None, None, None)]
    assert sorted(rows_of(gold.genre_decade_stats(enriched))) == [
        ("(no genres listed)", 1990, 2.0, 1),
        ("X", 1990, 3.75, 2),
        ("Y", 1990, 3.75, 2),
    ]


def test_batch_of_undated_rating(spark):
    rows = [(1, 1, 3.0, 1_500_000_000), (1, 1, 3.0, 1_600_000_000), (1, 1, 3.0, None)]
    got = bronze.split_ratings(spark.createDataFrame(rows, RATINGS_CSV))
    assert [r.batch_id for r in got.collect()] == ["lote_1_<=2018", "lote_2_>2018", "undated"]


@pytest.fixture
def files(tmp_path):
    (tmp_path / "movies.csv").write_text(
        "movieId,title,genres\n"
        '1,"""Great Performances"" Cats (1998)",Musical\n'
        '2,"A, B (2001)",Drama|Comedy\n'
    )
    (tmp_path / "ratings.csv").write_text(
        "userId,movieId,rating,timestamp\nx,2,bad,100\n1,2\n3,4,4.5,100\n"
    )
    return tmp_path


def test_quoted_titles(spark, files):
    movies = csv_files.read_movies(spark, str(files / "movies.csv"))
    got = silver.clean_movies(movies).orderBy("movieId").select("title_clean", "release_year")
    assert rows_of(got) == [('"Great Performances" Cats', 1998), ("A, B", 2001)]
    legacy = csv_files.read_csv(spark, str(files / "movies.csv"), MOVIES_CSV, escape="\\")
    first = silver.clean_movies(legacy).filter("movieId = 1").select("release_year")
    assert rows_of(first) == [(None,)]


def test_malformed_cells_become_null(spark, files):
    ratings = csv_files.read_ratings(spark, str(files / "ratings.csv"))
    assert sorted(rows_of(ratings), key=str) == sorted(
        [(None, 2, None, 100), (1, 2, None, None), (3, 4, 4.5, 100)], key=str
    )


def test_provenance(spark, files):
    rows = csv_files.with_provenance(
        csv_files.read_ratings(spark, str(files / "ratings.csv")), "b1"
    ).collect()
    assert {r.batch_id for r in rows} == {"b1"}
    assert all(r.source_file.endswith("ratings.csv") for r in rows)
    assert all(r.ingestion_timestamp is not None for r in rows)


def test_recommendation_import(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("User ID,MovieId,extra,Prediction\n1,2,x,3.5\n")
    got = csv_files.read_recommendations(spark, str(tmp_path / "ok.csv"))
    assert got.columns == ["user_id", "movie_id", "predicted_score"]
    assert rows_of(got) == [(1, 2, 3.5)]
    (tmp_path / "bad.csv").write_text("user_id,movie,score\n1,2,3.5\n")
    with pytest.raises(ValueError, match="movie_id"):
        csv_files.read_recommendations(spark, str(tmp_path / "bad.csv"))


def test_single_file_export(spark, tmp_path):
    df = spark.range(100, numPartitions=4).selectExpr("id as userId")
    csv_files.write_csv(df, str(tmp_path / "out"), single_file=True)
    parts = list((tmp_path / "out").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().startswith("userId\n")
