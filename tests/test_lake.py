"""Versioned tables and the pipeline over them."""

import pytest

from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import quality
from reelhouse.plans import replicas
from reelhouse.plans.lakehouse import Lakehouse
from reelhouse.session import new_work_path
from reelhouse.sources import csv_files
from reelhouse.sources.lake import LakeTable
from tests.conftest import rows_of

SCHEMA = schemas._struct(k=schemas.INT, batch_id=schemas.STRING)


def rows(spark, first, last, batch="b"):
    return spark.range(first, last).select(
        F.lit(batch).alias("batch_id"), F.col("id").cast("int").alias("k")
    )


@pytest.fixture
def table(spark):
    return LakeTable(spark, new_work_path(spark, "t"), SCHEMA, ["batch_id"])


def log_of(table):
    return rows_of(
        table.snapshots()
        .orderBy("seq")
        .select("seq", "operation", "batch_id", "added_rows", "total_rows")
    )


def test_versions(spark, table):
    table.append(rows(spark, 0, 5), "b")
    table.append(rows(spark, 5, 8, "c"), "c")
    table.delete_all()
    table.append(rows(spark, 100, 102), "b")
    table.overwrite(rows(spark, 0, 1), "b")
    assert log_of(table) == [
        (1, "append", "b", 5, 5),
        (2, "append", "c", 3, 8),
        (3, "delete", "", 0, 0),
        (4, "append", "b", 2, 2),
        (5, "overwrite", "b", 1, 1),
    ]
    assert [table.as_of(s).count() for s in range(1, 6)] == [5, 8, 0, 2, 1]
    assert rows_of(table.read()) == [(0, "b")]
    assert table.as_of(3).columns == ["k", "batch_id"]
    with pytest.raises(ValueError):
        table.as_of(9)


def test_rows_of_a_commit_that_was_never_logged_stay_invisible(spark, table):
    table.append(rows(spark, 0, 5), "b")
    table._write(rows(spark, 5, 9), [F.count("*")], "data/commit_id=dead", [])
    assert table.read().count() == 5


def test_one_pass_over_several_batches(spark, table):
    both = rows(spark, 0, 3, "a").unionByName(rows(spark, 3, 7, "b"))
    table.append_batches(both, ["a", "b", "empty"], overflow="rest")
    assert log_of(table) == [
        (1, "append", "a", 3, 3),
        (2, "append", "b", 4, 7),
        (3, "append", "empty", 0, 7),
    ]
    table.append_batches(rows(spark, 0, 2, "rest"), ["a"], overflow="rest")
    assert log_of(table)[-1] == (5, "append", "rest", 2, 9)
    with pytest.raises(Exception, match="unlisted batch"):
        table.append_batches(rows(spark, 0, 1, "other"), ["a"], overflow="rest")
    assert table.read().count() == 9


def test_reading_prunes_to_the_partition(spark, table):
    table.append(rows(spark, 0, 5, "a").unionByName(rows(spark, 0, 5, "b")), "x")
    scan = table.read().filter("batch_id = 'a'")
    assert scan.count() == 5
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


@pytest.fixture(scope="module")
def house(spark, sample):
    files = new_work_path(spark, "in")
    csv_files.write_csv(sample.ratings_raw(), f"{files}/ratings")
    csv_files.write_csv(sample.movies_raw(), f"{files}/movies")
    csv_files.write_csv(sample.tags_raw(), f"{files}/tags")
    inputs = (
        csv_files.read_ratings(spark, f"{files}/ratings"),
        csv_files.read_movies(spark, f"{files}/movies"),
        csv_files.read_tags(spark, f"{files}/tags"),
    )
    house = Lakehouse(spark, new_work_path(spark, "house"))
    assert not house.gold_ready()
    house.run(*inputs, 1998)
    return house, inputs


TABLES = [
    "bronze_ratings",
    "bronze_movies",
    "bronze_tags",
    "movies",
    "ratings",
    "tags",
    "recommendations",
    "genre_decade",
    "distribution",
]


def test_run_again_changes_nothing(house):
    lake, inputs = house
    before = {t: getattr(lake, t).read().count() for t in TABLES}
    first_load = lake.bronze_ratings.as_of(3).count()
    lake.run(*inputs, 1998)
    assert {t: getattr(lake, t).read().count() for t in TABLES} == before
    # The cleared version of the first run is still readable.
    assert lake.bronze_ratings.as_of(3).count() == first_load == before["bronze_ratings"]
    assert lake.gold_ready()


def test_input_rows_are_counted_while_reading(house):
    lake, inputs = house
    rows = lake.ingest(*inputs, 1998)
    assert rows == inputs[0].count() == lake.bronze_ratings.read().count()
    with pytest.raises(quality.QualityError, match="bronze_rows_equal_input=1"):
        lake.check_raw(rows + 1)


def test_stored_schemas(house):
    lake, _ = house
    assert lake.ratings.read().schema == schemas.SILVER_RATINGS
    assert lake.recommendations.read().schema == schemas.GOLD_RECOMMENDATIONS
    assert lake.genre_decade.read().schema == schemas.GOLD_GENRE_DECADE


def test_point_read_is_pushed_down(house):
    lake, _ = house
    plan = (
        lake.recommendations.read()
        .filter("userId = 42")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "EqualTo(userId,42)" in plan


def test_quality_reports_every_failure(spark):
    good = spark.createDataFrame([(1, 1, 3.0)], "userId int, movieId int, rating double")
    bad = spark.createDataFrame(
        [(1, 1, 9.0), (None, 1, 3.0)], "userId int, movieId int, rating double"
    )
    def report(stored):
        keys = {"silver_null_key": quality.null_rating_key()}
        return quality.stored_report(stored, 1).unionByName(quality.bad_row_counts(stored, keys))

    quality.require_ok(report(good))
    with pytest.raises(quality.QualityError) as error:
        quality.require_ok(report(bad))
    for name in ("bronze_rows_equal_input=1", "bronze_rating_out_of_range=1", "silver_null_key=1"):
        assert name in str(error.value)


def test_stored_tables_answer_sql(spark, house):
    lake, _ = house
    lake.register_views()
    mine = spark.sql(
        """
        select r.userId, r.movieId, m.title_clean, r.predicted_score
        from gold_recommendations r left join silver_movies m using (movieId)
        where r.userId = :user order by predicted_score desc limit 5
        """,
        args={"user": lake.recommendations.read().first().userId},
    )
    scores = [r.predicted_score for r in mine.collect()]
    assert len(scores) == 5 and scores == sorted(scores, reverse=True)
    assert spark.sql("select count(*) from silver_tags_clean").first()[0] > 0


def test_enriching_a_large_movie_table_stores_the_same_rows(house, monkeypatch):
    lake, _ = house
    before = lake.ratings.read().drop("genre_list")
    monkeypatch.setattr("reelhouse.plans.lakehouse.fits_broadcast", lambda df: False)
    lake._store_enriched()
    after = lake.ratings.read().drop("genre_list")
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_serving_copies(spark, sample):
    serving = replicas.ServingTables(spark, new_work_path(spark, "serving"))
    scores = sample.recommendation_scores()
    serving.reload_recommendations(scores)
    with pytest.raises(quality.QualityError, match="repeated"):
        serving.reload_recommendations(scores.unionByName(scores.limit(1)))
    assert serving.recommendations.read().count() == scores.count()
    users = scores.select("userId").distinct().count()
    assert serving.documents.read().count() == users
