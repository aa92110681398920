"""Stored inputs and cleaned ratings: what is joined and shuffled, and that no row is lost."""

import re

from checks import registry
from reelhouse.plans import silver
from reelhouse.sources.sample_views import SampleViews
from tests.conftest import SAMPLE_FOLDER, plan_of, rows_of
from tests.test_bytes_moved import plans_of


def test_lines_are_joined_to_their_orders_once(spark):
    """Ratings, tags and the number of input ratings come from one join."""
    views = SampleViews(spark, SAMPLE_FOLDER)
    plans = plans_of(spark, lambda: registry.dq_report(views).collect())
    assert sum("orders.parquet" in p for p in plans) == 1


def test_stored_items_give_the_same_views(spark, sample, tmp_path):
    stored, n = sample.with_items_stored(str(tmp_path / "items"))
    assert n == sample.ratings_raw().count()
    for name in ("ratings_raw", "tags_raw"):
        first, again = getattr(sample, name)(), getattr(stored, name)()
        assert first.dtypes == again.dtypes
        assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


def test_nothing_derived_is_shuffled_with_a_rating(spark, sample, tmp_path):
    raw = [(1, 7, 4.0, 10), (1, 7, 5.0, 10), (1, 7, 9.0, 11), (2, None, 3.0, 5), (3, 8, 0.5, None), (4, 9, None, 3)]
    ratings = spark.createDataFrame(raw, "userId int, movieId int, rating double, timestamp long")
    movies = sample.movies_clean().limit(0)
    wide = silver.clean_and_enrich(ratings, movies)
    plain = silver.enrich_ratings(silver.clean_ratings(ratings), movies).select(wide.columns)
    assert sorted(map(str, rows_of(wide))) == sorted(map(str, rows_of(plain))) and wide.count() == 2
    sample.ratings_raw().write.parquet(str(tmp_path / "ratings"))
    stored = spark.read.parquet(str(tmp_path / "ratings"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(silver.clean_and_enrich(stored, sample.movies_clean()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
    join = plan[re.search("Join", plan).end() :]
    assert "Join" in plan and "Exchange" in join and "rating_normalized" not in join.split("\n", 1)[1]
