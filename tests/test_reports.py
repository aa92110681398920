"""Reports on small hand-made tables."""

from pyspark.sql import functions as F

from reelhouse.operators import lookups
from reelhouse.plans import insights, live, replicas
from tests.conftest import rows_of, utc

MOVIES = "movieId int, title_clean string, genres string, is_recent boolean"
SCORES = "userId int, movieId int, predicted_score double"


def movies(spark):
    return spark.createDataFrame(
        [(1, "A", "X", True), (2, "B", "Y", False), (3, "C", "Z", None)], MOVIES
    )


def scores(spark):
    return spark.createDataFrame(
        [(1, 1, 4.0), (1, 2, 4.5), (1, 3, 4.5), (2, 1, 3.0), (3, 9, 1.0), (3, 1, 2.0)], SCORES
    )


def test_user_recommendations_keep_unknown_movies(spark):
    got = insights.user_recommendations(scores(spark), movies(spark), 3)
    assert rows_of(got) == [(3, 1, "A", "X", 2.0), (3, 9, None, None, 1.0)]
    top = insights.user_recommendations(scores(spark), movies(spark), 1, 2)
    assert [r.movie_id for r in top.collect()] == [2, 3]
    assert insights.user_recommendations(scores(spark), movies(spark), 77).isEmpty()


def test_large_limits_give_the_same_rows(spark, monkeypatch):
    expected = rows_of(insights.user_recommendations(scores(spark), movies(spark), 1, 9))
    huge = insights.user_recommendations(scores(spark), movies(spark), 1, 10**9)
    assert rows_of(huge) == expected
    assert "broadcast" not in huge._jdf.queryExecution().analyzed().toString()


def test_size_check_counts_rows_and_text(spark):
    table = movies(spark).withColumn("genre_list", F.split("genres", r"\|"))
    assert lookups.fits_broadcast(table)
    assert lookups.fits_broadcast(table, 3 * (64 + 2 + 5))
    assert not lookups.fits_broadcast(table, 3 * (64 + 2 + 5) - 1)
    assert lookups.fits_broadcast(table.limit(0), 0)


def test_most_recommended(spark):
    got = insights.most_recommended_movies(scores(spark), movies(spark), 2)
    assert rows_of(got) == [(1, "A", "X", 3, 3.0), (2, "B", "Y", 1, 4.5)]


def test_single_score_has_no_deviation_and_comes_last(spark):
    got = rows_of(insights.prediction_diversity(scores(spark)))
    assert [r[0] for r in got] == [3, 1, 2]
    assert got[-1] == (2, 3.0, None, 0.0)


def test_novelty_keeps_unknown_year_apart(spark):
    got = insights.novelty_vs_classic(scores(spark), movies(spark))
    assert sorted(rows_of(got)) == [
        ("Clásico (Pre-2019)", 1, 4.5),
        ("Clásico (Pre-2019)", 2, 2.75),
        ("Novedad (Post-2018)", 3, 3.0),
    ]


def test_top_genre_breaks_ties_by_name_and_excludes_small_ones(spark):
    stats = spark.createDataFrame(
        [("b", 1990, 4.0, 20), ("a", 1990, 4.0, 20), ("c", 1990, 5.0, 10), ("a", None, 5.0, 99)],
        "genre string, decade int, avg_rating double, total_ratings bigint",
    )
    assert rows_of(insights.top_genre_by_decade(stats, 10)) == [(1990, "a", 4.0, 20)]


def test_percentages(spark):
    dist = spark.createDataFrame([(1.0, 1), (2.0, 3)], "rating double, total bigint")
    assert rows_of(insights.rating_percentages(dist)) == [(2.0, 3, 75.0), (1.0, 1, 25.0)]
    zero = spark.createDataFrame([(1.0, 0)], "rating double, total bigint")
    assert rows_of(insights.rating_percentages(zero)) == [(1.0, 0, None)]


def test_documents_list_best_first(spark):
    docs = replicas.user_documents(scores(spark))
    one = live.user_document(docs, 1).collect()
    assert len(one) == 1
    assert [tuple(i) for i in one[0]["items"]] == [(2, 4.5), (3, 4.5), (1, 4.0)]
    assert docs.schema["items"].dataType.elementType.names == ["movie_id", "predicted_score"]


def test_documents_of_a_large_user_come_in_pages(spark):
    rows = spark.range(10_001).selectExpr(
        "1 as userId", "cast(id as int) as movieId", "if(id = 7, null, id / 7) as predicted_score"
    )
    pages = live.user_document(replicas.user_documents(rows), 1).collect()
    assert [(p.page, len(p["items"])) for p in pages] == [(n, 1000) for n in range(10)] + [(10, 1)]
    movies = [i.movie_id for p in pages for i in p["items"]]
    assert movies[0] == 10_000 and movies[-1] == 7 and len(set(movies)) == 10_001


def windows(spark, rows):
    return spark.createDataFrame(
        rows, "window_end timestamp, movie_id bigint, rating_count bigint"
    )


def test_trending_of_latest_window(spark):
    old, new = utc("2024-01-01 00:05"), utc("2024-01-01 00:10")
    got = live.trending_top_k(
        windows(spark, [(old, 1, 99), (new, 3, 5), (new, 2, 5), (new, 1, 7), (new, 4, 1)]), 3
    )
    assert [r.movie_id for r in got.collect()] == [1, 2, 3]
    empty = live.trending_top_k(windows(spark, []))
    assert empty.isEmpty() and empty.columns == ["window_end", "movie_id", "rating_count"]


def test_genres_of_the_last_window_ends(spark):
    rows = [(utc(f"2024-01-01 00:0{m}"), g, n) for m, g, n in
            [(1, "A", 100), (2, "A", 1), (2, "B", 5), (3, "A", 2), (3, "C", 3)]]
    activity = spark.createDataFrame(
        rows, "window_end timestamp, genre string, event_count bigint"
    )
    assert rows_of(live.most_active_genres(activity, 2)) == [("B", 5), ("A", 3), ("C", 3)]


def alerts(spark):
    rows = [
        (1, utc("2024-01-01 00:00"), utc("2024-01-01 00:01:00")),
        (2, utc("2024-01-01 00:00"), utc("2024-01-01 00:09:30")),
        (1, utc("2024-01-01 00:01"), utc("2024-01-01 00:09:30")),
        (3, utc("2024-01-01 00:02"), None),
    ]
    return spark.createDataFrame(
        rows, "user_id bigint, session_start timestamp, detected_at timestamp"
    )


def test_alert_lookups(spark):
    now = utc("2024-01-01 00:10:00")
    ids = lambda df: [(r.user_id, r.session_start.minute) for r in df.collect()]
    assert ids(live.recent_alerts(alerts(spark), 2)) == [(1, 1), (2, 0)]
    assert ids(live.latest_alert(alerts(spark))) == [(1, 1)]
    assert ids(live.alerts_since(alerts(spark), now, 5)) == [(1, 1), (2, 0)]
    assert ids(live.alerts_since(alerts(spark), now, 9)) == [(1, 1), (2, 0), (1, 0)]
    assert ids(live.alerts_for_user(alerts(spark), 1)) == [(1, 1), (1, 0)]


def test_alert_age(spark):
    now = utc("2024-01-01 00:10:00")
    got = live.alert_ages(alerts(spark), now).select("age_seconds", "age_label", "is_fresh")
    assert rows_of(got) == [
        (540, "hace 9 min", False),
        (30, "hace 30 s", True),
        (30, "hace 30 s", True),
        (None, "", False),
    ]


def test_monitor(spark):
    empty = windows(spark, [])
    got = live.monitor_counts(empty, empty, alerts(spark), utc("2024-01-01 00:10:00"), 5)
    assert dict(rows_of(got)) == {
        "trending_movies": 0,
        "genre_activity": 0,
        "anomaly_alerts": 4,
        "recent_alerts": 2,
    }


def test_mirror_is_newest_first(spark):
    activity = spark.createDataFrame(
        [(utc("2024-01-01 00:01"), "B"), (utc("2024-01-01 00:02"), "Z"),
         (utc("2024-01-01 00:02"), "A")],
        "window_end timestamp, genre string",
    )
    kept = replicas.latest_activity(activity, 2).select("genre")
    assert rows_of(kept) == [("A",), ("Z",)]


def test_sorted_for_point_reads(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"))
    stored = replicas.for_point_reads(df, "k").withColumn("p", F.spark_partition_id())
    spans = stored.groupBy("p").agg(F.min("k"), F.max("k")).orderBy("p").collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
