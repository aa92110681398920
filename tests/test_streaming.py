"""Streams against static tables, restarts and late events."""

import json

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import event_windows
from reelhouse.session import new_work_path
from reelhouse.sources import event_log
from reelhouse.streaming import jobs
from tests.conftest import rows_of


def message(time, user=1, movie=1, kind="rating", genres=("A",), title="T"):
    return json.dumps(
        {
            "event_type": kind,
            "user_id": user,
            "movie_id": movie,
            "movie_title": title,
            "genres": list(genres),
            "timestamp": f"2024-01-01T{time}Z",
        }
    )


class Topic:
    """A folder of messages that a stream reads one file at a time."""

    def __init__(self, spark):
        self.spark = spark
        self.path = new_work_path(spark, "topic")
        self.out = new_work_path(spark, "out")
        self.checkpoints = new_work_path(spark, "checkpoints")

    def put(self, *messages):
        rows = [("1", m) for m in messages]
        df = self.spark.createDataFrame(rows, event_log.WIRE_SCHEMA).coalesce(1)
        df.write.mode("append").parquet(self.path)

    def run(self, start, **arguments):
        source = event_log.read_message_files(self.spark, self.path, files_per_trigger=1)
        query = start(source, self.out, self.checkpoints, until_caught_up=True, **arguments)
        assert query.awaitTermination(120)
        return query

    def result(self, name):
        if name in jobs.RESULTS:
            return jobs.read_results(self.spark, self.out, name)
        return self.spark.read.parquet(f"{self.out}/{name}")


@pytest.fixture
def topic(spark):
    return Topic(spark)


def counts(df):
    return sorted((r.window_start.strftime("%H:%M"), r.rating_count) for r in df.collect())


def test_only_closed_windows_are_written_once(topic):
    topic.put(message("00:00:10"), message("00:01:00"), "garbage")
    topic.put(message("00:05:20"))
    topic.run(jobs.start_trending)
    # 00:05:20 less 30 s has not passed 00:05:00 yet.
    assert counts(topic.result("trending_movies")) == []
    topic.put(message("00:05:30"))
    topic.run(jobs.start_trending)
    assert counts(topic.result("trending_movies")) == [("00:00", 2)]
    topic.run(jobs.start_trending)
    assert counts(topic.result("trending_movies")) == [("00:00", 2)]
    assert topic.result("trending_movies").filter("computed_at is null").isEmpty()


def test_late_events(topic):
    topic.put(message("00:05:40"))
    # Late by one batch: still counted. Late by two: dropped.
    topic.put(message("00:01:00"))
    topic.put(message("00:02:00"))
    topic.put(message("00:20:00"))
    topic.run(jobs.start_trending)
    assert counts(topic.result("trending_movies")) == [("00:00", 1), ("00:05", 1)]


def test_late_event_counts_in_sliding_windows_still_open(topic):
    topic.put(message("00:05:40"))
    topic.put(message("00:05:41"))
    # 00:04:30 lies in windows that ended before the watermark 00:05:11 and in
    # later ones that did not.
    topic.put(message("00:04:30"))
    topic.put(message("01:00:00"))
    topic.run(jobs.start_genre_activity)
    by_end = {
        r.window_end.strftime("%H:%M"): r.event_count
        for r in topic.result("genre_activity").collect()
    }
    assert "00:05" not in by_end
    assert by_end["00:06"] == 3 and by_end["00:14"] == 3 and by_end["00:15"] == 2


def test_burst_alert(topic):
    topic.put(*[message(f"00:00:{10 + i // 10}.{i % 10}00", user=9) for i in range(25)])
    topic.put(message("00:02:00", user=8))
    topic.run(jobs.start_rating_bursts)
    got = topic.result("anomaly_alerts").collect()
    assert [(r.user_id, r.event_count) for r in got] == [(9, 25)]
    assert got[0].detected_at is not None


def test_session_stream_equals_static(spark, topic):
    times = ["00:00:10", "00:01:00", "00:04:00", "00:04:30", "00:05:00"]
    topic.put(*[message(t) for t in times], message("00:30:00", user=7, kind="search"))
    topic.put(message("00:31:00", user=7))

    def start(messages, out, checkpoints, until_caught_up):
        results = event_windows.rating_sessions(jobs.timed_events(messages), 120, 1)
        return jobs.start_append(
            results, f"{out}/sessions", f"{checkpoints}/s", "detected_at", until_caught_up
        )

    topic.run(start)
    got = topic.result("sessions").select("user_id", "event_count").orderBy("session_start")
    assert rows_of(got) == [(1, 2), (1, 3)]


@pytest.mark.parametrize(
    "start, name, static",
    [
        (jobs.start_trending, "trending_movies", event_windows.trending),
        (jobs.start_genre_activity, "genre_activity", event_windows.genre_activity),
    ],
)
def test_default_windows_equal_static_result(spark, sample, start, name, static):
    events = sample.platform_events()
    topic = Topic(spark)
    event_log.write_message_files(events, topic.path)
    topic.put(message("00:00:00").replace("2024-01-01", "2024-03-01"))
    source = event_log.read_message_files(spark, topic.path)
    query = start(source, topic.out, topic.checkpoints, until_caught_up=True)
    assert query.awaitTermination(300)
    streamed = topic.result(name).drop("computed_at", "window_date")
    expected = static(events)
    assert streamed.exceptAll(expected).isEmpty()
    assert expected.exceptAll(streamed.select(expected.columns)).isEmpty()


def test_three_streams_side_by_side(spark, topic):
    topic.put(message("00:00:10"), message("00:10:00"))
    topic.put(message("00:30:00"))
    queries = jobs.start_all(
        lambda: event_log.read_message_files(spark, topic.path), topic.out, topic.checkpoints
    )
    try:
        for query in queries:
            query.processAllAvailable()
        assert len({q.id for q in queries}) == 3
        assert topic.result("trending_movies").agg(F.sum("rating_count")).first()[0] == 2
        assert topic.result("genre_activity").count() > 0
    finally:
        for query in queries:
            query.stop()
