"""Window results on hand-made events, and properties they must have."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelhouse.functions import events as event_fn
from reelhouse.operators import event_windows, quality
from tests.conftest import rows_of, utc

EVENT = (
    "event_ts timestamp, event_type string, user_id bigint, movie_id bigint, "
    "movie_title string, genres array<string>"
)
START = utc("2024-01-01 00:00:00")


def at(seconds):
    return START + timedelta(seconds=seconds)


def event(seconds, kind="rating", user=1, movie=1, title="T", genres=("A",)):
    return (at(seconds), kind, user, movie, title, None if genres is None else list(genres))


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def test_wire_parsing(spark):
    messages = [
        '{"event_id":"1","user_id":1,"timestamp":"2024-01-01T00:00:00.123Z"}',
        '{"event_id":"2","user_id":1,"timestamp":"2024-01-01T05:00:00+05:00"}',
        "nope",
        "[1]",
        '{"event_id":"3"}',
        '{"event_id":"4","timestamp":"1970-01-01T00:00:00Z"}',
        '{"event_id":"5","timestamp":"yesterday"}',
        '{"event_id":"6","timestamp":"12:30"}',
        '{"event_id":"7","timestamp":12345}',
        "",
        None,
    ]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    got = event_fn.parse_wire(df).select("event_id", F.unix_millis("event_ts"))
    assert rows_of(got) == [("1", 1704067200123), ("2", 1704067200000)]


def test_wire_has_user_key(spark):
    rows = rows_of(event_fn.to_wire(frame(spark, [event(0, user=5)])))
    assert rows[0][0] == "5" and '"timestamp":"2024-01-01T00:00:00.000Z"' in rows[0][1]


def test_trending_counts_all_types_and_takes_first_title(spark):
    rows = [
        event(0, "search", movie=1, title=""),
        event(10, "rating", movie=1, title="T"),
        event(20, "rating", movie=1, title="U"),
        event(0, movie=2, title=""),
        event(0, movie=3, title=None),
        event(299, movie=4, title="W"),
        event(300, movie=4, title="W"),
        event(5, movie=None),
    ]
    got = event_windows.trending(frame(spark, rows)).select(
        "window_start", "movie_id", "movie_title", "rating_count"
    )
    assert sorted((r[0].minute, *r[1:]) for r in rows_of(got)) == [
        (0, 1, "T", 3),
        (0, 2, "Movie-2", 1),
        (0, 3, "Movie-3", 1),
        (0, 4, "W", 1),
        (5, 4, "W", 1),
    ]


def test_genre_defaults(spark):
    rows = [event(0, genres=("A", "B")), event(1, genres=()), event(2, genres=None)]
    got = event_windows.genre_activity(frame(spark, rows), 60, 60)
    assert sorted(rows_of(got.select("genre", "event_count"))) == [
        ("A", 1),
        ("B", 1),
        ("Unknown", 2),
    ]


def burst(n, first=0.0, step=0.05, user=1):
    return [event(first + i * step, user=user) for i in range(n)]


def test_burst_threshold_is_strict(spark):
    rows = burst(20, user=1) + burst(21, user=2) + burst(25, user=3)
    rows += burst(13, first=59, user=4) + burst(12, first=60, user=4)
    rows += [event(0, "search", user=5) for _ in range(50)]
    got = event_windows.rating_bursts(frame(spark, rows))
    assert sorted(rows_of(got.select("user_id", "event_count"))) == [(2, 21), (3, 25)]
    alert = got.filter("user_id = 3").first()
    assert alert.message == (
        "Usuario 3 emitio 25 ratings en ventana "
        "(2024-01-01T00:00:00+00:00 -> 2024-01-01T00:01:00+00:00)"
    )
    assert (alert.alert_type, alert.threshold) == ("RATING_BURST", 20)


def test_session_spans_window_borders(spark):
    got = event_windows.rating_sessions(frame(spark, burst(25, first=59)))
    assert rows_of(got.select("event_count")) == [(25,)]


def test_event_report(spark):
    rows = [event(0), event(0, movie=None), (None, "rating", None, 1, "T", None)]
    got = dict((r[0], r[1]) for r in rows_of(quality.event_report(frame(spark, rows))))
    assert got == {
        "event_without_time": 1,
        "event_without_movie": 1,
        "event_without_user": 1,
    }


small = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
events_strategy = st.lists(
    st.builds(
        event,
        st.integers(0, 900),
        st.sampled_from(["rating", "search"]),
        st.integers(1, 3),
        st.integers(1, 3),
        st.sampled_from(["", "T", "U", None]),
        st.sampled_from([("A",), ("A", "B"), (), None]),
    ),
    min_size=1,
    max_size=40,
)


@small
@given(events_strategy, st.sampled_from([(600, 60), (60, 60), (100, 40), (90, 60)]))
def test_folded_sliding_windows_equal_direct_ones(spark, rows, shape):
    size, slide = shape
    events = frame(spark, rows)
    genres = F.explode(event_fn.genres_or_unknown(F.col("genres")))
    direct = (
        events.select("event_ts", genres.alias("genre"))
        .groupBy(F.window("event_ts", f"{size} seconds", f"{slide} seconds"), "genre")
        .agg(F.count("*").alias("event_count"))
        .select("window.start", "window.end", "genre", "event_count")
    )
    folded = event_windows.genre_activity(events, size, slide)
    assert sorted(rows_of(folded)) == sorted(rows_of(direct))


@small
@given(events_strategy, st.sampled_from([7, 60, 120]))
def test_folded_sessions_equal_session_windows(spark, rows, gap):
    events = frame(spark, rows)
    direct = (
        events.filter("event_type = 'rating'")
        .groupBy("user_id", F.session_window("event_ts", f"{gap} seconds"))
        .agg(F.count("*").alias("n"))
        .select("user_id", "session_window.start", "session_window.end", "n")
    )
    folded = event_windows.rating_sessions(events, gap, 0).select(
        "user_id", "session_start", "session_end", "event_count"
    )
    assert sorted(rows_of(folded)) == sorted(rows_of(direct))


@small
@given(events_strategy)
def test_every_event_is_in_one_tumbling_window(spark, rows):
    total = event_windows.trending(frame(spark, rows)).agg(F.sum("rating_count"))
    assert rows_of(total) == [(len(rows),)]


@small
@given(events_strategy, st.sampled_from([(300, 10), (300, 300), (100, 40)]))
def test_folded_trending_equals_direct_counts(spark, rows, shape):
    size, slide = shape
    events = frame(spark, rows)
    first = F.min(F.when(F.col("movie_title") != "", F.struct("event_ts", "movie_title")))
    direct = (
        events.groupBy(F.window("event_ts", f"{size} seconds", f"{slide} seconds"), "movie_id")
        .agg(F.count("*").alias("n"), first.alias("first"))
        .select(
            "window.start",
            "window.end",
            "movie_id",
            event_fn.title_or_default(F.col("first.movie_title"), F.col("movie_id")),
            "n",
        )
    )
    assert sorted(rows_of(event_windows.trending(events, size, slide))) == sorted(rows_of(direct))
