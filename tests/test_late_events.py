"""Watermarks of single events by a two-level running maximum."""

import random

import pytest

from reelhouse.operators import running, watermarks
from tests.conftest import plan_of, utc


def at(text):
    """A time as Spark hands it back."""
    return utc(text).replace(tzinfo=None)


def plain(rows):
    """(order, tie) -> largest value of all rows before."""
    out, most = {}, None
    for order, tie, value in sorted(rows):
        out[order, tie] = most
        if value is not None:
            most = value if most is None else max(most, value)
    return out


@pytest.mark.parametrize("rows_per_part", [7, 100, 10_000])
def test_running_max(spark, rows_per_part, monkeypatch):
    # Groups of parts are run through at three levels.
    monkeypatch.setattr(running, "FAN", 5)
    draw = random.Random(rows_per_part)
    rows = [(draw.randrange(60), n, draw.choice([None, draw.randrange(-50, 50)])) for n in range(700)]
    rows += [(61, n, n) for n in range(700, 1000)]  # one arrival time that holds a third of the rows
    df = spark.createDataFrame(rows, "at long, tie long, value long").repartition(6)
    found = running.running_max(df, ["at", "tie"], "value", "before", rows_per_part)
    assert found.columns == ["at", "tie", "value", "before"]
    assert {(r["at"], r.tie): r.before for r in found.collect()} == plain(rows)
    assert "SinglePartition" not in plan_of(found)


def test_running_max_of_no_rows_and_of_an_old_column(spark):
    df = spark.createDataFrame([(1, 5, 9), (2, 4, 9)], "at long, value long, before long")
    assert running.running_max(df.limit(0), ["at"], "value", "before").count() == 0
    found = running.running_max(df, ["at"], "value", "before").orderBy("at").collect()
    assert [(r["at"], r.before) for r in found] == [(1, None), (2, 5)]


def events(spark, rows):
    made = [(n, utc(time), n, "rating", n % 2, "t") for n, time in rows]
    return spark.createDataFrame(made, "n long, event_ts timestamp, event_id long, event_type string, movie_id long, movie_title string")


def test_an_event_is_late_once_its_window_is_closed(spark):
    rows = [
        (1, "2024-01-01T00:00:10"),
        (2, "2024-01-01T00:01:20"),  # watermark 00:00:50 for what follows
        (3, "2024-01-01T00:00:59"),  # behind it by nothing: its window ends at 00:01:00
        (4, "2024-01-01T00:01:30"),  # watermark 00:01:00 for what follows
        (5, "2024-01-01T00:00:59"),  # closed
        (6, "2024-01-01T00:01:01"),
        (7, "1960-01-01T00:00:00"),  # no valid time
    ]
    marked = watermarks.with_watermark(events(spark, rows), ["n"], 30, rows_per_part=2)
    seen = {r.n: r.watermark for r in marked.collect()}
    assert seen == {1: None, 2: at("2023-12-31T23:59:40"), 3: at("2024-01-01T00:00:50"), 4: at("2024-01-01T00:00:50"),
                    5: at("2024-01-01T00:01:00"), 6: at("2024-01-01T00:01:00")}
    late = watermarks.late_events(marked, 60).collect()
    assert [(r.n, r.window_end) for r in late] == [(5, at("2024-01-01T00:01:00"))]
    # Of sliding windows it misses those that are closed and counts in the others.
    sliding = {(r.n, r.window_end) for r in watermarks.late_events(marked, 60, 30).collect()}
    assert sliding == {(5, at("2024-01-01T00:01:00"))}
    counts = {(r.window_start, r.movie_id): r.rating_count for r in watermarks.trending_in_time(marked, 60).collect()}
    assert counts == {
        (at("2024-01-01T00:00:00"), 1): 2, (at("2024-01-01T00:01:00"), 0): 3,
    }
    report = watermarks.lateness(marked, 60).first()
    assert (report.events, report.behind, report.late, report.worst_micros) == (6, 1, 1, 1_000_000)


def test_plan_has_no_window_over_all_rows(spark, sample):
    marked = watermarks.with_watermark(sample.event_arrivals(), ["arrived_at", "event_no"], rows_per_part=500)
    plan = plan_of(watermarks.trending_in_time(marked, 3600))
    assert "SinglePartition" not in plan and "Window" in plan
