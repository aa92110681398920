"""Replayable sources, results kept by key, backfills and aggregates by batch."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelhouse.functions.events import parse_wire
from reelhouse.operators import event_windows
from reelhouse.plans import gold
from reelhouse.plans.partials import PartialTables
from reelhouse.sources import message_segments as log
from reelhouse.streaming import jobs, keyed_results
from tests.conftest import rows_of, utc


def at(text):
    """A time as Spark hands it back."""
    return utc(text).replace(tzinfo=None)

DAY = 86_400
KEYS = ("window_start", "movie_id")


def events(spark, n, first=0):
    rows = [(str(i), "rating", i % 5, i % 3, "t", ["g"], utc("2024-01-01T00:00:00") + timedelta(hours=i)) for i in range(first, first + n)]
    return spark.createDataFrame(
        rows, "event_id string, event_type string, user_id long, movie_id long, movie_title string, genres array<string>, event_ts timestamp"
    )


def ids(df):
    return sorted(int(r.event_id) for r in parse_wire(df).collect())


def test_offsets_cut_files_and_segments_anywhere(spark, tmp_path):
    path = str(tmp_path / "log")
    assert log._Log({"path": path}).end(log.Place()) == log.Place()
    for n in range(3):
        assert log.append_segment(events(spark, 40, 40 * n).repartition(3), path) == n + 1
    (Path(path) / "segment=00000009").mkdir()  # unfinished: no success file
    whole = log.read_all_segments(spark, path)
    assert ids(whole) == list(range(120))
    reader = log._Log({"path": path})
    place, seen = log.Place(), []
    while (stop := reader.end(place, 7)) != place:
        for span in reader.spans(place, stop, 3):
            assert span.end - span.begin <= 3
            for batch in reader.read(span):
                seen += batch["value"].to_pylist()
        place = log.Place.of(stop.offset())
    assert len(seen) == len(set(seen)) == 120
    assert reader.spans(place, place, 3) == [] and reader.end(place, 0) == place


def test_a_stopped_stream_goes_on_in_the_middle_of_a_file(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    log.append_segment(events(spark, 50).coalesce(1), path)

    def run(up_to=None):
        parsed = parse_wire(log.read_segments(spark, path, up_to))
        jobs.start_append(parsed, out, str(tmp_path / "checkpoint"), "stored_at", until_caught_up=True).awaitTermination()
        return sorted(int(r.event_id) for r in spark.read.parquet(out).collect())

    assert len(run(20)) == 20
    log.append_segment(events(spark, 30, 50).repartition(2), path)
    assert run() == list(range(80))
    assert run() == list(range(80))


def windows(spark, rows):
    made = [(utc(f"2024-01-{d:02d}T00:00:00"), m, n, date(2024, 1, d)) for d, m, n in rows]
    return spark.createDataFrame(made, "window_start timestamp, movie_id long, rating_count long, window_date date")


def stored_counts(spark, path):
    return sorted((r.window_date.day, r.movie_id, r.rating_count) for r in spark.read.parquet(path).collect())


def test_keys_replace_and_other_dates_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "out")
    keyed_results.replace_keys(windows(spark, [(1, 1, 5), (1, 2, 6), (2, 1, 7)]), path, KEYS)
    untouched = sorted(Path(path, "window_date=2024-01-02").glob("*.parquet"))
    for _ in range(2):
        keyed_results.replace_keys(windows(spark, [(1, 2, 60), (3, 1, 9)]), path, KEYS)
    assert stored_counts(spark, path) == [(1, 1, 5), (1, 2, 60), (2, 1, 7), (3, 1, 9)]
    assert sorted(Path(path, "window_date=2024-01-02").glob("*.parquet")) == untouched
    assert keyed_results.replace_keys(windows(spark, [(1, 1, 1)]).limit(0), path, KEYS) == []


def test_compaction_bounds_the_files_of_a_date(spark, tmp_path):
    path = str(tmp_path / "out")
    many = windows(spark, [(1 + n % 3, n, n) for n in range(600)]).repartition(40)
    many.write.partitionBy("window_date").parquet(path)
    before = stored_counts(spark, path)
    files = lambda: {p.name: len(list(p.glob("*.parquet"))) for p in Path(path).glob("window_date=*")}
    assert min(files().values()) > 20
    keyed_results.compact(spark, path, [date(2024, 1, 1), date(2024, 1, 2)])
    assert files()["window_date=2024-01-01"] == files()["window_date=2024-01-02"] == 1
    assert files()["window_date=2024-01-03"] > 20 and stored_counts(spark, path) == before
    size = sum(f.stat().st_size for f in Path(path, "window_date=2024-01-03").glob("*.parquet"))
    keyed_results.compact(spark, path, [date(2024, 1, 3)], file_bytes=size // 4)
    assert 2 <= files()["window_date=2024-01-03"] <= 6 and stored_counts(spark, path) == before


def test_touched_windows(spark):
    changed = events(spark, 2, 23)
    found = {(r.window_start, r.window_end) for r in keyed_results.touched_windows(changed, DAY).collect()}
    assert found == {
        (at("2024-01-01T00:00:00"), at("2024-01-02T00:00:00")),
        (at("2024-01-02T00:00:00"), at("2024-01-03T00:00:00")),
    }
    assert keyed_results.touched_windows(changed, DAY, DAY // 2).count() == 3


@pytest.mark.parametrize("slide", [None, DAY // 2])
def test_backfill_equals_a_full_computation(spark, tmp_path, slide):
    every = events(spark, 24 * 12).withColumn("day", F.to_date("event_ts"))
    path, out = str(tmp_path / "events"), str(tmp_path / "out")
    every.write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    # Events of two days are missing at first; another event was counted that is gone since.
    changed = stored.filter(F.dayofmonth("day").isin(3, 4) & (F.col("event_id").cast("long") % 4 == 0))
    gone = events(spark, 1, 24 * 20)
    first = stored.join(changed, "event_id", "left_anti").drop("day").unionByName(gone)
    trending = lambda df: event_windows.trending(df, DAY, slide)
    dated = trending(first).withColumn("window_date", F.to_date("window_end"))
    keyed_results.replace_keys(dated, out, KEYS)
    asked = []

    def read(dates):
        asked.extend(dates)
        return stored.filter(F.col("day").isin(dates))

    changes = changed.drop("day").unionByName(gone)
    keyed_results.backfill(spark, read, changes, out, DAY, slide)
    assert len(set(asked)) <= 9 and date(2024, 1, 8) not in asked
    kept = spark.read.parquet(out).drop("window_date")
    full = trending(stored)
    assert sorted(rows_of(kept)) == sorted(rows_of(full.select(*kept.columns)))


def test_backfill_of_nothing(spark, tmp_path):
    assert keyed_results.backfill(spark, lambda d: None, events(spark, 1).limit(0), str(tmp_path / "out"), DAY) == []


def test_partials_of_batches_add_up(spark, sample, tmp_path):
    rows = sample.ratings_enriched()
    tables = PartialTables(spark, str(tmp_path))
    tables.load(rows.filter("rating_year % 2 = 0").limit(100), "even")
    for name, part in (("even", 0), ("odd", 1), ("even", 0)):
        tables.load(rows.filter(F.col("rating_year") % 2 == part), name)
    same = lambda a, b: a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert same(tables.genre_decade_stats(), gold.genre_decade_stats(rows))
    assert same(tables.rating_distribution(), gold.rating_distribution(rows))
    odd = sorted(p.name for p in Path(tmp_path, "genre_decade", "batch_id=odd").glob("*.parquet"))
    tables.load(rows.filter("rating_year % 2 = 0"), "even")
    assert sorted(p.name for p in Path(tmp_path, "genre_decade", "batch_id=odd").glob("*.parquet")) == odd
