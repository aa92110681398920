"""Streaming queries: message source, event-time window results, append sink.

One source feeds three independent queries with a checkpoint each. Results are
written once, when the watermark has closed their window, and the file sink's
own commit log keeps a restarted query from writing a window twice.

Differences to a per-event engine: the watermark moves once per micro-batch and
is the maximum over all partitions, so an idle partition never holds it back.
An event is late only against the watermark of the previous batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from reelhouse import fixed_values as fixed
from reelhouse.functions.events import parse_wire
from reelhouse.operators import event_windows


RESULTS = {
    "trending_movies": "window_start timestamp, window_end timestamp, movie_id bigint,"
    " movie_title string, rating_count bigint, computed_at timestamp, window_date date",
    "genre_activity": "window_start timestamp, window_end timestamp, genre string,"
    " event_count bigint, computed_at timestamp, window_date date",
    "anomaly_alerts": "user_id bigint, session_start timestamp, session_end timestamp,"
    " event_count bigint, alert_type string, threshold int, message string,"
    " detected_at timestamp, detected_date date",
}
RESULTS["session_alerts"] = RESULTS["anomaly_alerts"]


def read_results(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A stream's stored windows; no rows before the first one has closed."""
    return spark.read.schema(RESULTS[name]).parquet(f"{out}/{name}")


def timed_events(messages: DataFrame) -> DataFrame:
    """Parsed, valid events with the watermark the windows close on."""
    delay = f"{fixed.WATERMARK_SECONDS} seconds"
    return parse_wire(messages).withWatermark("event_ts", delay)


def start_append(
    results: DataFrame,
    path: str,
    checkpoint: str,
    stamp: str = "computed_at",
    until_caught_up: bool = False,
    date: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Append closed windows to Parquet files, stamped with the time of writing.

    ``date`` names the partition column and the time it is the date of, so that
    readers open the newest dates only. ``until_caught_up`` processes what is there and stops; otherwise the query
    keeps running and checkpoints on the fixed interval.
    """
    results = results.withColumn(stamp, F.current_timestamp())
    if date:
        results = results.withColumn(date[0], F.to_date(date[1]))
    writer = (
        results.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*(date or ())[:1])
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{fixed.CHECKPOINT_SECONDS} seconds")
    return writer.start()


def start_trending(
    messages: DataFrame,
    out: str,
    checkpoints: str,
    window_seconds: int = fixed.TRENDING_WINDOW_SECONDS,
    slide_seconds: int | None = None,
    until_caught_up: bool = False,
) -> StreamingQuery:
    results = event_windows.trending(
        timed_events(messages), window_seconds, slide_seconds
    )
    return start_append(
        results,
        f"{out}/trending_movies",
        f"{checkpoints}/trending_movies",
        until_caught_up=until_caught_up,
        date=("window_date", "window_end"),
    )


def start_genre_activity(
    messages: DataFrame,
    out: str,
    checkpoints: str,
    window_seconds: int = fixed.GENRE_WINDOW_SECONDS,
    slide_seconds: int = fixed.GENRE_SLIDE_SECONDS,
    until_caught_up: bool = False,
) -> StreamingQuery:
    results = event_windows.genre_activity(
        timed_events(messages), window_seconds, slide_seconds
    )
    return start_append(
        results,
        f"{out}/genre_activity",
        f"{checkpoints}/genre_activity",
        until_caught_up=until_caught_up,
        date=("window_date", "window_end"),
    )


def start_rating_bursts(
    messages: DataFrame,
    out: str,
    checkpoints: str,
    window_seconds: int = fixed.BURST_WINDOW_SECONDS,
    threshold: int = fixed.BURST_THRESHOLD,
    until_caught_up: bool = False,
) -> StreamingQuery:
    results = event_windows.rating_bursts(
        timed_events(messages), window_seconds, threshold
    )
    return start_append(
        results,
        f"{out}/anomaly_alerts",
        f"{checkpoints}/anomaly_alerts",
        stamp="detected_at",
        until_caught_up=until_caught_up,
        date=("detected_date", "detected_at"),
    )


def start_rating_sessions(
    messages: DataFrame,
    out: str,
    checkpoints: str,
    gap_seconds: int = fixed.SESSION_GAP_SECONDS,
    threshold: int = fixed.BURST_THRESHOLD,
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Alerts over sessions: each user's open session is kept and merged from batch to batch.

    A session comes out once the watermark has passed its last rating by the gap.
    """
    results = event_windows.rating_sessions(timed_events(messages), gap_seconds, threshold)
    return start_append(
        results,
        f"{out}/session_alerts",
        f"{checkpoints}/session_alerts",
        stamp="detected_at",
        until_caught_up=until_caught_up,
        date=("detected_date", "detected_at"),
    )


def start_all(
    new_source: Callable[[], DataFrame],
    out: str,
    checkpoints: str,
    burst_window_seconds: int = fixed.BURST_WINDOW_SECONDS,
    burst_threshold: int = fixed.BURST_THRESHOLD,
) -> list[StreamingQuery]:
    """The three result streams side by side, each reading the source itself."""
    return [
        start_trending(new_source(), out, checkpoints),
        start_genre_activity(new_source(), out, checkpoints),
        start_rating_bursts(
            new_source(), out, checkpoints, burst_window_seconds, burst_threshold
        ),
    ]
