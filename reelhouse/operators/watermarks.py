"""Late events of a stored log, against the watermark of every single event.

The watermark at an event is the latest event time that arrived before it, less a fixed delay. A
window that ends at or before it is closed, and the event no longer counts there. A stream moves its
watermark once a batch; here each event has its own, whatever the batches were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.functions.events import is_valid_time
from reelhouse.operators import event_windows
from reelhouse.operators.running import ROWS_PER_PART, running_max


def with_watermark(
    events: DataFrame,
    arrival: list[str],
    delay_seconds: int = fixed.WATERMARK_SECONDS,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Events with a valid time, and ``watermark``: null until one has arrived.

    ``arrival`` holds the columns that tell the order in which events came, ties included.
    """
    timed = events.filter(is_valid_time(F.col("event_ts")))
    latest = running_max(timed, arrival, "event_ts", "watermark", rows_per_part)
    delay = F.make_dt_interval(secs=F.lit(delay_seconds))
    return latest.withColumn("watermark", F.col("watermark") - delay)


def late_events(marked: DataFrame, window_seconds: int, slide_seconds: int | None = None) -> DataFrame:
    """One row for each event and closed window that it missed: adds window_start and window_end.

    ``marked`` comes from ``with_watermark``.
    """
    size, slide = f"{window_seconds} seconds", f"{slide_seconds or window_seconds} seconds"
    placed = marked.withColumn("window", F.window("event_ts", size, slide))
    late = placed.filter(F.col("window.end") <= F.col("watermark"))
    return late.select(
        *[F.col(f"`{c}`") for c in marked.columns],
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def in_time(marked: DataFrame, window_seconds: int) -> DataFrame:
    """The events that came before their tumbling window was closed."""
    end = F.window("event_ts", f"{window_seconds} seconds")["end"]
    open_ = F.col("watermark").isNull() | (end > F.col("watermark"))
    return marked.filter(open_).drop("watermark")


def trending_in_time(marked: DataFrame, window_seconds: int = fixed.TRENDING_WINDOW_SECONDS) -> DataFrame:
    """``event_windows.trending`` over tumbling windows, without late events."""
    return event_windows.trending(in_time(marked, window_seconds), window_seconds)


def lateness(marked: DataFrame, window_seconds: int) -> DataFrame:
    """By event type: events, those behind the watermark, those too late for their window, worst delay."""
    end = F.window("event_ts", f"{window_seconds} seconds")["end"]
    behind = F.col("event_ts") < F.col("watermark")
    seconds = F.unix_micros("watermark") - F.unix_micros("event_ts")
    return marked.withColumn("end", end).groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.count_if(behind).alias("behind"),
        F.count_if(F.col("end") <= F.col("watermark")).alias("late"),
        F.max(F.when(behind, seconds)).alias("worst_micros"),
    )
