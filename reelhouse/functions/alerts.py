"""Alert text and age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed

ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_OFFSET_FORMAT)


def burst_message(user_id: Column, count: Column, start: Column, end: Column) -> Column:
    return F.format_string(
        fixed.BURST_MESSAGE_FORMAT,
        user_id.cast("string"),
        count.cast("string"),
        iso_text(start),
        iso_text(end),
    )


def age_seconds(detected_at: Column, now: Column) -> Column:
    return F.timestamp_diff("SECOND", detected_at, now)


def age_label(seconds: Column) -> Column:
    """Seconds up to two minutes, whole minutes after; empty when unknown."""
    return (
        F.when(seconds.isNull(), F.lit(""))
        .when(
            seconds < fixed.AGE_IN_SECONDS_BELOW,
            F.format_string(fixed.AGE_SECONDS_FORMAT, seconds),
        )
        .otherwise(
            F.format_string(
                fixed.AGE_MINUTES_FORMAT, F.floor(seconds / 60).cast("bigint")
            )
        )
    )


def is_fresh(seconds: Column) -> Column:
    return F.coalesce(seconds < fixed.FRESH_ALERT_SECONDS, F.lit(False))
