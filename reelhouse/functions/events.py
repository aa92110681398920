"""Platform event expressions: wire format, event time, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.schemas import PLATFORM_EVENT

# Fixed format: event times on the wire are ISO-8601 in UTC with milliseconds.
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}([T ]|$)"


def event_time(iso_text: Column) -> Column:
    """ISO text (any offset) to a timestamp with millisecond precision, else NULL."""
    text = F.when(iso_text.rlike(ISO_DATE_PREFIX), iso_text)
    return F.date_trunc("millisecond", F.try_to_timestamp(text))


def wire_time(event_ts: Column) -> Column:
    return F.date_format(event_ts, WIRE_TIME_FORMAT)


def is_valid_time(event_ts: Column) -> Column:
    return event_ts.isNotNull() & (event_ts > F.timestamp_seconds(F.lit(0)))


def genres_or_unknown(genres: Column) -> Column:
    no_genres = genres.isNull() | (F.size(genres) <= 0)
    return F.when(no_genres, F.array(F.lit(fixed.UNKNOWN_GENRE))).otherwise(genres)


def title_or_default(title: Column, movie_id: Column) -> Column:
    default = F.concat(F.lit(fixed.DEFAULT_TITLE_PREFIX), movie_id.cast("string"))
    return F.when(title.isNull() | (title == ""), default).otherwise(title)


def parse_wire(messages: DataFrame, value: str = "value") -> DataFrame:
    """Events from JSON messages; unreadable or timeless ones are dropped.

    The generator keeps the parsed message in one place: as a plain projection,
    Spark would push the time filter below it and parse every message twice.
    """
    event = F.from_json(F.col(value).cast("string"), PLATFORM_EVENT)
    return (
        messages.select(F.inline(F.array(event)))
        .withColumn("event_ts", event_time(F.col("timestamp")))
        .filter(is_valid_time(F.col("event_ts")))
    )


def to_wire(events: DataFrame) -> DataFrame:
    """Keyed JSON messages: the key is the user, the value the whole event."""
    timed = events.withColumn("timestamp", wire_time(F.col("event_ts")))
    fields = [f.name for f in PLATFORM_EVENT.fields if f.name in timed.columns]
    return timed.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )
