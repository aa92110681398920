"""Event-time window results, for static tables and for streams.

Each function takes events with ``event_ts`` and returns one row per window and
key. Events without a time after the epoch count nowhere. On a stream the caller sets the watermark first (see ``streaming.jobs``).

On static tables the counts are additive, so they are first folded into small
panes and only the folded rows are expanded, exploded or re-grouped. Streams
keep the direct form: there a late event must still count in those sliding
windows that are open, which a pane closed earlier would lose.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.functions.alerts import burst_message
from reelhouse.functions.events import genres_or_unknown, is_valid_time, title_or_default


def _window(time: str, size: int, slide: int | None = None) -> Column:
    return F.window(time, f"{size} seconds", f"{slide} seconds" if slide else None)


def _bounds() -> list[Column]:
    return [
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    ]


def _timed(events: DataFrame) -> DataFrame:
    return events.filter(is_valid_time(F.col("event_ts")))


def trending(
    events: DataFrame,
    window_seconds: int = fixed.TRENDING_WINDOW_SECONDS,
    slide_seconds: int | None = None,
    fold: bool | None = None,
) -> DataFrame:
    """Events of any type per movie and window, with the first title seen.

    Windows tumble unless ``slide_seconds`` is given. ``fold`` gives the same rows
    either way: folding pays where a pane holds many events of a movie, or goes into many
    windows, and costs a step where it holds about one. By default sliding windows are
    folded and tumbling ones are not. Streams are never folded.
    """
    fold = slide_seconds is not None if fold is None else fold
    known = _timed(events).filter(F.col("movie_id").isNotNull())
    has_title = F.col("movie_title") != ""
    first = F.min(F.when(has_title, F.struct("event_ts", "movie_title"))).alias("first")
    if events.isStreaming or not fold:
        window = _window("event_ts", window_seconds, slide_seconds)
        totals = known.groupBy(window, "movie_id").agg(
            F.count("*").alias("rating_count"), first
        )
    else:
        # Titles as a grouping key keep the large step a hash aggregate; taking
        # the earliest title of the folded rows is then a small step.
        pane_seconds = math.gcd(window_seconds, slide_seconds or window_seconds)
        panes = (
            known.groupBy(
                _window("event_ts", pane_seconds).alias("pane"), "movie_id", "movie_title"
            )
            .agg(F.count("*").alias("n"), F.min("event_ts").alias("event_ts"))
            .withColumn("pane_start", F.col("pane.start"))
        )
        window = _window("pane_start", window_seconds, slide_seconds)
        totals = panes.groupBy(window, "movie_id").agg(
            F.sum("n").alias("rating_count"), first
        )
    return totals.select(
        *_bounds(),
        "movie_id",
        title_or_default(F.col("first.movie_title"), F.col("movie_id")).alias(
            "movie_title"
        ),
        "rating_count",
    )


def genre_activity(
    events: DataFrame,
    window_seconds: int = fixed.GENRE_WINDOW_SECONDS,
    slide_seconds: int = fixed.GENRE_SLIDE_SECONDS,
) -> DataFrame:
    """Events per genre and sliding window; an event counts once per genre it has.

    Neither user nor movie is needed for that.
    """
    known = _timed(events).withColumn("genres", genres_or_unknown(F.col("genres")))
    if events.isStreaming:
        counts = (
            known.select(
                "event_ts", F.explode("genres").alias("genre")
            )
            .groupBy(_window("event_ts", window_seconds, slide_seconds), "genre")
            .agg(F.count("*").alias("event_count"))
        )
    else:
        # A pane lies wholly inside or outside every sliding window, so only
        # pane totals are exploded by genre and copied into their windows.
        pane_seconds = math.gcd(window_seconds, slide_seconds)
        panes = (
            known.groupBy(_window("event_ts", pane_seconds).alias("pane"), "genres")
            .agg(F.count("*").alias("n"))
            .select(
                F.col("pane.start").alias("pane_start"),
                F.explode("genres").alias("genre"),
                "n",
            )
        )
        counts = panes.groupBy(
            _window("pane_start", window_seconds, slide_seconds), "genre"
        ).agg(F.sum("n").alias("event_count"))
    return counts.select(*_bounds(), "genre", "event_count")


def rating_bursts(
    events: DataFrame,
    window_seconds: int = fixed.BURST_WINDOW_SECONDS,
    threshold: int = fixed.BURST_THRESHOLD,
) -> DataFrame:
    """Alerts for users with strictly more ratings in a window than ``threshold``."""
    counts = (
        _ratings(events)
        .groupBy(_window("event_ts", window_seconds), "user_id")
        .agg(F.count("*").alias("event_count"))
        .filter(F.col("event_count") > threshold)
    )
    return _alerts(counts, F.col("window.start"), F.col("window.end"), threshold)


def rating_sessions(
    events: DataFrame,
    gap_seconds: int = fixed.SESSION_GAP_SECONDS,
    threshold: int = fixed.BURST_THRESHOLD,
) -> DataFrame:
    """Like ``rating_bursts`` over sessions that end after a quiet gap."""
    ratings = _ratings(events)
    if events.isStreaming:
        counts = (
            ratings.groupBy(
                F.session_window("event_ts", f"{gap_seconds} seconds"), "user_id"
            )
            .agg(F.count("*").alias("event_count"))
            .select("user_id", "event_count", "session_window.start", "session_window.end")
        )
    else:
        counts = _folded_sessions(ratings, gap_seconds)
    counts = counts.filter(F.col("event_count") > threshold)
    return _alerts(counts, F.col("start"), F.col("end"), threshold)


def _folded_sessions(ratings: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions from per-user panes one gap wide.

    Two ratings of one pane are never a gap apart, so a pane belongs to one
    session as a whole. A user's panes number at most time span / gap, however
    many ratings that user has.
    """
    panes = ratings.groupBy(
        "user_id", _window("event_ts", gap_seconds).alias("pane")
    ).agg(
        F.count("*").alias("n"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )
    by_time = Window.partitionBy("user_id").orderBy("first_ts")
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    opens = F.coalesce(
        F.col("first_ts") > F.lag("last_ts").over(by_time) + gap, F.lit(True)
    )
    return (
        panes.withColumn("opens", opens.cast("int"))
        .withColumn("session_no", F.sum("opens").over(by_time))
        .groupBy("user_id", "session_no")
        .agg(
            F.sum("n").alias("event_count"),
            F.min("first_ts").alias("start"),
            (F.max("last_ts") + gap).alias("end"),
        )
    )


def _ratings(events: DataFrame) -> DataFrame:
    is_rating = F.col("event_type") == fixed.RATING_EVENT
    return _timed(events).filter(is_rating & F.col("user_id").isNotNull())


def _alerts(counts: DataFrame, start: Column, end: Column, threshold: int) -> DataFrame:
    user, count = F.col("user_id"), F.col("event_count")
    return counts.select(
        "user_id",
        start.alias("session_start"),
        end.alias("session_end"),
        "event_count",
        F.lit(fixed.BURST_ALERT_TYPE).alias("alert_type"),
        F.lit(threshold).alias("threshold"),
        burst_message(user, count, start, end).alias("message"),
    )
