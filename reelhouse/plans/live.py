"""Operational reports over the window result tables.

Reports that depend on the current time take it as a zone-aware argument. Results
that are stored by date (``window_date``, ``detected_date``) are read from the dates
that a report needs; tables without those columns give the same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.functions import alerts as alert_fn
from reelhouse.functions.events import title_or_default
from reelhouse.operators.lookups import rows_with_few_keys

_NEWEST_FIRST = ("detected_at", "session_start", "user_id")


def _newest(alerts: DataFrame, limit: int) -> DataFrame:
    return alerts.orderBy(*[F.desc(c) for c in _NEWEST_FIRST]).limit(limit)


def _minutes_before(now: datetime, minutes: int) -> Column:
    return F.lit(now) - F.make_dt_interval(mins=F.lit(minutes))


def _newest_dates(windows: DataFrame, dates: int) -> DataFrame:
    """Windows of the newest ``dates`` dates, if they are stored by date.

    A date holds one window end or more, so n dates hold the newest n ends.
    """
    if "window_date" not in windows.columns:
        return windows
    newest = (
        windows.select("window_date").distinct().orderBy(F.desc("window_date")).limit(dates)
    )
    return windows.filter(F.col("window_date") >= newest.agg(F.min("window_date")).scalar())


def trending_top_k(trending: DataFrame, k: int = 10) -> DataFrame:
    """Busiest movies of the latest window; empty when there is no window yet.

    The latest end is a scalar subquery, which Spark hands to the scan of a
    stored table as a pushed filter.
    """
    newest = _newest_dates(trending, 1)
    latest = newest.agg(F.max("window_end")).scalar()
    return (
        newest.filter(F.col("window_end") == latest)
        .orderBy(F.desc("rating_count"), "movie_id")
        .limit(k)
    )


def most_active_genres(activity: DataFrame, last_n_windows: int = 30) -> DataFrame:
    """Activity score per genre over the latest window ends.

    Sliding windows overlap, so one event adds to several of them: the total is
    a score of activity, not a number of events.
    """
    newest = _newest_dates(activity, last_n_windows)
    ends = (
        newest.select("window_end")
        .distinct()
        .orderBy(F.desc("window_end"))
        .limit(last_n_windows)
    )
    recent = rows_with_few_keys(newest, ends, "window_end", last_n_windows)
    return (
        recent.groupBy("genre")
        .agg(F.sum("event_count").alias("total_events"))
        .orderBy(F.desc("total_events"), "genre")
    )


def trending_panel(trending: DataFrame) -> DataFrame:
    """Trending rows under the panel's column names."""
    movie_id = F.col("movie_id")
    title = title_or_default(F.col("movie_title"), movie_id)
    count = F.coalesce(F.col("rating_count"), F.lit(0))
    columns = (movie_id, title, count)
    return trending.select(
        *[c.alias(name) for c, name in zip(columns, fixed.TRENDING_PANEL_COLUMNS)]
    )


def genre_panel(genres: DataFrame) -> DataFrame:
    """Genre totals under the panel's column names."""
    columns = (F.col("genre"), F.col("total_events"))
    return genres.select(
        *[c.alias(name) for c, name in zip(columns, fixed.GENRE_PANEL_COLUMNS)]
    )


def recent_alerts(alerts: DataFrame, limit: int = 10) -> DataFrame:
    return _newest(alerts, limit)


def latest_alert(alerts: DataFrame) -> DataFrame:
    return _newest(alerts, 1)


def alerts_since(
    alerts: DataFrame, now: datetime, minutes: int = 30, limit: int = 15
) -> DataFrame:
    """Newest alerts detected in the last ``minutes``."""
    since = _minutes_before(now, minutes)
    if "detected_date" in alerts.columns:
        alerts = alerts.filter(F.col("detected_date") >= F.to_date(since))
    return _newest(alerts.filter(F.col("detected_at") >= since), limit)


def alerts_for_user(alerts: DataFrame, user_id: int, limit: int = 50) -> DataFrame:
    return _newest(alerts.filter(F.col("user_id") == user_id), limit)


def alert_ages(alerts: DataFrame, now: datetime) -> DataFrame:
    """Alerts with their age, its display label and whether they are fresh."""
    aged = alerts.withColumn(
        "age_seconds", alert_fn.age_seconds(F.col("detected_at"), F.lit(now))
    )
    seconds = F.col("age_seconds")
    return aged.withColumn("age_label", alert_fn.age_label(seconds)).withColumn(
        "is_fresh", alert_fn.is_fresh(seconds)
    )


def user_document(documents: DataFrame, user_id: int) -> DataFrame:
    """A user's nested rows, the page with the best recommendations first."""
    return documents.filter(F.col("user_id") == user_id).orderBy("page")


def monitor_counts(
    trending: DataFrame,
    activity: DataFrame,
    alerts: DataFrame,
    now: datetime,
    minutes: int = 10,
) -> DataFrame:
    """Rows per result table, and the alerts of the last ``minutes``."""

    def counter(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("value")).select(
            F.lit(name).alias("counter"), "value"
        )

    recent = F.col("detected_at") >= _minutes_before(now, minutes)
    alert_counts = alerts.agg(
        F.count("*").alias("all"), F.count_if(recent).alias("recent")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("anomaly_alerts").alias("counter"), F.col("all").alias("value")),
                F.struct(
                    F.lit("recent_alerts").alias("counter"), F.col("recent").alias("value")
                ),
            )
        )
    )
    return (
        counter(trending, "trending_movies")
        .unionByName(counter(activity, "genre_activity"))
        .unionByName(alert_counts)
    )
