"""Data-quality reports: one aggregate pass per table, one row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.functions.events import is_valid_time


class QualityError(RuntimeError):
    """Raised after a whole report is known, listing every failed check."""


def bad_row_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, bad_rows, ok) with the rows for which each condition holds."""
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
    return report_of(counts)


def report_of(one_row: DataFrame) -> DataFrame:
    """(check, bad_rows, ok) from one row with a count for each check."""
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("bad_rows"))
            for n in one_row.columns
        ]
    )
    return one_row.select(F.inline(pairs)).withColumn("ok", F.col("bad_rows") == 0)


def rating_out_of_range() -> Column:
    rating = F.col("rating")
    return (rating < fixed.MIN_RATING) | (rating > fixed.MAX_RATING)


def null_rating_key() -> Column:
    return F.col("userId").isNull() | F.col("movieId").isNull()


def stored_report(stored: DataFrame, expected_rows: int) -> DataFrame:
    """Whether stored ratings are as many as expected, and in range, in one pass."""
    missing = F.abs(F.count("*") - F.lit(expected_rows))
    return report_of(
        stored.agg(
            missing.alias("bronze_rows_equal_input"),
            F.count_if(rating_out_of_range()).alias("bronze_rating_out_of_range"),
        )
    )


def event_report(events: DataFrame) -> DataFrame:
    """Events that all, the trending or the rating windows leave out, by reason."""
    return bad_row_counts(
        events,
        {
            "event_without_time": ~is_valid_time(F.col("event_ts")),
            "event_without_movie": F.col("movie_id").isNull(),
            "event_without_user": F.col("user_id").isNull(),
        },
    )


def require_ok(report: DataFrame) -> None:
    """Fail once, naming every check that did not hold."""
    failed = [f"{r.check}={r.bad_rows}" for r in report.filter(~F.col("ok")).collect()]
    if failed:
        raise QualityError("; ".join(failed))
