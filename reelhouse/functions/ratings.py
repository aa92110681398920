"""Rating and tag expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed


def rating_in_range(rating: Column) -> Column:
    return rating.between(fixed.MIN_RATING, fixed.MAX_RATING)


def normalized_rating(rating: Column) -> Column:
    """Rating on a 0..1 scale."""
    return (rating - fixed.MIN_RATING) / (fixed.MAX_RATING - fixed.MIN_RATING)


def rating_time(epoch_seconds: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def rating_year(epoch_seconds: Column) -> Column:
    return F.year(rating_time(epoch_seconds))


def normalized_tag(tag: Column) -> Column:
    return F.lower(F.trim(tag))


def has_text(tag: Column) -> Column:
    return tag.isNotNull() & (F.length(F.trim(tag)) > 0)


def rounded_mean(total: Column, rows: Column, digits: int = 3) -> Column:
    return F.round(total.cast("double") / rows, digits)


def cleaned(winners: DataFrame) -> DataFrame:
    """Deduped ratings that are in range, with their dates."""
    return dated(in_range(winners)).select(
        "userId",
        "movieId",
        "rating",
        "rating_normalized",
        "rating_date",
        "rating_year",
        "timestamp",
    )


def in_range(ratings: DataFrame) -> DataFrame:
    return ratings.filter(rating_in_range(F.col("rating")))


def dated(ratings: DataFrame) -> DataFrame:
    """Add what follows from a rating and its time."""
    return ratings.withColumns(
        {
            "rating_normalized": normalized_rating(F.col("rating")),
            "rating_date": rating_time(F.col("timestamp")),
            "rating_year": rating_year(F.col("timestamp")),
        }
    )
