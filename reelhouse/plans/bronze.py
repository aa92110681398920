"""Raw layer: files to versioned tables, with provenance, in two batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.functions.ratings import rating_year

UNDATED_BATCH = "undated"
RATING_BATCHES = (fixed.FIRST_RATINGS_BATCH, fixed.SECOND_RATINGS_BATCH)


def rating_batch(cutoff_year: int = fixed.BATCH_CUTOFF_YEAR) -> Column:
    """Batch of a rating by its year; ratings without a time get their own batch."""
    year = rating_year(F.col("timestamp"))
    return (
        F.when(year <= cutoff_year, fixed.FIRST_RATINGS_BATCH)
        .when(year > cutoff_year, fixed.SECOND_RATINGS_BATCH)
        .otherwise(UNDATED_BATCH)
    )


def split_ratings(
    ratings: DataFrame, cutoff_year: int = fixed.BATCH_CUTOFF_YEAR
) -> DataFrame:
    return ratings.withColumn("batch_id", rating_batch(cutoff_year))
