"""Cleaned ratings that are kept up batch by batch, with copies dropped across batches.

Stored are the winners of the dedupe before the range filter, by year of the rating: a rating out of
range may win over one in range, and a later batch must still meet it. A key holds the time of its
rating, so copies of it lie in one year; a new batch is compared with the years that it holds itself, and
only years in which it changes something are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions import ratings as rating_fn
from reelhouse.session import ensure_checkpoint_dir, open_side_by_side
from reelhouse.sources.batch_table import stored_or_empty

YEAR = "key_year"
SCHEMA = f"userId int, movieId int, timestamp long, rating double, {YEAR} int"
KEYS = ["userId", "movieId", "timestamp"]
HAS_KEY = "userId is not null and movieId is not null"
#: The year of ratings without a time.
UNDATED = -1


class RatingBatches:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _stored(self, years: list[int] | None = None) -> DataFrame:
        rows = stored_or_empty(self.spark, self.path, SCHEMA)
        return rows if years is None else rows.filter(F.col(YEAR).isin(years))

    def load(self, raw: DataFrame) -> list[int]:
        """Take up a batch of raw ratings; loading it again changes nothing. Returns the years written.

        The batch and the stored rows of its years are folded by key in one shuffle, and the outcome is
        stored before the years in which it changes something are written.
        """
        ensure_checkpoint_dir(self.spark)
        year = F.coalesce(rating_fn.rating_year(F.col("timestamp")), F.lit(UNDATED)).alias(YEAR)
        fresh = raw.filter(HAS_KEY).select(*KEYS, "rating", year)
        years = _years(fresh)
        if not years:
            return []
        both = self._stored(years).select(*KEYS, "rating", YEAR, F.lit(True).alias("old"))
        both = both.unionByName(fresh.withColumn("old", F.lit(False)))
        merged = (
            both.groupBy(*KEYS, YEAR)
            .agg(
                F.max("rating").alias("rating"),
                F.max(F.when(F.col("old"), F.col("rating"))).alias("old_rating"),
                F.max("old").alias("known"),
            )
            # A new key, or a higher rating than the stored one; nulls are the lowest.
            .withColumn("changed", ~F.col("known") | ~F.col("rating").eqNullSafe(F.col("old_rating")))
            .select(*KEYS, "rating", YEAR, "changed")
            .checkpoint()
        )
        changed = _years(merged.filter("changed"))
        if changed:
            writer = merged.filter(F.col(YEAR).isin(changed)).drop("changed").write.mode("overwrite")
            writer = writer.option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            with open_side_by_side(self.spark):
                writer.partitionBy(YEAR).parquet(self.path)
        return changed

    def cleaned(self, years: list[int] | None = None) -> DataFrame:
        """As ``silver.clean_ratings`` over all batches, or over given years of them."""
        return rating_fn.cleaned(self._stored(years).drop(YEAR))


def _years(rows: DataFrame) -> list[int]:
    """The few years that ``rows`` are of."""
    return [r[0] for r in rows.select(YEAR).distinct().orderBy(YEAR).collect()]
