"""Aggregates that are kept up batch by batch.

Each batch leaves its own partial sums. They are few rows, and add up: a new batch is the only one
that is read, and a batch that is loaded again replaces its own partials (dynamic partition overwrite
by ``batch_id``). Readers add the partials up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.ratings import rounded_mean
from reelhouse.session import ensure_checkpoint_dir
from reelhouse.sources.batch_table import BatchTable

GENRE_DECADE = "genre string, decade int, stars double, rated long, n long"
DISTRIBUTION = "rating double, n long"


def _fold(enriched: DataFrame) -> DataFrame:
    """Ratings folded per genre list, decade and rating, before any is copied once per genre."""
    sums = (F.sum("rating").alias("stars"), F.count("rating").alias("rated"), F.count("*").alias("n"))
    return enriched.groupBy("genre_list", "decade", "rating").agg(*sums)


def _genre_decade_of(folded: DataFrame) -> DataFrame:
    known = folded.filter(F.col("genre_list").isNotNull() & F.col("decade").isNotNull())
    return (
        known.select(F.explode("genre_list").alias("genre"), "decade", "stars", "rated", "n")
        .groupBy("genre", "decade")
        .agg(*[F.sum(c).alias(c) for c in ("stars", "rated", "n")])
    )


def genre_decade_partials(enriched: DataFrame) -> DataFrame:
    """Sum, number of rated rows and number of rows per genre and decade."""
    return _genre_decade_of(_fold(enriched))


def distribution_partials(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("rating").agg(F.count("*").alias("n"))


class PartialTables:
    """Partials of both aggregates below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.genre_decade = BatchTable(spark, f"{root}/genre_decade", GENRE_DECADE)
        self.distribution = BatchTable(spark, f"{root}/distribution", DISTRIBUTION)

    def load(self, enriched: DataFrame, batch_id: str) -> None:
        """Take up a batch of cleaned ratings, or put it in the place of an earlier load of it."""
        ensure_checkpoint_dir(enriched.sparkSession)
        # Both aggregates come from one fold, so that the ratings are made and read once.
        folded = _fold(enriched).checkpoint()
        self.genre_decade.write(_genre_decade_of(folded), batch_id)
        self.distribution.write(folded.groupBy("rating").agg(F.sum("n").alias("n")), batch_id)

    def genre_decade_stats(self) -> DataFrame:
        """As ``gold.genre_decade_stats`` over all batches."""
        mean = rounded_mean(F.sum("stars"), F.nullif(F.sum("rated"), F.lit(0)))
        return self.genre_decade.read().groupBy("genre", "decade").agg(
            mean.alias("avg_rating"), F.sum("n").alias("total_ratings")
        )

    def rating_distribution(self) -> DataFrame:
        """As ``gold.rating_distribution`` over all batches."""
        return self.distribution.read().groupBy("rating").agg(F.sum("n").alias("total"))
