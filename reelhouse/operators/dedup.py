"""One row per key, with a defined winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The first row of each key under a total ``order``.

    Every task keeps one row per key before the shuffle (Spark's group limit
    for rank filters), so a key with a huge number of copies stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
