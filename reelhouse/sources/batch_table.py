"""A table of batches in plain Parquet: each batch is a folder that a rerun replaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.schemas import conform

BATCH = "batch_id"


def stored_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet table at ``path``, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class BatchTable:
    """Rows below ``path``, partitioned by batch.

    A batch is written with Spark's dynamic partition overwrite, so a job that runs again puts its own
    rows in the place of those of its last run, and touches no other batch's files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str):
        given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = [f for f in given if f.name != BATCH]
        self.spark, self.path = spark, path
        self.schema = T.StructType([*fields, T.StructField(BATCH, T.StringType())])

    def write(self, rows: DataFrame, batch_id: str | Column, counts: Sequence[Column] = ()) -> dict[str, int]:
        """Store a batch, or with a column several at once; ``counts`` are taken in the writing pass."""
        batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
        rows = conform(rows.withColumn(BATCH, batch), self.schema)
        seen = Observation()
        if counts:
            rows = rows.observe(seen, *counts)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH).parquet(self.path)
        return seen.get if counts else {}

    def read(self, *batches: str) -> DataFrame:
        """All rows, or those of ``batches`` alone: no other folder is read."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.filter(F.col(BATCH).isin(*batches)) if batches else rows

    def sizes(self) -> DataFrame:
        """Rows of each batch: batch_id and rows."""
        return self.read().groupBy(BATCH).agg(F.count("*").alias("rows"))
