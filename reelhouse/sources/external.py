"""Databases, through whichever connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def reload_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    batch_rows: int = 5000,
    connections: int = 8,
) -> None:
    """Replace a relational table's rows, keeping its definition and indexes."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=batch_rows, **properties)
        .option("numPartitions", connections)
        .option("truncate", True)
        .mode("overwrite")
        .save()
    )


def reload_collection(df: DataFrame, uri: str, database: str, collection: str) -> None:
    """Replace a document collection (needs the MongoDB connector for Spark)."""
    (
        df.write.format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .mode("overwrite")
        .save()
    )
