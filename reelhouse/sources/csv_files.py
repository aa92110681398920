"""Rating, movie, tag and recommendation files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import fixed_values as fixed
from reelhouse.schemas import MOVIES_CSV, RATINGS_CSV, TAGS_CSV


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, escape: str = '"'
) -> DataFrame:
    """CSV with a header under a fixed schema; malformed cells become NULL.

    Doubled quotes inside a quoted cell are one quote. ``escape="\\\\"`` gives
    Spark's default treatment, which leaves such titles quoted and yearless.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", escape)
        .csv(path)
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RATINGS_CSV)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, MOVIES_CSV)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TAGS_CSV)


def with_provenance(df: DataFrame, batch_id: str | Column) -> DataFrame:
    """Add when, from which file and in which batch each row was taken in."""
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return df.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.input_file_name().alias("source_file"),
        batch.alias("batch_id"),
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Compressed CSV with a header, or one plain file of data that is small."""
    out = df.coalesce(1) if single_file else df
    codec = "none" if single_file else "gzip"
    writer = out.write.mode("overwrite").option("compression", codec)
    writer.option("header", True).option("escape", '"').csv(path)


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, movie_id, predicted_score) from a file with any accepted headers."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    by_header = {c.lower().replace(" ", "_"): c for c in raw.columns}
    wanted = {
        "user_id": (fixed.USER_HEADERS, "int"),
        "movie_id": (fixed.MOVIE_HEADERS, "int"),
        "predicted_score": (fixed.SCORE_HEADERS, "double"),
    }
    columns, missing = [], []
    for name, (headers, data_type) in wanted.items():
        found = next((by_header[h] for h in headers if h in by_header), None)
        if found is None:
            missing.append(name)
        else:
            columns.append(F.col(f"`{found}`").cast(data_type).alias(name))
    if missing:
        raise ValueError(f"{path} has no column for {missing}; found {raw.columns}")
    return raw.select(*columns)
