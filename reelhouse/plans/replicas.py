"""Serving copies of gold and window results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators.quality import QualityError
from reelhouse.operators.running import ROWS_PER_PART, place_in_key
from reelhouse.plans.gold import recommended_movies
from reelhouse.session import ensure_checkpoint_dir
from reelhouse.sources.lake import LakeTable


# Items of one nested row. A user with more has further rows.
PAGE_ITEMS = 1_000


def user_documents(
    recommendations: DataFrame, page_items: int = PAGE_ITEMS, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """A user's recommendations nested, best first, in pages of ``page_items``.

    Scores that are missing come last, equal ones go by movie. Page 0 holds the best,
    and a user of any size is kept whole, with a bounded number of items a row. A large user's rows
    are split by score before any of them are ordered.
    """
    rows = recommendations.select(
        F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), "predicted_score"
    )
    best_first = [F.desc_nulls_last("predicted_score"), F.col("movie_id")]
    placed = place_in_key(rows, "user_id", best_first, "place", rows_per_part)
    items = F.sort_array(F.collect_list(F.struct("place", "movie_id", "predicted_score")))
    page = F.floor(F.col("place") / page_items).cast("int").alias("page")
    return placed.groupBy("user_id", page).agg(
        F.transform(items, lambda i: i.dropFields("place")).alias("items")
    )


def latest_activity(activity: DataFrame, rows: int = 20_000) -> DataFrame:
    """The newest window rows, for a bounded mirror."""
    return activity.orderBy(F.desc("window_end"), "genre").limit(rows)


def for_point_reads(df: DataFrame, key: str) -> DataFrame:
    """Range-partition and sort by ``key``, so a lookup reads one row group."""
    return df.repartitionByRange(key).sortWithinPartitions(key)


def store_buckets(rows: DataFrame, table: str, path: str, key: str, buckets: int = 64) -> None:
    """Store ``rows`` as a catalog table at ``path``, in ``buckets`` by hash of ``key``.

    One task writes a bucket, sorted by key. A lookup of one key opens the files of one bucket.
    """
    dealt = rows.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    writer.format("parquet").saveAsTable(table)


def require_unique(flat: DataFrame) -> None:
    """Fail on a repeated (user, movie)."""
    copies = flat.groupBy("user_id", "movie_id").agg(F.count("*").alias("copies"))
    most = copies.agg(F.max("copies")).first()[0]
    if (most or 0) > 1:
        raise QualityError(f"a repeated (user_id, movie_id) occurs {most} times")


class ServingTables:
    """Copies of gold and window results for point reads, replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str):
        def table(name, schema):
            return LakeTable(spark, f"{root}/{name}", schema)

        self.recommendations = table(
            "user_recommendations", schemas.USER_RECOMMENDATIONS
        )
        self.documents = table("gold_user_recommendations", schemas.USER_DOCUMENTS)
        self.movies = table("dim_movie", schemas.DIM_MOVIE)
        self.activity = table("genre_activity_mirror", schemas.GENRE_ACTIVITY)

    def reload_recommendations(self, recommendations: DataFrame) -> None:
        """Replace the flat and the nested copy, after a check of their keys.

        The input is computed once, into the shared checkpoint folder.
        """
        ensure_checkpoint_dir(recommendations.sparkSession)
        scores = recommendations.select("userId", "movieId", "predicted_score").checkpoint()
        flat = scores.withColumnsRenamed({"userId": "user_id", "movieId": "movie_id"})
        require_unique(flat)
        self.recommendations.overwrite(for_point_reads(flat, "user_id"))
        self.documents.overwrite(for_point_reads(user_documents(scores), "user_id"))

    def reload_movies(self, movies: DataFrame, recommendations: DataFrame) -> None:
        self.movies.overwrite(recommended_movies(movies, recommendations))

    def reload_activity(self, activity: DataFrame, rows: int = 20_000) -> None:
        self.activity.overwrite(latest_activity(activity, rows))
