"""Cleaned and enriched layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import movies as movie_fn
from reelhouse.functions import ratings as rating_fn
from reelhouse.operators.dedup import first_per_key
from reelhouse.operators.lookups import left_lookup


def clean_movies(movies: DataFrame) -> DataFrame:
    """One row per movie (the latest ingested) with its title and genres parsed.

    The result is rebalanced: stored, it gives well-sized files. Joined in the
    same plan, the join gets shuffles of its own on both sides, which is what
    adaptive execution needs to split a hot movie's ratings; it would not if the
    join rode on the dedupe's shuffle.
    """
    order = [F.asc_nulls_last("title"), F.asc_nulls_last("genres")]
    if "ingestion_timestamp" in movies.columns:
        order.insert(0, F.desc("ingestion_timestamp"))
    known = movies.filter(F.col("movieId").isNotNull())
    year = movie_fn.release_year(F.col("title"))
    return (
        first_per_key(known, ["movieId"], order)
        .hint("rebalance")
        .withColumn("release_year", year)
        .select(
            "movieId",
            movie_fn.clean_title(F.col("title")).alias("title_clean"),
            "genres",
            movie_fn.genre_list(F.col("genres")).alias("genre_list"),
            "release_year",
            movie_fn.decade_of(F.col("release_year")).alias("decade"),
            movie_fn.is_recent(F.col("release_year")).alias("is_recent"),
        )
    )


def winners(ratings: DataFrame) -> DataFrame:
    """One rating per user, movie and second: the highest, in range or not.

    The key holds everything but the rating, so the dedupe is a plain hash
    aggregate: copies fold inside each task and no task sorts. Key filters come
    before it because they cannot change which copy wins.
    """
    keyed = ratings.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull())
    return keyed.groupBy("userId", "movieId", "timestamp").agg(F.max("rating").alias("rating"))


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per user, movie and second (the highest), in range, with dates.

    The range filter comes after the dedupe because it can change which copy wins.
    """
    return rating_fn.cleaned(winners(ratings))


def clean_tags(tags: DataFrame) -> DataFrame:
    """One row per user, movie and raw tag (the earliest), lower-cased and trimmed.

    Folding happens on the raw text, so spellings of one tag stay separate rows.
    """
    return (
        tags.filter(rating_fn.has_text(F.col("tag")))
        .groupBy("userId", "movieId", "tag")
        .agg(F.min("timestamp").alias("timestamp"))
        .select(
            "userId",
            "movieId",
            rating_fn.normalized_tag(F.col("tag")).alias("tag"),
            "timestamp",
        )
    )


def clean_and_enrich(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``enrich_ratings`` of the cleaned ratings; what follows from a rating is added after
    the join, so that none of it is shuffled with the rating.
    """
    return rating_fn.dated(enrich_ratings(rating_fn.in_range(winners(ratings)), movies))


def enrich_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Cleaned ratings with their movie's columns; unknown movies stay, as NULLs."""
    return left_lookup(ratings, movies, "movieId")
