"""Aggregate layer computed from the enriched ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.ratings import rounded_mean
from reelhouse.operators.lookups import left_lookup, rows_with_key_in


def genre_decade_stats(enriched: DataFrame) -> DataFrame:
    """Mean rating and number of ratings per genre and release decade.

    Ratings are folded per genre list and decade first. Only those few rows are
    exploded into genres, so no rating is copied or shuffled once per genre.
    """
    folded = (
        enriched.filter(F.col("genre_list").isNotNull() & F.col("decade").isNotNull())
        .groupBy("genre_list", "decade")
        .agg(
            F.sum("rating").alias("stars"),
            F.count("rating").alias("rated"),
            F.count("*").alias("n"),
        )
    )
    genre = F.explode("genre_list").alias("genre")
    mean = rounded_mean(F.sum("stars"), F.nullif(F.sum("rated"), F.lit(0)))
    return (
        folded.select(genre, "decade", "stars", "rated", "n")
        .groupBy("genre", "decade")
        .agg(mean.alias("avg_rating"), F.sum("n").alias("total_ratings"))
    )


def rating_distribution(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("rating").agg(F.count("*").alias("total"))


def movie_lookup(enriched: DataFrame) -> DataFrame:
    """Distinct movies of the fact table with their display columns."""
    return enriched.select("movieId", "title_clean", "genres").distinct()


def enrich_recommendations(scores: DataFrame, movies: DataFrame) -> DataFrame:
    """Scores with title and genres; a movie without a row keeps NULLs."""
    names = movies.select("movieId", F.col("title_clean").alias("title"), "genres")
    return left_lookup(scores, names, "movieId").select(
        "userId", "movieId", "title", "genres", "predicted_score"
    )


def recommended_movies(movies: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Movie dimension restricted to movies that are recommended to someone."""
    return rows_with_key_in(movies, recommendations, "movieId").select(
        F.col("movieId").alias("movie_id"), "title", "genres"
    )
