"""Business reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.operators.dedup import first_per_key
from reelhouse.operators.lookups import left_lookup, left_lookup_few


def _display(movies: DataFrame) -> DataFrame:
    return movies.select("movieId", F.col("title_clean").alias("title"), "genres")


def user_recommendations(
    recommendations: DataFrame, movies: DataFrame, user_id: int, limit: int = 10
) -> DataFrame:
    """A user's best-scored movies with their titles and genres."""
    best = (
        recommendations.filter(F.col("userId") == user_id)
        .select("userId", "movieId", "predicted_score")
        .orderBy(F.desc("predicted_score"), "movieId")
        .limit(limit)
    )
    return (
        left_lookup_few(best, _display(movies), "movieId", limit)
        .select(
            F.col("userId").alias("user_id"),
            F.col("movieId").alias("movie_id"),
            "title",
            "genres",
            "predicted_score",
        )
        .orderBy(F.desc("predicted_score"), "movie_id")
    )


def most_recommended_movies(
    recommendations: DataFrame, movies: DataFrame, limit: int = 10
) -> DataFrame:
    """Movies recommended to the most users.

    Counting needs no titles, so titles are looked up for the winners only.
    """
    winners = (
        recommendations.groupBy("movieId")
        .agg(
            F.count("*").alias("times_recommended"),
            F.round(F.avg("predicted_score"), 3).alias("avg_predicted_score"),
        )
        .orderBy(F.desc("times_recommended"), F.desc("avg_predicted_score"), "movieId")
        .limit(limit)
    )
    return (
        left_lookup_few(winners, _display(movies), "movieId", limit)
        .select(
            F.col("movieId").alias("movie_id"),
            "title",
            "genres",
            "times_recommended",
            "avg_predicted_score",
        )
        .orderBy(F.desc("times_recommended"), F.desc("avg_predicted_score"), "movie_id")
    )


def top_genre_by_decade(
    stats: DataFrame, min_ratings: int = fixed.TOP_GENRE_MIN_RATINGS
) -> DataFrame:
    """Best-rated genre of each decade among genres with enough ratings."""
    eligible = stats.filter(
        (F.col("total_ratings") > min_ratings) & F.col("decade").isNotNull()
    )
    best = first_per_key(eligible, ["decade"], [F.desc("avg_rating"), F.asc("genre")])
    return best.select(
        "decade",
        F.col("genre").alias("top_genre"),
        F.col("avg_rating").alias("average_rating"),
        "total_ratings",
    ).orderBy(F.desc("decade"))


def prediction_diversity(recommendations: DataFrame, limit: int = 10) -> DataFrame:
    """Users whose predicted scores spread the most.

    The spread is the sample deviation, NULL (and last) for a single score.
    """
    score = F.col("predicted_score")
    return (
        recommendations.groupBy(F.col("userId").alias("user_id"))
        .agg(
            F.round(F.avg(score), 3).alias("avg_prediction"),
            F.round(F.stddev_samp(score), 3).alias("stddev_prediction"),
            F.round(F.max(score) - F.min(score), 3).alias("score_range"),
        )
        .orderBy(F.desc_nulls_last("stddev_prediction"), "user_id")
        .limit(limit)
    )


def rating_percentages(distribution: DataFrame) -> DataFrame:
    """Share of every rating value in all ratings."""
    grand_total = distribution.agg(F.sum("total")).scalar()
    share = F.try_divide(F.col("total"), grand_total) * 100
    return distribution.select(
        "rating",
        F.col("total").alias("total_ratings"),
        F.round(share, 2).alias("percentage"),
    ).orderBy(F.desc("rating"))


def novelty_vs_classic(recommendations: DataFrame, movies: DataFrame) -> DataFrame:
    """Recommendations of recent movies against the rest.

    Movies of unknown year form a row of their own under the "classic" label.
    Recommendations are folded per movie before the join, so a movie that is
    recommended to very many users is one row by then.
    """
    per_movie = recommendations.groupBy("movieId").agg(
        F.count("*").alias("n"),
        F.sum("predicted_score").alias("score"),
        F.count("predicted_score").alias("scored"),
    )
    mean = F.sum("score") / F.nullif(F.sum("scored"), F.lit(0))
    label = F.when(F.col("is_recent"), fixed.RECENT_LABEL).otherwise(fixed.CLASSIC_LABEL)
    return (
        left_lookup(per_movie, movies.select("movieId", "is_recent"), "movieId")
        .groupBy("is_recent")
        .agg(
            F.sum("n").alias("total_recommendations"),
            F.round(mean, 3).alias("avg_predicted_score"),
        )
        .select(label.alias("category"), "total_recommendations", "avg_predicted_score")
    )


def user_score_summary(
    recommendations: DataFrame, user_id: int, limit: int = 10
) -> DataFrame:
    """Mean and best predicted score of the recommendations shown to a user."""
    shown = (
        recommendations.filter(F.col("userId") == user_id)
        .orderBy(F.desc("predicted_score"), "movieId")
        .limit(limit)
    )
    score = F.col("predicted_score")
    return shown.agg(
        F.avg(score).alias("avg_predicted_score"),
        F.max(score).alias("max_predicted_score"),
    )


def recommendations_with_titles(
    recommendations: DataFrame, dimension: DataFrame, user_id: int
) -> DataFrame:
    """Title and score of a user's recommendations found in the movie dimension."""
    mine = recommendations.filter(F.col("userId") == user_id).select(
        F.col("movieId").alias("movie_id"), "predicted_score"
    )
    return mine.join(dimension, "movie_id").select("title", "predicted_score")


def nested_recommendations_with_titles(
    documents: DataFrame, dimension: DataFrame, user_id: int
) -> DataFrame:
    """The same answer from the table that nests one list per user."""
    mine = documents.filter(F.col("user_id") == user_id).select(F.inline("items"))
    return mine.join(dimension, "movie_id").select("title", "predicted_score")
