"""How good recommendations are, on ratings that were held out of the training.

Ratings are drawn by a hash of their own key, so the same ones are held out on any cluster. Errors
and ranked metrics are aggregates over joined lists; no user's rows are gathered in Python.
"""

from __future__ import annotations

import math

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.plans import recommender
from reelhouse.session import ensure_checkpoint_dir

HELD_SHARE = 0.2
#: A held-out rating from here on makes its movie a relevant one.
RELEVANT_FROM = 4.0
DIGITS = 6


def is_held(share: float = HELD_SHARE, seed: int = fixed.SAMPLE_SEED) -> Column:
    """Whether a rating is held out; independent of the training sample's own draw."""
    key = F.concat_ws(":", F.lit("held"), F.lit(seed), "userId", "movieId", "timestamp")
    return recommender.hash_bucket(key) < int(round(share * recommender.HASH_BUCKETS))


def split(ratings: DataFrame, share: float = HELD_SHARE, seed: int = fixed.SAMPLE_SEED) -> tuple[DataFrame, DataFrame]:
    """Ratings to train on, and those held out."""
    held = is_held(share, seed)
    return ratings.filter(~held), ratings.filter(held)


def rating_errors(scored: DataFrame) -> DataFrame:
    """scored_ratings, rmse and mae of rows with rating and predicted_score."""
    off = F.col("predicted_score") - F.col("rating")
    return scored.agg(
        F.count("*").alias("scored_ratings"),
        F.round(F.sqrt(F.avg(off * off)), DIGITS).alias("rmse"),
        F.round(F.avg(F.abs(off)), DIGITS).alias("mae"),
    )


def _gain(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank + F.lit(1.0))


def _ideal(relevant: Column, k: int) -> Column:
    """The gain of a list that begins with all relevant movies."""
    sums = [0.0]
    for rank in range(1, k + 1):
        sums.append(sums[-1] + 1.0 / math.log2(rank + 1))
    return F.element_at(F.array(*map(F.lit, sums)), F.least(relevant, F.lit(k)).cast("int") + 1)


def user_quality(
    lists: DataFrame, held: DataFrame, k: int = fixed.RECOMMENDATIONS_PER_USER, relevant_from: float = RELEVANT_FROM
) -> DataFrame:
    """Per user with a relevant held-out movie: userId, relevant, hits, gain, ideal.

    ``lists`` has userId, movieId and predicted_score; its best ``k`` rows of each user count, of equal
    scores the smaller movie. A user without a list has no hits.
    """
    wanted = held.filter(F.col("rating") >= relevant_from).select("userId", "movieId").distinct()
    place = F.expr("row_number() over (partition by userId order by predicted_score desc, movieId)")
    ranked = lists.select("userId", "movieId", "predicted_score").withColumn("rank", place).filter(F.col("rank") <= k)
    judged = wanted.join(ranked.select("userId", "movieId", "rank"), ["userId", "movieId"], "left")
    by_user = judged.groupBy("userId").agg(
        F.count("*").alias("relevant"),
        F.count("rank").alias("hits"),
        F.coalesce(F.sum(_gain(F.col("rank"))), F.lit(0.0)).alias("gain"),
    )
    return by_user.withColumn("ideal", _ideal(F.col("relevant"), k))


def ranking_quality(by_user: DataFrame, k: int = fixed.RECOMMENDATIONS_PER_USER) -> DataFrame:
    """judged_users, precision, recall and ndcg at ``k`` as means over users; null of none."""
    mean = lambda c: F.round(F.avg(c), DIGITS)
    return by_user.agg(
        F.count("*").alias("judged_users"),
        mean(F.col("hits") / F.lit(float(k))).alias("precision"),
        mean(F.col("hits") / F.col("relevant")).alias("recall"),
        mean(F.col("gain") / F.col("ideal")).alias("ndcg"),
    )


def scored_holdout(model: ALSModel, held: DataFrame) -> DataFrame:
    """The held-out ratings whose user and movie the model knows, with predicted_score."""
    rows = model.transform(held.select("userId", "movieId", "rating"))
    return rows.select("userId", "movieId", "rating", F.col("prediction").cast("double").alias("predicted_score"))


def holdout_report(
    ratings: DataFrame, share: float = HELD_SHARE, seed: int = fixed.SAMPLE_SEED, blocks: int = fixed.ALS_BLOCKS
) -> DataFrame:
    """One row: how a model of the kept ratings does on those held out, with its lists' quality."""
    # Stored: the ratings would be made and drawn once for the training and for each metric.
    ensure_checkpoint_dir(ratings.sparkSession)
    drawn = ratings.select("userId", "movieId", "rating", is_held(share, seed).alias("held")).checkpoint()
    kept, held = (drawn.filter(F.col("held") == whether).drop("held") for whether in (False, True))
    model = recommender.train(kept, seed, blocks)
    errors = rating_errors(scored_holdout(model, held))
    ranking = ranking_quality(user_quality(recommender.top_scores(model), held))
    whole = lambda row: row.select(F.struct("*")).scalar()
    return kept.agg(F.count("*").alias("kept_ratings")).select(
        "kept_ratings",
        held.agg(F.count("*")).scalar().alias("held_ratings"),
        whole(errors).alias("errors"),
        whole(ranking).alias("ranking"),
    ).select("kept_ratings", "held_ratings", "errors.*", "ranking.*")
