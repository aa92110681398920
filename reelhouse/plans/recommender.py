"""Training of the recommender with MLlib's ALS, and exact top lists from its factors."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse.operators import pruned_products
from reelhouse.session import ensure_checkpoint_dir

HASH_BUCKETS = 1_000_000


def hash_bucket(key: Column) -> Column:
    """One of HASH_BUCKETS by MD5, so that any other engine can draw the same rows."""
    digits = F.substring(F.md5(key.cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % HASH_BUCKETS


def training_sample(
    enriched: DataFrame,
    fraction: float = fixed.SAMPLE_FRACTION,
    seed: int = fixed.SAMPLE_SEED,
) -> DataFrame:
    """A repeatable share of the ratings, without replacement.

    Membership is a hash of the rating's own key. Unlike ``DataFrame.sample`` it
    does not change with the partitioning, nor when a lost task is run again.
    """
    key = F.concat_ws(":", F.lit(seed), "userId", "movieId", "timestamp")
    chosen = enriched.filter(hash_bucket(key) < int(round(fraction * HASH_BUCKETS)))
    return chosen.select("userId", "movieId", "rating")


def train(
    sample: DataFrame, seed: int = fixed.SAMPLE_SEED, blocks: int = fixed.ALS_BLOCKS
) -> ALSModel:
    """Explicit-feedback ALS.

    The model depends on ``blocks``, so it is an argument and never taken from the
    cluster. Raise it for samples whose factor blocks outgrow a task. The sample is
    stored first: MLlib reads it twice, to see whether it has rows and to deal them.
    """
    ensure_checkpoint_dir(sample.sparkSession)
    sample = sample.checkpoint()
    als = ALS(
        maxIter=fixed.ALS_MAX_ITER,
        regParam=fixed.ALS_REG_PARAM,
        rank=fixed.ALS_RANK,
        nonnegative=True,
        coldStartStrategy="drop",
        userCol="userId",
        itemCol="movieId",
        ratingCol="rating",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=2,
        seed=seed,
    )
    return als.fit(sample)


def _vectors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    factors = (model.userFactors, model.itemFactors)
    return tuple(f.select("id", F.col("features").alias("vector")) for f in factors)


def top_lists(
    model: ALSModel, per_user: int = fixed.RECOMMENDATIONS_PER_USER, users: DataFrame | None = None
) -> DataFrame:
    """Each trained user's best movies: user, items, scores, multiplied.

    Bounds on blocks of movies spare most of the users x movies products, and the lists are exact:
    no movie outside one has a higher score. ``multiplied`` is the number of products a user took.
    """
    known, movies = _vectors(model)
    if users is not None:
        asked = users.select(F.col("userId").alias("id")).distinct()
        known = known.join(asked, "id", "left_semi")
    return pruned_products.top_products(known, movies, per_user)


def beaten_places(
    model: ALSModel, lists: DataFrame, per_user: int = fixed.RECOMMENDATIONS_PER_USER
) -> DataFrame:
    """``lists`` held against the scores of all users x movies: user, listed, beaten.

    MLlib's own scan of them keeps a heap for each user; this one only looks for scores above a list's.
    """
    return pruned_products.beaten_places(lists, *_vectors(model), per_user)


def top_scores(
    model: ALSModel,
    per_user: int = fixed.RECOMMENDATIONS_PER_USER,
    users: DataFrame | None = None,
) -> DataFrame:
    """The best movies of every trained user, one row each, score to 4 decimals.

    Equal scores go to the smaller movie. ``users`` (userId) scores those users alone, for
    incremental runs.
    """
    picks = top_lists(model, per_user, users).select(
        "user", F.explode(F.arrays_zip("items", "scores")).alias("pick")
    )
    return picks.select(
        F.col("user").cast("int").alias("userId"),
        F.col("pick.items").cast("int").alias("movieId"),
        F.round("pick.scores", 4).alias("predicted_score"),
    )
