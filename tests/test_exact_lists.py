"""Exact top lists without all products, and how good they are on held-out ratings."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.operators import pruned_products
from reelhouse.plans import evaluation
from tests.conftest import rows_of


def plain_lists(users, items, k):
    out = {}
    for u, a in users:
        scored = []
        for i, b in items:
            total = 0.0
            for x, y in zip(a, b):
                total += x * y
            scored.append((-total, i))
        out[u] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def lists_of(df):
    return {r.user: list(zip(r["items"], r.scores)) for r in df.collect()}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, vector array<double>, items string")


@pytest.mark.parametrize("sign", [False, True])
@pytest.mark.parametrize("chunk", [1_000, 37])
def test_lists_are_those_of_all_products(spark, sign, chunk):
    draw = np.random.default_rng(3)
    spread = draw.pareto(2, 200)[:, None]
    make = lambda n: draw.normal(size=(n, 6)) if sign else np.abs(draw.normal(size=(n, 6)))
    items = [(i, v.tolist()) for i, v in enumerate(make(200) * spread)]
    items += [(500 + n, items[3][1]) for n in range(12)]  # ties
    users = [(i, v.tolist()) for i, v in enumerate(make(90))] + [(900, [0.0] * 6)]
    odd = [(None, [1.0] * 6), (901, None), (902, [math.nan] + [1.0] * 5), (903, [None] + [1.0] * 5), (904, [math.inf] * 6)]
    of = lambda rows: vectors(spark, [(i, v, "x") for i, v in rows])
    found = pruned_products.top_products(of(users + odd), of(items + odd), 10, chunk)
    assert lists_of(found) == plain_lists(users, items, 10)
    assert found.columns == ["user", "items", "scores", "multiplied"]


def test_few_and_no_items(spark):
    users = vectors(spark, [(1, [1.0, 2.0], "x"), (2, [0.0, -1.0], "x")])
    items = vectors(spark, [(7, [1.0, 1.0], "x"), (8, [2.0, 0.5], "x")])
    assert lists_of(pruned_products.top_products(users, items, 10)) == {1: [(7, 3.0), (8, 3.0)], 2: [(8, -0.5), (7, -1.0)]}
    assert lists_of(pruned_products.top_products(users, items.limit(0), 10)) == {1: [], 2: []}
    assert pruned_products.top_products(users.limit(0), items, 10).count() == 0


def test_bounds_spare_products(spark):
    """Items of very different lengths: most blocks are never multiplied."""
    draw = np.random.default_rng(8)
    lengths = 1 / np.arange(1, 20_001) ** 0.7
    items = np.abs(draw.normal(size=(20_000, 8))) * lengths[:, None]
    users = np.abs(draw.normal(size=(64, 8)))
    ids, scores = np.full((64, 10), np.iinfo(np.int64).max), np.full((64, 10), -np.inf)
    taken = pruned_products.improve(users, pruned_products.Blocks(np.arange(20_000), items), 10, ids, scores)
    exact = pruned_products.products(users, items)
    assert (scores == -np.sort(-exact, axis=1)[:, :10]).all()
    assert taken.sum() < 0.1 * 64 * 20_000


def test_nothing_passes_through_the_driver(spark, monkeypatch):
    """Neither items nor lists are collected, and a chunk more is no job more."""
    collected = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "toArrow", lambda df: collected.append(df))
    draw = np.random.default_rng(5)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(np.abs(draw.normal(size=(300, 4))))]
    jobs = lambda group: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    taken = {}
    for chunk in (300, 30):
        spark.sparkContext.setJobGroup(f"lists {chunk}", "")
        pruned_products.top_products(vectors(spark, rows), vectors(spark, rows), 10, chunk).collect()
        taken[chunk] = jobs(f"lists {chunk}")
    spark.sparkContext.setJobGroup("", "")
    assert taken[30] == taken[300] and not collected


def test_many_equal_products_stay_small():
    """A first block in which all items tie: exact products are taken of pairs, not of copies of vectors."""
    import tracemalloc

    users, items = np.ones((4_096, 64)), np.ones((256, 64))
    ids, scores = np.full((4_096, 10), np.iinfo(np.int64).max), np.full((4_096, 10), -np.inf)
    tracemalloc.start()
    pruned_products.improve(users, pruned_products.Blocks(np.arange(256), items), 10, ids, scores)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (ids == np.arange(10)).all() and peak < 300 * 1024**2


def test_holdout_is_a_repeatable_share(sample):
    ratings = sample.ratings_clean()
    kept, held = evaluation.split(ratings)
    assert kept.count() + held.count() == ratings.count()
    assert abs(held.count() / ratings.count() - evaluation.HELD_SHARE) < 0.02
    again = evaluation.split(ratings.repartition(5, F.rand()))[1]
    assert held.exceptAll(again).isEmpty() and again.exceptAll(held).isEmpty()


def test_metrics_by_hand(spark):
    lists = spark.createDataFrame(
        [(1, 10, 0.9), (1, 11, 0.8), (1, 12, 0.8), (2, 10, 0.5), (3, 10, 0.1)], "userId int, movieId int, predicted_score double"
    )
    held = spark.createDataFrame(
        [(1, 11, 5.0), (1, 11, 4.0), (1, 12, 4.0), (1, 99, 4.5), (1, 10, 2.0), (2, 12, 4.0), (3, 10, 3.0), (4, 10, 5.0)],
        "userId int, movieId int, rating double",
    )
    found = {r.userId: r for r in evaluation.user_quality(lists, held, k=2).collect()}
    gain = 1 / math.log2(3)
    assert set(found) == {1, 2, 4}
    assert (found[1].relevant, found[1].hits) == (3, 1) and abs(found[1].gain - gain) < 1e-12
    assert abs(found[1].ideal - (1 + gain)) < 1e-12 and found[4].hits == 0
    report = evaluation.ranking_quality(evaluation.user_quality(lists, held, k=2), k=2).first()
    assert report.judged_users == 3 and report.precision == round(0.5 / 3, 6)
    assert report.recall == round(1 / 9, 6) and report.ndcg == round(gain / (1 + gain) / 3, 6)
    none = evaluation.ranking_quality(evaluation.user_quality(lists, held.limit(0))).first()
    assert none.judged_users == 0 and none.precision is None


def test_a_model_beats_the_mean_on_held_out_ratings(spark):
    """Ratings that follow users' and movies' factors: the model's error is well below the spread."""
    draw = np.random.default_rng(0)
    users, movies = draw.uniform(0.3, 1.5, (80, 2)), draw.uniform(0.3, 1.5, (60, 2))
    rows = [
        (u, m, float(users[u] @ movies[m] + draw.normal(0, 0.05)), 1000 * u + m)
        for u in range(80) for m in range(60) if draw.random() < 0.6
    ]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")
    report = evaluation.holdout_report(ratings, blocks=2).first()
    _, held = evaluation.split(ratings)
    spread = held.agg(F.stddev("rating")).first()[0]
    assert report.kept_ratings + report.held_ratings == len(rows)
    assert report.rmse < 0.5 * spread and report.mae <= report.rmse
    counted = defaultdict(int)
    for r in held.filter(F.col("rating") >= evaluation.RELEVANT_FROM).collect():
        counted[r.userId] += 1
    assert report.judged_users == len(counted)
