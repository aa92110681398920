"""Lists held against a scan of all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import registry
from reelhouse.operators import pruned_products
from reelhouse.plans import recommender
from tests.conftest import rows_of


def places(spark, lists, users, items, k=3, chunk=1_000):
    of = lambda rows: spark.createDataFrame(rows, "id long, vector array<double>")
    rows = spark.createDataFrame(lists, "user long, scores array<double>")
    return sorted(rows_of(pruned_products.beaten_places(rows, of(users), of(items), k, chunk)))


@pytest.mark.parametrize("scale", [1.0, 1e25])
@pytest.mark.parametrize("chunk", [1_000, 37])
def test_beaten_places_are_found(spark, chunk, scale):
    draw = np.random.default_rng(5)
    users, items = draw.normal(size=(40, 6)) * scale, draw.normal(size=(900, 6)) * scale
    best = -np.sort(-pruned_products.products(users, items), axis=1)[:, :3]
    lists = [list(map(float, x)) for x in best]
    lists[1][2] = float(np.nextafter(lists[1][2], -np.inf))  # below the true third by the least there is
    lists[2][0] = lists[2][1]  # still above the second of all
    lists[3] = lists[3][:2]
    lists[4] = [float("nan")] * 3
    expected = [(i, len(lists[i]), {1: 1, 2: 1, 3: 1, 4: 3}.get(i, 0)) for i in range(40)]
    rows = [(i, x) for i, x in enumerate(lists)]
    of = lambda vectors: [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert places(spark, rows, of(users), of(items), 3, chunk) == expected


def test_missing_and_odd_lists(spark):
    users, items = [(1, [1.0, 2.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], [(7, [1.0, 1.0]), (8, [2.0, 0.5])]
    lists = [(1, [3.0, 3.0]), (2, [2.0, 1.0, 0.5]), (9, [1.0, 1.0])]
    assert places(spark, lists, users, items) == [(1, 2, 0), (2, 3, 1), (3, 0, 2), (9, 2, 2)]
    assert places(spark, [(1, [])], users[:1], []) == [(1, 0, 0)]
    assert places(spark, lists[:1], [], items) == [(1, 2, 2)]


def test_mllib_agrees_and_does_not_scan(spark, sample, monkeypatch):
    """The scan finds what MLlib's finds; the query does without MLlib's."""
    model = recommender.train(sample.ratings_clean().filter("userId < 60").select("userId", "movieId", "rating"))
    every = model.recommendForAllUsers(10).select(
        F.col("userId").alias("user"), F.transform("recommendations", lambda x: x["rating"].cast("double")).alias("scores")
    )
    less = every.withColumn("scores", F.transform("scores", lambda x: x * 0.9999))
    higher = every.withColumn("scores", F.transform("scores", lambda x: x * 1.0001))
    total = lambda lists: recommender.beaten_places(model, lists).agg(F.sum("listed"), F.sum("beaten")).first()
    listed, beaten = total(less)
    assert listed == beaten == 10 * every.count() and total(higher)[1] == 0

    def scan(*_):
        raise AssertionError("MLlib's scan keeps a heap for each user")

    monkeypatch.setattr("pyspark.ml.recommendation.ALSModel.recommendForAllUsers", scan)
    assert registry.als_top_exact(sample).first().beaten == 0


def test_tiles_that_are_not_full():
    """Counts of better items are those of all products, whatever is left over in the last tiles."""
    draw = np.random.default_rng(7)
    users, items = draw.normal(size=(pruned_products.SCAN_USERS + 3, 4)), draw.normal(size=(5 * pruned_products.SCAN_ITEMS + 1, 4))
    items[-1] = 9  # the one that fills up the last tile is near every score of some users
    every = pruned_products.products(users, items)
    own = -np.sort(-every, axis=1)[:, [0, 2, 40]]
    own[5], own[6] = -np.inf, own[6] - 100  # every item beats these
    better = np.zeros(own.shape, np.int64)
    pruned_products.beating(users, items, own, better)
    assert np.array_equal(better, (every[:, None, :] > own[:, :, None]).sum(axis=2))


def test_a_tile_without_a_near_pair_is_not_searched(monkeypatch):
    """The highest product of a tile says that none of it is near a score."""
    draw = np.random.default_rng(8)
    users, items = draw.random((2_000, 6)), draw.random((4_096, 6))
    own = pruned_products.products(users, items).max(axis=1, keepdims=True)
    searched, search = [], pruned_products._true_places
    monkeypatch.setattr(pruned_products, "_true_places", lambda found: searched.append(found.size) or search(found))
    better = np.zeros(own.shape, np.int64)
    pruned_products.beating(users, items, own, better)
    assert not better.any() and sum(searched) < users.shape[0] * items.shape[0] / 2


def test_no_null_list_is_sent_to_the_scan(spark, monkeypatch):
    """Arrow's writer takes time with the square of a batch's null lists."""

    def nulls(*_):
        def run(batches):
            for rows in batches:
                columns = [[0], [rows.num_rows], [rows.column("scores").null_count]]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds)], names=["user", "listed", "beaten"])

        return run

    kinds = [pa.int64(), pa.int32(), pa.int32()]
    monkeypatch.setattr(pruned_products, "_places", nulls)
    sent = places(spark, [(1, [1.0])], [(1, [1.0]), (2, [2.0])], [(i, [0.5]) for i in range(50)])
    assert sum(n for _, n, _ in sent) == 52 and sum(n for _, _, n in sent) == 0


def test_groups_fill_all_cores_to_the_end(spark, monkeypatch):
    """More groups than cores are a multiple of the cores."""
    cores = spark.sparkContext.defaultParallelism
    users = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100)], "id long, vector array<double>")
    monkeypatch.setattr(pruned_products, "GROUP_BYTES", 100 * 8 * (2 + 2 * 3) / (cores + 0.5))
    assert pruned_products._groups(users, 3) == 2 * cores
