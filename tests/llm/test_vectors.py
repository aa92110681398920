"""Exact search and nearest neighbours against all pairs."""

import math
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import int8_neighbours, segment_search
from reelhouse.llm.tiles import finite_vectors
from tests.conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, vec string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in vectors], SCHEMA)


def all_pairs(vectors, every, k, scale=None):
    ready = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [float(np.float32(c)) for c in v]
        if scale:
            x = [math.floor(scale * c) for c in x]
        elif not any(x):
            continue
        ready[i] = x
    out = []
    for q in (i for i in ready if i % every == 0):
        scored = sorted(
            (-reduce(lambda t, p: t + p[0] * p[1], zip(ready[q], ready[c]), 0.0), c)
            for c in ready
            if c != q
        )
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def sample(seed, n=300, width=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    made = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, width))
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(made)]
    vectors[7] = (7, vectors[20][1])  # equal vectors: ties go to the smaller id
    vectors[8] = (8, vectors[20][1])
    odd = [
        (1000, None), (1020, []), (1001, [float("nan")] * width), (1003, [0.0] * width),
        (1002, [float("inf")] * width), (1004, [None, 1.0]), (1040, [0.5, -0.25]), (None, [1.0]),
    ]
    return vectors + odd


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 40, "block_queries": 7}])
def test_exact_top_k_equals_all_pairs(spark, blocks):
    vectors = sample(1)
    found = segment_search.exact_top_k(table(spark, vectors), F.col("vec_id") % 20 == 0, 10, **blocks)
    assert sorted(rows_of(found)) == all_pairs(vectors, 20, 10, 1024)


@pytest.mark.parametrize("size", [1e4, 1e5, 1e6, 1e9, 1e18])
def test_products_beyond_53_bits_are_exact(spark, size):
    """Components whose products need Python's numbers; beyond a long, the ends of long count."""
    rng = np.random.default_rng(4)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(0, size, 16)]) for i in range(60)]
    found = segment_search.exact_top_k(table(spark, vectors), F.col("vec_id") % 20 == 0, 10)
    whole = {i: [min(math.floor(1024 * x), (1 << 63)) for x in v] for i, v in vectors}
    whole = {i: [max(x, -(1 << 63)) for x in v] for i, v in whole.items()}
    most = (1 << 63) - 1
    expected = []
    for q in range(0, 60, 20):
        product = lambda c: sum(a * b for a, b in zip(whole[q], whole[c]))  # noqa: B023, E731
        scored = sorted((-min(max(product(c), -most), most), c) for c in whole if c != q)
        expected += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:10])]
    assert sorted(rows_of(found)) == expected


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 40, "block_queries": 7}])
def test_neighbours_equal_all_pairs(spark, blocks):
    vectors = sample(2)
    found = int8_neighbours.nearest(table(spark, vectors), F.col("vec_id") % 20 == 0, 12, **blocks)
    assert sorted(rows_of(found)) == all_pairs(vectors, 20, 12)


def test_few_candidates_and_empty_tables(spark):
    few = table(spark, [(0, [1.0, 2.0]), (1, [3.0, 4.0])])
    none = table(spark, [])
    every = F.col("vec_id") >= 0
    assert sorted(rows_of(int8_neighbours.nearest(few, every, 5))) == [(0, 1, 1, 11.0), (1, 1, 0, 11.0)]
    assert rows_of(segment_search.exact_top_k(few, F.col("vec_id") == 0, 5, scale=1)) == [(0, 1, 1, 11)]
    assert not rows_of(int8_neighbours.nearest(none, every)) and not rows_of(
        segment_search.exact_top_k(none, every)
    )


def test_repeated_id_counts_once(spark):
    rows = table(spark, [(1, [2.0, 0.0]), (1, [2.0, 0.0]), (1, [1.0, 9.0]), (2, [1.0, 1.0])])
    assert sorted((r.vec_id, list(r.vec)) for r in finite_vectors(rows).collect()) == [
        (1, [1.0, 9.0]),
        (2, [1.0, 1.0]),
    ]


def test_segment_bounds_hold():
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(50, 30)), rng.normal(size=(60, 30))
    exact = q @ c.T
    for segments in (1, 4, 16, 30):
        bound = segment_search.segment_features(q, segments) @ segment_search.segment_features(c, segments).T
        assert (bound >= exact - 1e-9).all()
