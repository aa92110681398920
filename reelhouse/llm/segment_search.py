"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into equal segments; each keeps its mean and its deviation. For one segment of
length L, Cauchy-Schwarz on the centred parts gives
``<q, x> <= L * (mean_q * mean_x + dev_q * dev_x)``, and the sum over segments bounds the whole
product from above, that is, the distance ``-<q, x>`` from below. Finer segments bound more
tightly. Pairs that the coarse bound can't rule out meet the next one; only the survivors of all
levels get their exact product.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.tiles import best_per_query, finite_vectors, tiled_search

LEVELS = (4, 16)
QUERY_CHUNK = 128
PAIR_CHUNK = 16_384


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations per segment, scaled so that a dot product is the bound."""
    width = -(-vectors.shape[1] // segments)
    padded = np.zeros((len(vectors), width * segments))
    padded[:, : vectors.shape[1]] = vectors
    parts = padded.reshape(len(vectors), segments, width)
    return np.hstack([parts.mean(axis=2), parts.std(axis=2)]) * np.sqrt(width)


LONGEST = (1 << 63) - 1


def whole_type(q: np.ndarray, c: np.ndarray) -> type:
    """The narrowest type in which all products of whole numbers are exact."""
    largest = [int(np.abs(side).max(initial=0)) for side in (q, c)]
    most = q.shape[1] * largest[0] * largest[1]
    return float if most < 1 << 53 else np.int64 if most <= LONGEST else object


def _as_whole(vectors: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in vectors], object)
    return vectors.astype(kind)


def _products(q: np.ndarray, c: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Exact products as longs; those beyond are the largest or least long."""
    parts = []
    for at in range(0, len(qi), PAIR_CHUNK):
        pair = q[qi[at : at + PAIR_CHUNK]], c[ci[at : at + PAIR_CHUNK]]
        if q.dtype == object:
            exact = (pair[0] * pair[1]).sum(axis=1)
            parts.append(np.array([min(max(int(x), -LONGEST), LONGEST) for x in exact], np.int64))
        else:
            parts.append(np.einsum("ij,ij->i", *pair).astype(np.int64))
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def search_tile(query_ids, q, ids, c, k, levels=LEVELS):
    """The best ``k`` pairs of each query with the exact products of whole-number vectors."""
    query_features = [segment_features(q, s) for s in levels]
    features = [segment_features(c, s) for s in levels]
    kind = whole_type(q, c)
    whole_q, whole_c = _as_whole(q, kind), _as_whole(c, kind)
    # Rounding of a bound is a share of the product of both lengths.
    lengths = [np.sqrt((side**2).sum(axis=1)) for side in (q, c)]
    found = []
    for at in range(0, len(q), QUERY_CHUNK):
        chunk = slice(at, min(at + QUERY_CHUNK, len(q)))
        rows = np.arange(chunk.start, chunk.stop)
        own = query_ids[chunk, None] == ids[None, :]
        bound = query_features[0][chunk] @ features[0].T
        slack = 1e-12 * lengths[0][chunk, None] * lengths[1][None, :]
        bound[own] = -np.inf
        # The k candidates with the highest coarse bounds give a first threshold.
        n = min(k, len(ids))
        seeds = np.argpartition(-bound, n - 1, axis=1)[:, :n]
        seeded = _products(whole_q, whole_c, np.repeat(rows, n), seeds.ravel()).reshape(-1, n)
        seeded = seeded.astype(float)
        seeded[np.take_along_axis(own, seeds, axis=1)] = -np.inf
        least = seeded.min(axis=1) if n == k else np.full(len(rows), -np.inf)
        # Products are whole numbers: half a unit covers small ones.
        floor = (least - 0.5 - 1e-12 * np.abs(np.where(np.isfinite(least), least, 0)))[:, None]
        alive = (bound + slack >= floor) & ~own
        for query_level, level in zip(query_features[1:], features[1:]):
            columns = np.flatnonzero(alive.any(axis=0))
            finer = query_level[chunk] @ level[columns].T
            alive[:, columns] &= finer + slack[:, columns] >= floor
        qi, ci = np.nonzero(alive)
        qi += at
        score = _products(whole_q, whole_c, qi, ci)
        keep = best_per_query(qi, ci, score, ids, k)
        found.append((qi[keep], ci[keep], score[keep]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def exact_top_k(
    rows: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, **blocks
) -> DataFrame:
    """Each query's ``k`` highest integer inner products: query_id, rank, vec_id, score.

    ``rows`` has vec_id and embedding; a component x counts as floor(scale * x), x as double.
    Unusable rows and repeated ids are settled by ``finite_vectors``. Vectors of unequal length
    are compared on the components that both have. Products are exact; one that is no long counts
    as the largest or least one. No usable vector, or none but the query's own: no rows.
    """
    whole = finite_vectors(rows).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    )
    return tiled_search(whole, is_query, k, search_tile, "long", **blocks)
