"""Nearest neighbours by a block matrix join on int8 codes.

Inside a tile each vector is coded as ``scale * int8`` plus an error whose norm is known. Tiles
of integer products then give every inner product with a bound on its error:
``|<q, x> - <q', x'>| <= |q| |x - x'| + |q - q'| |x'|``. Pairs that may be among the best are
recomputed from the original vectors in double precision and go through one heap per query.
The bounds are never broken, so the result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.tiles import finite_vectors, tiled_search

QUERY_CHUNK = 256
CANDIDATE_CHUNK = 2_048
#: Sums of so many products of int8 codes are whole numbers that a float holds exactly.
EXACT_WIDTH = 1_024


class Codes:
    """int8 codes of the rows of a matrix, with their scales and error norms."""

    def __init__(self, vectors: np.ndarray):
        top = np.abs(vectors).max(axis=1)
        self.scale = np.where(top > 0, top / 127, 1.0)
        self.codes = np.rint(vectors / self.scale[:, None]).astype(np.int8)
        coded = self.codes * self.scale[:, None]
        self.norm = np.sqrt((vectors**2).sum(axis=1))
        self.coded_norm = np.sqrt((coded**2).sum(axis=1))
        self.error = np.sqrt(((vectors - coded) ** 2).sum(axis=1))


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products of two int8 matrices' rows, exact."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_WIDTH):
        part = slice(at, at + EXACT_WIDTH)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added in component order: the same for the same vectors."""
    total = np.zeros(len(q))
    for j in range(q.shape[1]):
        total += q[:, j] * c[:, j]
    return total


def search_tile(query_ids, q, ids, c, k):
    queries, candidates = Codes(q), Codes(c)
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(len(q))]
    for at in range(0, len(q), QUERY_CHUNK):
        rows = slice(at, min(at + QUERY_CHUNK, len(q)))
        for begin in range(0, len(c), CANDIDATE_CHUNK):
            cols = slice(begin, min(begin + CANDIDATE_CHUNK, len(c)))
            near = integer_products(queries.codes[rows], candidates.codes[cols])
            near *= queries.scale[rows, None] * candidates.scale[None, cols]
            off = (
                queries.norm[rows, None] * candidates.error[None, cols]
                + queries.error[rows, None] * candidates.coded_norm[None, cols]
            )
            # Rounding of these bounds themselves is far below a billionth of the norms.
            off += 1e-9 * queries.norm[rows, None] * (1 + candidates.norm[None, cols])
            own = query_ids[rows, None] == ids[None, cols]
            low = np.where(own, -np.inf, near - off)
            floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[rows]])
            if low.shape[1] >= k:
                floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
            qi, ci = np.nonzero((near + off >= floor[:, None]) & ~own)
            qi += at
            ci += begin
            scores = exact_products(q[qi], c[ci])
            for row, col, score in zip(qi.tolist(), ci.tolist(), scores.tolist()):
                item = (score, -int(ids[col]), col)
                if len(heaps[row]) < k:
                    heapq.heappush(heaps[row], item)
                elif item > heaps[row][0]:
                    heapq.heapreplace(heaps[row], item)
    found = [(row, col, score) for row, h in enumerate(heaps) for score, _, col in h]
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    row, col, score = zip(*found)
    return np.array(row), np.array(col), np.array(score)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, **blocks) -> DataFrame:
    """Each query's ``k`` largest inner products in double precision: query_id, rank, vec_id, score.

    Vectors that are null or zero, or hold null or non-finite components, take no part; repeated
    ids are settled by ``finite_vectors``. Vectors of unequal length are compared on the
    components that both have. No usable vector, or none but the query's own: no rows.
    """
    usable = finite_vectors(rows).where(F.exists("vec", lambda x: x != 0))
    return tiled_search(usable, is_query, k, search_tile, "double", **blocks)
