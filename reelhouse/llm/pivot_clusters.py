"""Centroid clustering over a LAESA pivot table.

A few vectors are pivots for the whole run. Every vector's distances to them are worked out once and
stored with it. Each round only the centroids are measured against the pivots: by the triangle
inequality the largest difference of the two pivot distances bounds a vector's distance to a
centroid from below. Centroids are tried in the order of their bounds, and only those whose bound
does not exceed the best exact distance so far get their own exact distance, in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.session import ensure_checkpoint_dir

PIVOTS = 12
#: The first vectors by hash, among which the pivots are chosen.
PIVOT_CANDIDATES = 256
BATCH_ROWS = 4_096
#: Components at or beyond it are no longs, and such vectors are left out.
WIDEST = float(1 << 62)
#: Share of the two distances by which a bound is lowered, for the rounding of square roots.
SLACK = 1e-14
RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def whole_vectors(rows: DataFrame, components: int, scale: int) -> DataFrame:
    """(vec_id, vec array<long>) of rows with ``components`` finite components, as floor(scale * x)."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    usable = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(WIDEST)),
    )
    kept = rows.where((F.size("embedding") == components) & usable)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("vec"))


def exact_type(*sides: np.ndarray) -> type:
    """int64 where squared distances fit in it, else Python's own whole numbers."""
    largest = max(abs(int(f(s))) for s in sides if s.size for f in (np.max, np.min))
    return np.int64 if sides[0].shape[-1] * (2 * largest) ** 2 < 1 << 63 else object


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows; both sides are of the type that ``exact_type`` gave."""
    return ((a - b) ** 2).sum(axis=-1)


def roots(squares: np.ndarray) -> np.ndarray:
    """Distances as doubles."""
    if squares.dtype == object:
        return np.array([math.sqrt(s) for s in squares], float)
    return np.sqrt(squares.astype(float))


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One column for each pivot."""
    kind = exact_type(vectors, pivots)
    vectors, pivots = vectors.astype(kind), pivots.astype(kind)
    return np.stack([roots(squared(vectors, p[None])) for p in pivots], axis=1)


def choose_pivots(candidates: np.ndarray, pivots: int) -> np.ndarray:
    """Candidates far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    least = pivot_distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < min(pivots, len(candidates)):
        chosen.append(int(least.argmax()))
        least = np.minimum(least, pivot_distances(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


def nearest(
    vectors: np.ndarray, stored: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and how many distances that took.

    ``stored`` holds the vectors' pivot distances. Of equally near centroids the first counts.
    """
    kind = exact_type(vectors, centroids)
    own, to = vectors.astype(kind), centroids.astype(kind)
    theirs = pivot_distances(centroids, pivots)
    bound = np.zeros((len(vectors), len(centroids)))
    for p in range(len(pivots)):
        mine, other = stored[:, p, None], theirs[None, :, p]
        np.maximum(bound, np.abs(mine - other) - SLACK * (mine + other), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    rows, taken = np.arange(len(vectors)), 0
    cluster = np.full(len(vectors), len(centroids))
    # Above any distance: the first centroid of each vector always counts.
    best = np.full(len(vectors), (1 << 63) - 1 if kind is np.int64 else 1 << 200, kind)
    upper = np.full(len(vectors), np.inf)
    for step in range(len(centroids)):
        number = order[:, step]
        left = np.flatnonzero(bound[rows, number] <= upper)
        if not len(left):
            break
        taken += len(left)
        number = number[left]
        exact = squared(own[left], to[number])
        better = (exact < best[left]) | (exact == best[left]) & (number < cluster[left])
        better = better.astype(bool)
        won = left[better]
        best[won], cluster[won] = exact[better], number[better]
        upper[won] = roots(exact[better]) * (1 + SLACK)
    return cluster, best, taken


def _vectors(batch: pa.RecordBatch, components: int) -> np.ndarray:
    return batch.column("vec").flatten().to_numpy().reshape(-1, components)


def _distances(batch: pa.RecordBatch, pivots: int) -> np.ndarray:
    return batch.column("pivots").flatten().to_numpy().reshape(-1, pivots)


def _parts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _with_pivots(pivots: np.ndarray) -> Callable:
    kinds = [("vec_id", pa.int64()), ("vec", pa.list_(pa.int64())), ("pivots", pa.list_(pa.float64()))]
    out = pa.schema(kinds)

    def run(batches):
        for part in _parts(batches):
            made = pivot_distances(_vectors(part, pivots.shape[1]), pivots)
            yield pa.record_batch([*part.columns, pa.array(list(made), out[2].type)], schema=out)

    return run


def _sums(centroids: np.ndarray, pivots: np.ndarray) -> Callable:
    """Each task's vectors added up by centroid: cluster, place, n, total."""
    components = centroids.shape[1]
    kinds = [("cluster", pa.int32()), ("place", pa.int32()), ("n", pa.int64())]
    out = pa.schema([*kinds, ("total", pa.decimal128(38, 0))])

    def run(batches):
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, object)
        for part in _parts(batches):
            vectors = _vectors(part, components)
            cluster = nearest(vectors, _distances(part, len(pivots)), centroids, pivots)[0]
            # A batch's sums of smaller components fit in 64 bits.
            kind = np.int64 if np.abs(vectors).max(initial=0) < 1 << 48 else object
            for c in np.unique(cluster):
                own = vectors[cluster == c]
                n[c] += len(own)
                total[c] += own.astype(kind).sum(axis=0).astype(object)
        used = np.flatnonzero(n)
        if len(used):
            columns = [
                pa.array(np.repeat(used, components).astype(np.int32)),
                pa.array(np.tile(np.arange(components, dtype=np.int32), len(used))),
                pa.array(np.repeat(n[used], components)),
                pa.array([Decimal(int(x)) for x in total[used].ravel()], out[3].type),
            ]
            yield pa.record_batch(columns, schema=out)

    return run


def _assigned(centroids: np.ndarray, pivots: np.ndarray) -> Callable:
    out = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches):
        for part in _parts(batches):
            vectors, stored = _vectors(part, centroids.shape[1]), _distances(part, len(pivots))
            cluster, best, _ = nearest(vectors, stored, centroids, pivots)
            fits = [int(d) if d < 1 << 63 else None for d in best.tolist()]
            columns = [part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(fits, out[2].type)]
            yield pa.record_batch(columns, schema=out)

    return run


def cluster_vectors(
    rows: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    components: int = 64,
    scale: int = 1024,
    seed: str = "3:",
    pivots: int = PIVOTS,
) -> DataFrame:
    """Each kept vector's cluster: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``rows`` has vec_id and embedding. Vectors of exactly ``components`` components, none of them null
    or non-finite, are kept; a component x counts as floor(``scale`` * x). The centroids start as the
    vectors whose id has the least SHA-256 after ``seed``; ids that are null come last, equal ones in
    the order of their vectors. Each round assigns all vectors and moves every centroid that has any
    to the floor of their mean. Ties go to the smaller number. With fewer vectors than ``clusters`` all
    are centroids; without any there are no rows. Repeated rows and null ids count as vectors of their
    own. Vectors with a component that is no long (beyond 2**62) are left out, squared distances and
    sums that are no longs are null. Other columns are not read.

    The driver gets the PIVOT_CANDIDATES first vectors by hash and, each round, one sum for each
    component of each centroid.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    kept = whole_vectors(rows, components, scale)
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    order = [digest.asc_nulls_last(), F.col("vec")]
    first = kept.orderBy(*order).limit(max(clusters, PIVOT_CANDIDATES)).select("vec").collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    first = np.array([r.vec for r in first], np.int64)
    centroids, fixed = first[:clusters].copy(), choose_pivots(first, pivots)
    kinds = "vec_id long, vec array<long>, pivots array<double>"
    table = kept.mapInArrow(_with_pivots(fixed), kinds).checkpoint()
    for _ in range(rounds):
        parts = table.mapInArrow(
            _sums(centroids, fixed), "cluster int, place int, n long, total decimal(38,0)"
        )
        added = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for r in added.collect():
            centroids[r.cluster, r.place] = int(r.total) // r.n
    placed = table.mapInArrow(_assigned(centroids, fixed), "vec_id long, cluster int, distance long")
    placed = placed.checkpoint()
    wide = F.col("distance").cast("decimal(38,0)")
    sums = placed.groupBy("cluster").agg(F.sum(wide).alias("d"), F.max(F.isnull("distance")).alias("out"))
    spread = {r.cluster: None if r.out else int(r.d) for r in sums.collect()}
    every = None if None in spread.values() else sum(spread.values())
    long = lambda x: F.lit(x if x is not None and x < 1 << 63 else None).cast("long")
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    at = F.col("cluster") + 1
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(F.array(*[long(spread.get(c)) for c in range(len(centroids))]), at).alias("cluster_inertia"),
        long(every).alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), at).alias("centroid_sha256"),
    )
