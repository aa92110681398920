"""A stated set of query vectors against all vectors, in tiles of bounded size.

Vectors are dealt by hash of their id to candidate blocks, queries to query blocks, and each
pair of blocks is one tile. A kernel finds the best pairs of a tile exactly; Spark merges the
tiles' short lists per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (query ids, query matrix, candidate ids, candidate matrix, k) -> (query row, candidate row, score)
Kernel = Callable[
    [np.ndarray, np.ndarray, np.ndarray, np.ndarray, int],
    tuple[np.ndarray, np.ndarray, np.ndarray],
]


def finite_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vec) of usable rows, one for each id.

    Rows without id, and vectors that are null, or hold a null or non-finite component, take no
    part. Of rows that repeat an id, the least vector counts.
    """
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return (
        rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)
        .groupBy("vec_id")
        .agg(F.min(vector).alias("vec"))
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows as doubles; shorter vectors are filled up with zeros, which add nothing."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def tiled_search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    kernel: Kernel,
    score_type: str,
    block_rows: int = 8_192,
    block_queries: int = 2_048,
) -> DataFrame:
    """The ``k`` best candidates of each query: query_id, rank, vec_id, score.

    ``vectors`` has one row for each vec_id. A query is no candidate of its own. Higher scores
    come first, then smaller ids; with fewer candidates than ``k`` all are returned.
    """
    sizes = vectors.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries")).first()
    blocks = max(1, -(-sizes.rows // block_rows))
    query_blocks = max(1, -(-sizes.queries // block_queries))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    candidates = vectors.select(
        "vec_id", "vec", dealt(0, blocks).alias("block"), all_of(query_blocks).alias("query_block")
    )
    queries = vectors.where(is_query).select(
        "vec_id", "vec", all_of(blocks).alias("block"), dealt(1, query_blocks).alias("query_block")
    )
    kind = {"long": (pa.int64(), np.int64), "double": (pa.float64(), np.float64)}[score_type]
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", kind[0])])

    def best_of_tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        width = 1
        for side in (left, right):
            for chunk in side["vec"].chunks:
                width = max(width, int(chunk.value_lengths().to_numpy(zero_copy_only=False).max(initial=0)))
        query_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        q, c, score = kernel(
            query_ids, _matrix(left["vec"], width), ids, _matrix(right["vec"], width), k
        )
        return pa.table(
            [pa.array(query_ids[q]), pa.array(ids[c]), pa.array(score.astype(kind[1]))], schema=out
        )

    found = (
        queries.groupBy("block", "query_block")
        .cogroup(candidates.groupBy("block", "query_block"))
        .applyInArrow(best_of_tile, f"query_id long, vec_id long, score {score_type}")
    )
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def best_per_query(
    query: np.ndarray, candidate: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int
) -> np.ndarray:
    """Positions of each query's ``k`` best pairs, higher scores and then smaller ids first."""
    order = np.lexsort((ids[candidate], -score, query))
    ordered = query[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]
