"""Shards by a tree of weighted hash draws: region, then rack, then shard.

A row first draws among the regions: each region's arrival time is exponential with the weight below it
as rate, hashed from the row's key and the region. Then the racks of that region draw, and the shards of
that rack; no other node is looked at. A node's draw depends on the node and the weight below it alone, so
a changed weight leaves all rows inside other subtrees where they are: rows move only into or out of the
nodes on the path to it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.session import ensure_checkpoint_dir

#: (region, rack, shard) -> weight
Tree = Mapping[tuple[int, int, int], float]
LEVELS = ("region", "rack", "shard")


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> Tree:
    """Shards 0 to ``shards`` - 1 with equal weights; a further shard changes no earlier place."""
    return {
        (s // (racks_per_region * shards_per_rack), s // shards_per_rack, s): 1.0
        for s in range(shards)
    }


def _arrival(key: Column, level: int, node: int, weight: float) -> Column:
    """Exponential with rate ``weight``, the same for the same key and node anywhere."""
    drawn = F.xxhash64(key, F.lit(level).cast("long"), F.lit(node).cast("long"))
    uniform = (F.shiftrightunsigned(drawn, 11).cast("double") + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(uniform) / F.lit(float(weight))


def _draw(key: Column, level: int, weights: Mapping[int, float]) -> Column:
    """The node that arrives first."""
    draws = [
        F.struct(_arrival(key, level, node, weight).alias("arrival"), F.lit(node).alias("node"))
        for node, weight in sorted(weights.items())
    ]
    # Structs compare by arrival first.
    return F.array_min(F.array(*draws))["node"] if len(draws) > 1 else F.lit(next(iter(weights)))


def _below(tree: Tree) -> dict[int, dict[int, dict[int, float]]]:
    """region -> rack -> shard -> weight, without nodes that have no weight."""
    nested: dict[int, dict[int, dict[int, float]]] = {}
    for (region, rack, shard), weight in sorted(tree.items()):
        if weight > 0:
            nested.setdefault(region, {}).setdefault(rack, {})[shard] = weight
    return nested


def _of(node: Column, branches: Mapping[int, Column]) -> Column:
    """The branch of ``node``; Spark evaluates no other."""
    (first, value), *others = branches.items()
    chosen = F.when(node == first, value)
    for other, value in others:
        chosen = chosen.when(node == other, value)
    return chosen


def descend(rows: DataFrame, key: str, tree: Tree, names: tuple[str, str, str] = LEVELS) -> DataFrame:
    """Add the region, rack and shard that a long key is drawn to. A null key is one key.

    One column is drawn after the other, each among the children of the one before.
    """
    nested = _below(tree)
    if not nested:
        raise ValueError("a tree needs a shard with a weight above zero")
    total = lambda shards: sum(shards.values())
    region, rack, shard = names
    drawn = F.col(key)
    by_region = {g: sum(map(total, racks.values())) for g, racks in nested.items()}
    rows = rows.withColumn(region, _draw(drawn, 0, by_region))
    racks = {g: _draw(drawn, 1, {r: total(s) for r, s in inside.items()}) for g, inside in nested.items()}
    rows = rows.withColumn(rack, _of(F.col(region), racks))
    leaves = {
        g: _of(F.col(rack), {r: _draw(drawn, 2, shards) for r, shards in inside.items()})
        for g, inside in nested.items()
    }
    return rows.withColumn(shard, _of(F.col(region), leaves))


def number_slots(
    rows: DataFrame, rows_in_table: int, shards: int, rows_per_bucket: int = 16_384
) -> DataFrame:
    """Add ``slot``: rows of each shard numbered from 0 without gaps.

    Rows are dealt to buckets by their position in the input, about ``rows_per_bucket`` of a shard to
    each if the shards are even, so no id or repeated row makes a large bucket. The dealt rows, without
    texts, are stored: sizes and numbers are of the same deal, also if a task runs again. Bucket sizes
    are summed up, and rows are numbered inside their bucket, so no task holds a shard.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    buckets = max(1, -(-rows_in_table // (shards * rows_per_bucket)))
    position = F.xxhash64(F.monotonically_increasing_id())
    dealt = rows.withColumn("bucket", F.pmod(position, F.lit(buckets)).cast("int")).checkpoint()
    before = F.expr(
        "sum(n) over (partition by shard order by bucket"
        " rows between unbounded preceding and current row) - n"
    )
    starts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "bucket", before.alias("start"))
    place = F.expr(
        "row_number() over (partition by shard, bucket order by doc_id, size, text_crc32) - 1"
    )
    return (
        dealt.withColumn("place", place)
        .join(starts, ["shard", "bucket"])
        .withColumn("slot", F.col("start") + F.col("place"))
        .drop("bucket", "place", "start")
    )


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree) -> DataFrame:
    """Every row of ``docs`` with its shard under ``tree`` and under ``grown``.

    Columns: doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law (``key``), region,
    rack, shard, slot, grown_shard. A null text has no bytes. Only doc_id decides the shard, so
    rows that repeat an id share one, and a null id is one more key. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = descend(rows, "doc_id", tree)
    other = ("grown_region", "grown_rack", "grown_shard")
    placed = descend(placed, "doc_id", grown, other).drop(*other[:2])
    return number_slots(placed, docs.count(), len(tree))
