"""Joins against a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64
# Keys of a report's rows, or window ends: a few bytes each.
BROADCAST_KEYS = 100_000
# Dimension rows with their texts.
BROADCAST_LOOKUPS = 10_000


def fits_broadcast(dimension: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored dimension, measured by its rows and text, is small enough."""
    texts = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        for f in dimension.schema.fields
        if isinstance(f.dataType, T.StringType)
    ]
    lists = [
        F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
        for f in dimension.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    ]
    row_bytes = sum([*texts, *lists], F.lit(ROW_OVERHEAD_BYTES))
    size = dimension.agg(F.sum(row_bytes.cast("bigint"))).first()[0]
    return (size or 0) <= limit


def left_lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keep every fact and add the dimension's columns.

    No broadcast is forced: Spark broadcasts the dimension only when its known
    size is below ``spark.sql.autoBroadcastJoinThreshold``. Beyond that the join
    is shuffled and adaptive execution splits a hot key's facts over many tasks.
    """
    return facts.join(dimension, key, "left")


def left_lookup_few(
    few: DataFrame, dimension: DataFrame, key: str, limit: int
) -> DataFrame:
    """``left_lookup`` for at most ``limit`` rows against a dimension with unique keys.

    The dimension is first cut to the few keys asked for, so neither a shuffle
    nor a broadcast of the whole dimension is needed. A limit too large for that
    takes the general way.
    """
    if limit > BROADCAST_LOOKUPS:
        return left_lookup(few, dimension, key)
    wanted = F.broadcast(few.select(key).distinct())
    matches = dimension.join(wanted, key, "left_semi")
    return few.join(F.broadcast(matches), key, "left")


def rows_with_few_keys(
    rows: DataFrame, keys: DataFrame, key: str, limit: int
) -> DataFrame:
    """Rows whose key is one of at most ``limit`` distinct keys."""
    few = F.broadcast(keys) if limit <= BROADCAST_KEYS else keys
    return rows.join(few, key, "left_semi")


def rows_with_key_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; the keys are made distinct first."""
    return rows.join(keys.select(key).distinct(), key, "left_semi")
