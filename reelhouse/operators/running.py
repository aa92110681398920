"""Running aggregates over a whole table or a large key without a window over all its rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.session import ensure_checkpoint_dir

ROWS_PER_PART = 1_000_000
#: Parts whose maxima are run through together.
FAN = 1_024


def _before(maxima: DataFrame, parts: int) -> DataFrame:
    """(part, before) with the largest ``m`` of all smaller parts, for parts 0 to ``parts`` - 1.

    Parts are run through in groups of FAN; the groups' own maxima are dealt with the same way, so no
    window ever holds more than FAN rows.
    """
    grouped = maxima.withColumn("group", F.floor(F.col("part") / FAN))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.withColumn("before", F.max("m").over(earlier))
    if parts <= FAN:
        return inside.select("part", "before")
    groups = grouped.groupBy(F.col("group").alias("part")).agg(F.max("m").alias("m"))
    outer = _before(groups, math.ceil(parts / FAN)).select(
        F.col("part").alias("group"), F.col("before").alias("outer")
    )
    # greatest() passes over nulls.
    joined = inside.join(outer, "group", "left")
    return joined.select("part", F.greatest("before", "outer").alias("before"))


def running_max(
    rows: DataFrame, order: list[str], value: str, name: str, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Add ``name``: the largest ``value`` of all rows before this one in ``order``; null of none.

    Rows are cut by ``order`` into ranges of about ``rows_per_part`` and stored, each with the number of
    its range. The maximum runs within each range; that of the ranges before comes from their maxima,
    and the larger of the two counts. ``order`` should tell all rows apart: equal ones come as they do,
    and many equal rows make one range. Rows without a value are passed over. Null orders come first.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    parts = max(1, math.ceil(rows.count() / rows_per_part))
    ranged = rows.repartitionByRange(parts, *order)
    # Stored, so that a lost task can't cut the ranges anew.
    stored = ranged.withColumn("running part", F.spark_partition_id()).checkpoint()
    part = F.col("`running part`")
    maxima = stored.groupBy(part.alias("part")).agg(F.max(value).alias("m"))
    names = {"part": "running part", "before": "running outside"}
    before = _before(maxima, parts).withColumnsRenamed(names)
    earlier = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = stored.withColumn("running inside", F.max(value).over(earlier))
    largest = F.greatest("running inside", "running outside").alias(name)
    kept = [F.col(f"`{c}`") for c in rows.columns if c != name]
    return inside.join(before, "running part").select(*kept, largest)


def place_in_key(
    rows: DataFrame, key: str, order: list[Column], name: str, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Add ``name``: the place, from 0, of each row among those of its ``key`` in ``order``.

    Rows are cut by key and order into ranges of about ``rows_per_part`` and stored. They are numbered
    within their range, and start from the number of the key's rows in the ranges before, so a key of any
    size is spread over tasks. Rows that ``order`` can't tell apart get their places as they come.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    parts = max(1, math.ceil(rows.count() / rows_per_part))
    ranged = rows.repartitionByRange(parts, F.col(key), *order)
    stored = ranged.withColumn("running part", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("running part", key).orderBy(*order)
    numbered = stored.withColumn("running place", F.row_number().over(inside) - 1)
    earlier = Window.partitionBy(key).orderBy("running part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy(key, "running part").agg(F.count("*").alias("n"))
    starts = sizes.select(
        F.col(key).alias("running key"),
        F.col("running part").alias("running range"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("running start"),
    )
    same = numbered[key].eqNullSafe(starts["running key"]) & (numbered["running part"] == starts["running range"])
    kept = [numbered[f"`{c}`"] for c in rows.columns if c != name]
    return numbered.join(starts, same).select(*kept, (F.col("running start") + F.col("running place")).alias(name))
