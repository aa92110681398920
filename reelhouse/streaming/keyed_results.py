"""Window results kept by key: a window that is given again replaces the stored one.

Results lie in Parquet folders by date. A batch touches the dates of its windows only: their stored
rows that the batch does not name stay, and those folders are written anew by Spark's dynamic
partition overwrite. A batch that is loaded again after a failure, or a window that late events
changed, therefore counts once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from reelhouse.operators import event_windows
from reelhouse.session import ensure_checkpoint_dir, remove_path
from reelhouse.sources.batch_table import stored_or_empty

DATE = "window_date"
FILE_BYTES = 128 * 1024**2


def dates_of(rows: DataFrame) -> list[date]:
    """The different dates of ``rows``: a list of days, short however many rows there are."""
    return [r[0] for r in rows.select(DATE).distinct().orderBy(DATE).collect()]


def _overwrite_dates(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)


def replace_keys(rows: DataFrame, path: str, keys: Sequence[str]) -> list[date]:
    """Put ``rows``, each key once, in the place of stored rows with the same keys.

    The rows' date must follow from their keys. Returns the dates that were written.
    """
    spark = rows.sparkSession
    dates = dates_of(rows)
    if dates:
        before = stored_or_empty(spark, path, rows.schema).filter(F.col(DATE).isin(dates))
        kept = before.join(rows.select(*keys), list(keys), "left_anti").select(*rows.columns)
        _overwrite_dates(rows.unionByName(kept).hint("rebalance", DATE), path)
    return dates


def compact(spark: SparkSession, path: str, dates: Sequence[date], file_bytes: int = FILE_BYTES) -> None:
    """Merge the files of each of ``dates`` into as few as ``file_bytes`` asks for.

    A date's number of files comes from the bytes it takes now; rows are dealt by hash inside it.
    """
    if not dates:
        return
    rows = spark.read.parquet(path).filter(F.col(DATE).isin(list(dates)))
    sizes = {
        r[DATE]: r["bytes"]
        for r in rows.select(DATE, "_metadata.file_path", "_metadata.file_size")
        .distinct()
        .groupBy(DATE)
        .agg(F.sum("file_size").alias("bytes"))
        .collect()
    }
    files = {d: max(1, math.ceil(n / file_bytes)) for d, n in sizes.items()}
    per_date = F.element_at(F.create_map(*[F.lit(x) for d, n in files.items() for x in (d, n)]), F.col(DATE))
    slot = F.pmod(F.xxhash64(*[c for c in rows.columns if c != DATE]), per_date)
    dealt = rows.repartition(sum(files.values()), DATE, slot)
    _overwrite_dates(dealt, path)


def start_keyed(
    results: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    until_caught_up: bool = False,
    seconds: int = 30,
) -> StreamingQuery:
    """Keep a stream's windows by key; open windows may be given again and again (update mode)."""

    def put(rows: DataFrame, number: int) -> None:
        rows = rows.withColumn(DATE, F.to_date("window_end")).persist()
        replace_keys(rows, path, keys)
        rows.unpersist()

    writer = results.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    trigger = {"availableNow": True} if until_caught_up else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


# -- backfill ------------------------------------------------------------


def touched_windows(changed: DataFrame, window_seconds: int, slide_seconds: int | None = None) -> DataFrame:
    """window_start and window_end of every window that an event of ``changed`` falls into."""
    size, slide = f"{window_seconds} seconds", f"{slide_seconds or window_seconds} seconds"
    placed = changed.filter("event_ts is not null").select(F.window("event_ts", size, slide).alias("w")).distinct()
    return placed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def backfill(
    spark: SparkSession,
    read_events: Callable[[list[date]], DataFrame],
    changed: DataFrame,
    path: str,
    window_seconds: int,
    slide_seconds: int | None = None,
    compute: Callable[..., DataFrame] = event_windows.trending,
) -> list[date]:
    """Compute the windows that ``changed`` events fall into again, and put them in place.

    ``read_events(dates)`` gives all events of those dates, changed ones included; no other is read.
    Stored windows of the touched ones are replaced as a whole, so that a key no event speaks for any
    more goes as well. Returns the dates of the touched windows.
    """
    ensure_checkpoint_dir(spark)
    touched = touched_windows(changed, window_seconds, slide_seconds).checkpoint()
    marked = touched.withColumn(DATE, F.to_date("window_end"))
    dates = dates_of(marked)
    if not dates:
        return []
    days = F.explode(F.sequence(F.to_date("window_start"), F.to_date("window_end")))
    events_of = [r[0] for r in touched.select(days.alias("day")).distinct().orderBy("day").collect()]
    windows = compute(read_events(events_of), window_seconds, slide_seconds)
    fresh = windows.join(touched, ["window_start", "window_end"], "left_semi").withColumn(DATE, F.to_date("window_end"))
    before = stored_or_empty(spark, path, fresh.schema).filter(F.col(DATE).isin(dates))
    kept = before.join(touched, ["window_start", "window_end"], "left_anti").select(*fresh.columns)
    rows = fresh.unionByName(kept).hint("rebalance", DATE).checkpoint()
    _overwrite_dates(rows, path)
    # The overwrite leaves dates alone that have no rows any more.
    for gone in set(dates) - set(dates_of(rows)):
        remove_path(spark, f"{path}/{DATE}={gone}")
    return dates
