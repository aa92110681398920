"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Blocks number map tasks times reduce tasks: about 1 GB each keeps that product, and the
# driver's table of it, near 1e10 at 100 TB. Adaptive execution splits and merges from there.
BYTES_PER_SHUFFLE_PARTITION = 1024**3
# Files a task of a stored table keeps open: more than there are years of ratings.
OPEN_FILES = 64
# A task that folds or sorts keys that hardly repeat holds about 110 bytes a row: with these sizes
# some 55 MB. Beyond 10 billion rows tasks grow with the rows, or the driver would list too many.
ROWS_PER_SMALL_TASK = 500_000
MOST_SMALL_TASKS = 20_000
SMALL_SPLIT_BYTES = 2 * 1024**2
SMALL_PARTITION_BYTES = 8 * 1024**2
# Scans split files between row groups only; counted before compression.
ROW_GROUP_BYTES = 4 * 1024**2

ENGINE_SETTINGS = {
    # Results never depend on the host's zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: partition sizing, skew splitting, and turning a
    # shuffled join into a broadcast one once the real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Fewer map tasks; files of less than this are read together.
    "spark.sql.files.maxPartitionBytes": "512m",
    # A side is broadcast only when its size is known to be below this.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Checkpoint files go once nothing refers to their rows any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Reports with a huge limit sort in parallel instead of filling a heap in memory.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # Write a few partitions side by side instead of sorting rows by partition.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Window state beyond the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Collapse a hot user's session rows inside each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle partitions such that each holds about 1 GB, and no core idles."""
    return max(cores, math.ceil(input_bytes / BYTES_PER_SHUFFLE_PARTITION))


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    for key, value in ENGINE_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    """Hold session settings at other values for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def open_side_by_side(spark: SparkSession, files: int = OPEN_FILES):
    """Let tasks write up to ``files`` partition values at once, whatever the session says.

    A task with more of them sorts the rest of its rows.
    """
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": files})


def small_tasks(spark: SparkSession, rows: int):
    """Read and shuffle ``rows`` rows in tasks that fold or sort their share in memory.

    Adaptive execution goes by compressed bytes, of which a row has few, and gives a task so
    many rows that it spills.
    """
    tasks = math.ceil(rows / ROWS_PER_SMALL_TASK)
    larger = max(1, math.ceil(tasks / MOST_SMALL_TASKS))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _settings(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": SMALL_SPLIT_BYTES * larger,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": SMALL_PARTITION_BYTES * larger,
            "spark.sql.shuffle.partitions": max(partitions, min(tasks, MOST_SMALL_TASKS)),
        },
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def new_work_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder wherever Spark can read it; nothing happens if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative MLlib jobs cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
