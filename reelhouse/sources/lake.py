"""Versioned tables: Parquet files plus a small commit log.

Each commit writes its rows below a folder of its own and then logs one entry.
Rows become visible with the entry, so a job that dies halfway leaves nothing
behind that a reader could see, and can simply be run again. Deleting writes
only a log entry, which keeps earlier versions readable.

One writer per table at a time; readers are free. Where a table-format catalog
is installed, ``spark.table`` with its own time travel does the same job.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.schemas import COMMIT_LOG, conform
from reelhouse.session import ROW_GROUP_BYTES, open_side_by_side

APPEND, DELETE, OVERWRITE = "append", "delete", "overwrite"


def _deletion() -> tuple[str, str, str, int]:
    return uuid.uuid4().hex, "", DELETE, 0


class LakeTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = list(partition_by)

    # -- writing ---------------------------------------------------------

    def append(
        self, df: DataFrame, batch_id: str = "", clear: bool = False, spread: bool = True
    ) -> None:
        """Add rows; ``clear`` deletes the earlier ones in a commit just before.

        With ``spread``, rows are shuffled into well-sized files per partition
        value; adaptive execution splits a value that holds most of the rows.
        """
        self._commit(df, batch_id, APPEND, spread, clear)

    def overwrite(self, df: DataFrame, batch_id: str = "", spread: bool = True) -> None:
        """Replace the visible rows in one step."""
        self._commit(df, batch_id, OVERWRITE, spread)

    def delete_all(self) -> None:
        self._log([_deletion()])

    def append_batches(
        self,
        df: DataFrame,
        batch_ids: Sequence[str],
        overflow: str,
        clear: bool = False,
    ) -> None:
        """Append rows that carry ``batch_id`` as one commit per batch, in one pass.

        ``clear`` deletes the earlier rows in a commit just before. ``overflow``
        names one more batch, committed only when it has rows. A row of any other
        batch fails the job instead of getting lost.
        """
        commits = {batch: uuid.uuid4().hex for batch in (*batch_ids, overflow)}
        commit_of = F.create_map(*[F.lit(x) for pair in commits.items() for x in pair])
        commit_id = F.coalesce(
            F.try_element_at(commit_of, F.col("batch_id")),
            F.raise_error(F.concat(F.lit("unlisted batch: "), F.col("batch_id"))),
        )
        rows = conform(df, self.schema).withColumn("commit_id", commit_id)
        # Few batches, so few files per task: no shuffle is worth its cost here.
        counts = [
            F.count_if(F.col("commit_id") == commit).alias(f"n{i}")
            for i, commit in enumerate(commits.values())
        ]
        added = self._write(rows, counts, "data", ["commit_id", *self.partition_by])
        appends = [
            (commit, batch, APPEND, added[f"n{i}"])
            for i, (batch, commit) in enumerate(commits.items())
            if batch != overflow or added[f"n{i}"]
        ]
        self._log([_deletion(), *appends] if clear else appends)

    def _commit(
        self,
        df: DataFrame,
        batch_id: str,
        operation: str,
        spread: bool,
        clear: bool = False,
    ) -> None:
        commit = uuid.uuid4().hex
        rows = conform(df, self.schema)
        if spread and self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        counts = [F.count("*").alias("n")]
        added = self._write(rows, counts, f"data/commit_id={commit}", self.partition_by)
        entry = (commit, batch_id, operation, added["n"])
        self._log([_deletion(), entry] if clear else [entry])

    def _write(
        self, rows: DataFrame, counts: list[Column], folder: str, partition_by: list[str]
    ) -> dict[str, int]:
        """Write once; the counts come from the same pass.

        They are taken in the writing stage itself, so a task that runs again
        after a lost executor is not counted twice. A task keeps the files of its
        partition values open side by side: no task sorts its rows by them. Row groups
        are small, so that a scan can be split.
        """
        seen = Observation()
        writer = rows.observe(seen, *counts).write.mode("append").option("compression", "zstd")
        writer.option("parquet.block.size", ROW_GROUP_BYTES)
        with open_side_by_side(self.spark):
            writer.partitionBy(*partition_by).parquet(f"{self.path}/{folder}")
        return seen.get

    def _log(self, entries: list[tuple[str, str, str, int]]) -> None:
        """Log entries in order; they become visible together, in one file."""
        self._create_log()
        last = max((row.seq for row in self.log().select("seq").collect()), default=0)
        columns = ("commit_id", "batch_id", "operation", "added_rows")
        numbered = [
            F.struct(
                F.lit(seq).alias("seq"),
                *[
                    F.lit(value).cast(COMMIT_LOG[name].dataType).alias(name)
                    for name, value in zip(columns, entry)
                ],
            )
            for seq, entry in enumerate(entries, start=last + 1)
        ]
        rows = (
            self.spark.range(0, 1, 1, 1)
            .select(F.inline(F.array(*numbered)))
            .withColumn("committed_at", F.current_timestamp())
        )
        conform(rows, COMMIT_LOG).write.mode("append").parquet(f"{self.path}/log")

    def _create_log(self) -> None:
        """An empty log, unless there is one."""
        empty = self.spark.createDataFrame([], COMMIT_LOG)
        empty.coalesce(1).write.mode("ignore").parquet(f"{self.path}/log")

    # -- reading ---------------------------------------------------------

    def log(self) -> DataFrame:
        """The commits so far; fails when the table was never written."""
        return self.spark.read.schema(COMMIT_LOG).parquet(f"{self.path}/log")

    def exists(self) -> bool:
        """Whether anything was ever committed."""
        try:
            return not self.log().isEmpty()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def snapshots(self) -> DataFrame:
        """Every version with the rows visible in it. The log is small by nature."""
        by_seq = Window.orderBy("seq")
        resets = F.col("operation").isin(DELETE, OVERWRITE)
        epoch = F.sum(resets.cast("int")).over(by_seq)
        running = Window.partitionBy("epoch").orderBy("seq")
        return (
            self.log()
            .withColumn("epoch", epoch)
            .withColumn("total_rows", F.sum("added_rows").over(running))
            .select(
                "seq", "committed_at", "operation", "batch_id", "added_rows", "total_rows"
            )
        )

    def read(self) -> DataFrame:
        return self._read(self.log())

    def as_of(self, seq: int) -> DataFrame:
        """The rows visible right after commit ``seq``."""
        known = self.log().filter(F.col("seq") <= seq)
        if known.agg(F.max("seq")).first()[0] != seq:
            raise ValueError(f"{self.path} has no version {seq}")
        return self._read(known)

    def then_and_now(self, seq: int) -> DataFrame:
        """Rows right after commit ``seq``, rows now, and the difference."""
        rows_then = self.as_of(seq).agg(F.count("*").alias("n")).scalar()
        rows_now = self.read().agg(F.count("*").alias("rows_now"))
        return rows_now.select(
            rows_then.alias("rows_then"), "rows_now", (F.col("rows_now") - rows_then).alias("added")
        )

    def row_count(self) -> int:
        """Number of visible rows, from the log alone."""
        return sum(entry.added_rows for entry in self._visible(self.log()))

    def _visible(self, log: DataFrame) -> list[Row]:
        """Commits since the last reset that left rows.

        Only log entries, one per commit, come to the driver.
        """
        entries = log.select("seq", "commit_id", "operation", "added_rows").collect()
        last_reset = max((e.seq for e in entries if e.operation != APPEND), default=0)
        return [
            e for e in entries if e.seq >= last_reset and e.operation != DELETE and e.added_rows
        ]

    def _read(self, log: DataFrame) -> DataFrame:
        """Rows of the commits since the last reset, by folder: no other is listed."""
        folders = [f"{self.path}/data/commit_id={e.commit_id}" for e in self._visible(log)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return conform(
            self.spark.read.schema(self.schema)
            .option("basePath", f"{self.path}/data")
            .parquet(*folders),
            self.schema,
        )
