"""The shared folder of the checks' own sessions."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from reelhouse.session import remove_path


def name_work_folder(spark: SparkSession) -> None:
    """Name a folder for a local session that has none; a cluster names its own."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    if spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checks-"))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application for one query's files; what an earlier call left goes."""
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    folder = f"{root}/checks-{spark.sparkContext.applicationId}/{name}"
    remove_path(spark, folder)
    return folder
