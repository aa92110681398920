"""How often the jobs shuffle, sort, read and make their rows."""

import re

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.plans import silver
from reelhouse.plans.lakehouse import Lakehouse
from reelhouse.plans.partials import PartialTables
from reelhouse.plans.rating_batches import RatingBatches
from reelhouse.session import (
    MOST_SMALL_TASKS,
    ROWS_PER_SMALL_TASK,
    SMALL_PARTITION_BYTES,
    SMALL_SPLIT_BYTES,
    open_side_by_side,
    small_tasks,
)
from reelhouse.sources import csv_files, message_segments
from reelhouse.sources.lake import LakeTable
from tests.conftest import plan_of


def plans_of(spark, run) -> list[str]:
    """Plans of everything that ``run`` executes."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    listed = store.executionsList()
    return [listed.apply(i).physicalPlanDescription() for i in range(before, listed.size())]


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SMALL = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")


def test_stored_batches_are_not_sorted(spark, tmp_path):
    """Whatever the session says, no task sorts its rows by the partition they go to."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, 0)
    try:
        schema = schemas._struct(n=schemas.INT, batch_id=schemas.STRING)
        table = LakeTable(spark, str(tmp_path / "t"), schema, ["batch_id"])
        rows = spark.range(1_000).select(F.col("id").cast("int").alias("n"), (F.col("id") % 2).cast("string").alias("batch_id"))
        plans = plans_of(spark, lambda: table.append_batches(rows, ["0", "1"], "other"))
        assert table.read().count() == 1_000
        assert any("Execute InsertInto" in p for p in plans) and not any(re.search(r"\bSort\b", p) for p in plans)
        with open_side_by_side(spark):
            assert spark.conf.get(WRITERS) == "64"
        assert spark.conf.get(WRITERS) == "0"
    finally:
        spark.conf.set(WRITERS, before)


def test_wide_rows_are_not_dealt_by_year(spark, sample, tmp_path, monkeypatch):
    monkeypatch.setattr("reelhouse.plans.lakehouse.fits_broadcast", lambda movies: False)
    house = Lakehouse(spark, str(tmp_path / "house"))
    read = {"ratings": csv_files.read_ratings, "movies": csv_files.read_movies, "tags": csv_files.read_tags}
    for name in read:
        csv_files.write_csv(getattr(sample, f"{name}_raw")(), f"{tmp_path}/{name}")
    house.ingest(*[of(spark, f"{tmp_path}/{name}") for name, of in read.items()], 1998)
    house.movies.overwrite(sample.movies_clean())
    plans = plans_of(spark, house._store_enriched)
    assert not any("rating_year" in line for p in plans for line in p.splitlines() if "Exchange" in line or "REBALANCE" in line)
    assert house.ratings.read().count() == sample.ratings_clean().count()


def test_csv_files_are_compressed(spark, sample, tmp_path):
    csv_files.write_csv(sample.movies_raw(), str(tmp_path / "movies"))
    assert {p.suffix for p in (tmp_path / "movies").glob("part-*")} == {".gz"}
    assert csv_files.read_movies(spark, str(tmp_path / "movies")).count() == sample.movies_raw().count()


def test_a_batch_is_folded_with_the_stored_rows_in_one_shuffle(spark, tmp_path):
    batches = RatingBatches(spark, str(tmp_path / "ratings"))
    raw = lambda rating: spark.range(500).select(
        F.col("id").cast("int").alias("userId"), F.lit(1).alias("movieId"), F.lit(rating).alias("rating"), F.lit(9).cast("long").alias("timestamp")
    )
    assert batches.load(raw(3.0)) == [1970]
    plans = plans_of(spark, lambda: batches.load(raw(4.0)))
    moved = [p for p in plans if "hashpartitioning(userId" in p]
    assert len(moved) == 1 and not any("Join" in p for p in plans)
    assert batches.load(raw(3.5)) == [] and batches.load(raw(None).withColumn("rating", F.col("rating").cast("double"))) == []
    assert {r.rating for r in batches.cleaned().collect()} == {4.0}


def test_a_batch_of_partials_reads_its_ratings_once(spark, sample, tmp_path):
    path = str(tmp_path / "enriched")
    sample.ratings_enriched().write.parquet(path)
    tables = PartialTables(spark, str(tmp_path / "partials"))
    plans = plans_of(spark, lambda: tables.load(spark.read.parquet(path), "a"))
    assert sum(path in p and "Scan parquet" in p for p in plans) == 1


def test_formula_lists_deal_ratings_once(sample):
    plan = plan_of(sample.recommendation_scores())
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(userId") == 1


def test_messages_are_decoded_in_small_batches(tmp_path, monkeypatch):
    """One large row group of messages comes in pieces, and a span gives its own messages only."""
    folder = tmp_path / "segment=00000001"
    folder.mkdir()
    n = 25_000
    table = pa.table({"key": [str(i) for i in range(n)], "value": ["v" * 50] * n})
    pq.write_table(table, folder / "a.parquet", row_group_size=n)
    log = message_segments._Log({"path": str(tmp_path)})
    batches = list(log.read(message_segments.Span(str(folder / "a.parquet"), 7, 24_000)))
    assert max(b.num_rows for b in batches) <= 10_000
    assert [k for b in batches for k in b.column("key").to_pylist()] == [str(i) for i in range(7, 24_000)]


def rows_by_task(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_cleaning_folds_in_small_tasks(spark, sample, tmp_path, monkeypatch):
    """Distinct keys of one raw file are dealt to tasks by their number, not by their few bytes."""
    n = 1_500_000
    house = Lakehouse(spark, str(tmp_path / "house"))
    key = lambda m: (F.xxhash64("id") % m).cast("int")
    ratings = spark.range(0, n, 1, 1).select(
        key(90_000).alias("userId"), key(20_000).alias("movieId"), F.lit(3.0).alias("rating"), F.col("id").alias("timestamp")
    )
    tags = ratings.withColumn("tag", F.lit("Good")).select("userId", "movieId", "tag", "timestamp")
    house.ingest(ratings, sample.movies_raw(), tags, 1998)
    assert house.bronze_ratings.row_count() == n == house.bronze_ratings.read().count()
    seen = {}

    def look(name):
        fold = {"clean_and_enrich": silver.winners, "clean_tags": silver.clean_tags}[name]
        clean = getattr(silver, name)

        def wrapped(raw, *others):
            seen[name] = rows_by_task(raw), rows_by_task(fold(raw))
            return clean(raw, *others)

        monkeypatch.setattr(silver, name, wrapped)

    look("clean_and_enrich")
    look("clean_tags")
    before = {k: spark.conf.get(k) for k in SMALL}
    house.refine()
    assert {k: spark.conf.get(k) for k in SMALL} == before
    for scanned, folded in seen.values():
        assert sum(scanned) == n and max(scanned) < 700_000 and max(folded) < 700_000
    assert house.ratings.read().count() == n and house.tags.row_count() == tags.select("userId", "movieId").distinct().count()


def test_small_tasks_grow_beyond_their_number(spark):
    with small_tasks(spark, 3 * MOST_SMALL_TASKS * ROWS_PER_SMALL_TASK):
        assert [int(spark.conf.get(k)) for k in SMALL] == [3 * SMALL_SPLIT_BYTES, 3 * SMALL_PARTITION_BYTES, MOST_SMALL_TASKS]
    with small_tasks(spark, 0):
        assert int(spark.conf.get(SMALL[0])) == SMALL_SPLIT_BYTES and int(spark.conf.get(SMALL[2])) >= 1
