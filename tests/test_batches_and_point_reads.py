"""Batches in plain Parquet, ratings kept up across batches, point reads of one bucket."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators.running import place_in_key
from reelhouse.plans import live, replicas, silver
from reelhouse.plans.rating_batches import RatingBatches
from reelhouse.sources.batch_table import BatchTable
from tests.conftest import plan_of, rows_of


def ratings(spark, rows):
    return spark.createDataFrame(rows, schemas.RATINGS_CSV)


def files_of(folder):
    return sorted((str(p), p.stat().st_mtime_ns) for p in Path(folder).rglob("*.parquet"))


def test_a_rerun_replaces_its_own_batch_only(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.RATINGS_CSV)
    one, two = ratings(spark, [(1, 1, 4.0, 5), (1, 2, 3.0, 6)]), ratings(spark, [(2, 1, 1.0, None)])
    assert table.write(one, "a", [F.count("*").alias("n")]) == {"n": 2}
    table.write(two, "b")
    before = files_of(tmp_path / "t" / "batch_id=b")
    table.write(one.limit(1), "a")
    assert files_of(tmp_path / "t" / "batch_id=b") == before
    assert {(r.batch_id, r.rows) for r in table.sizes().collect()} == {("a", 1), ("b", 1)}
    assert table.read("b").drop("batch_id").collect() == two.collect()
    assert "batch_id" in plan_of(table.read("b")).split("PartitionFilters")[1].split("]")[0]
    # Several batches in one pass; a batch without rows leaves its folder as it is.
    table.write(one, F.when(F.col("movieId") == 1, "c").otherwise("d"))
    assert {r.batch_id for r in table.sizes().collect()} == {"a", "b", "c", "d"}


OLD = [(1, 1, 4.0, 100), (1, 2, 7.0, 100), (1, 3, None, 200), (2, 1, 3.0, 31_536_100), (2, 2, 2.0, None)]


@pytest.mark.parametrize("new, years", [
    ([(1, 1, 4.0, 100), (1, 1, 2.0, 100)], []),  # known, or lower
    ([(1, 2, 5.0, 100)], []),  # a rating out of range has won before
    ([(1, 1, 4.5, 100)], [1970]),
    ([(1, 3, 1.0, 200), (1, 3, None, 200)], [1970]),
    ([(2, 2, 2.5, None), (2, 2, 2.0, None)], [-1]),
    ([(9, 9, 3.0, 63_072_100), (None, 1, 3.0, 5), (2, 1, 9.0, 31_536_100)], [1971, 1972]),
    ([], []),
])
def test_ratings_across_batches(spark, tmp_path, new, years):
    batches = RatingBatches(spark, str(tmp_path / "t"))
    assert batches.load(ratings(spark, OLD)) == [-1, 1970, 1971]
    before = {p.name: files_of(p) for p in (tmp_path / "t").glob("key_year=*")}
    assert batches.load(ratings(spark, new)) == years
    assert batches.load(ratings(spark, new)) == []
    full = silver.clean_ratings(ratings(spark, OLD + new))
    assert sorted(map(repr, rows_of(batches.cleaned()))) == sorted(map(repr, rows_of(full)))
    for name, files in before.items():
        changed = files_of(tmp_path / "t" / name) != files
        assert changed == (int(name.split("=")[1]) in years)


def test_only_the_years_of_a_batch_are_read(spark, tmp_path):
    batches = RatingBatches(spark, str(tmp_path / "t"))
    batches.load(ratings(spark, OLD))
    plan = plan_of(batches.cleaned([1971]))
    assert "PartitionFilters: [isnotnull(key_year" in plan and "1971" in plan


def test_places_in_keys_of_any_size(spark):
    """One key holds most rows and is cut into many ranges, whose rows are ordered in different tasks."""
    rows = spark.range(0, 9000).selectExpr(
        "if(id % 9 = 0, id % 7, if(id % 11 = 0, null, 42)) as user", "(id * 7919) % 9001 as score", "id as place"
    )
    found = place_in_key(rows, "user", [F.desc("score")], "place", rows_per_part=300)
    assert found.columns == ["user", "score", "place"]
    by_user = {}
    for r in found.collect():
        by_user.setdefault(r.user, []).append((r.place, -r.score))
    for places in by_user.values():
        places.sort()
        assert [p for p, _ in places] == list(range(len(places)))
        assert [s for _, s in places] == sorted(s for _, s in places)
    assert len(by_user[42]) > 7000 and None in by_user
    assert "SinglePartition" not in plan_of(found)


def test_documents_of_a_large_user(spark):
    rows = spark.range(0, 5000).selectExpr("7 as userId", "cast(id as int) as movieId", "id / 10 as predicted_score")
    documents = replicas.user_documents(rows, page_items=400, rows_per_part=500).orderBy("page").collect()
    assert [len(d["items"]) for d in documents] == [400] * 12 + [200]
    assert [i.movie_id for d in documents for i in d["items"]] == list(range(4999, -1, -1))


def test_a_point_read_opens_one_bucket(spark, tmp_path):
    rows = spark.range(0, 400).selectExpr("id % 50 as userId", "cast(id as int) as movieId", "1.0 as predicted_score")
    documents = replicas.user_documents(rows)
    replicas.store_buckets(documents, "tested_documents", str(tmp_path / "d"), "user_id", buckets=16)
    found = spark.table("tested_documents").where("user_id = 42").select(F.input_file_name().alias("file"))
    (bucket,) = {r.file.rsplit("/", 1)[1] for r in found.collect()}
    files = list(Path(tmp_path / "d").glob("*.parquet"))
    assert len(files) == 16
    # A scan of any other file would fail now.
    for file in files:
        if file.name != bucket:
            file.write_bytes(b"no table")
    one = live.user_document(spark.table("tested_documents"), 42)
    assert [len(r["items"]) for r in one.collect()] == [8]
    spark.sql("drop table tested_documents")
