"""Near copies: repeated ids, hot buckets, odd texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import near_copies
from tests.conftest import rows_of

A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))
SCHEMA = "doc_id long, text string, copy string, rep int"


def kept(spark, rows, parts=1):
    df = spark.createDataFrame([(i, t, "c", n) for n, (i, t) in enumerate(rows)], SCHEMA)
    found = near_copies.drop_near_copies(df.repartition(parts))
    assert found.columns == df.columns
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in found.collect())


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_an_id_that_repeats_with_another_text_loses_nothing(spark, parts):
    rows = [(3, A), (5, A), (5, B), (7, B)]
    assert kept(spark, rows, parts) == [(False, 3, A), (False, 5, B)]
    both = [(5, A), (5, A), (5, B), (9, B + " one more"), (5, "short text"), (None, A), (None, None)]
    assert kept(spark, both, parts) == sorted(
        [(False, 5, A), (False, 5, B), (False, 5, "short text"), (True, 0, A), (True, 0, "")]
    )


def test_the_least_id_of_a_group_stays(spark):
    rows = [(9, A.upper()), (4, A.replace(" ", " \t\n ")), (6, A + " more"), (2, None), (1, " "), (8, B)]
    assert kept(spark, rows) == sorted([(False, 4, A.replace(" ", " \t\n ")), (False, 1, " "), (False, 8, B)])


def test_text_key_is_that_of_the_words():
    keys = [near_copies.text_key(t) for t in ("A b", " a\x0bB\r\n", "a b", "ÀB", "àb", None, "", "\x0c")]
    assert keys[0] == keys[1] == keys[2] and keys[3] != keys[4] and keys[5] == keys[6] == keys[7]
    assert len(set(keys)) == 4


def test_one_band_that_many_rows_share(spark):
    """20,000 texts of different words in one bucket, and five near pairs among them.

    Each row is copied once for each tile of the other side, not for each row.
    """
    n = 20_000
    sketch = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, (n, near_copies.SKETCH_LONGS))
    for i in range(0, 10, 2):
        sketch[i + 1] = sketch[i]
        sketch[i + 1, 0] ^= 3
    texts = spark.createDataFrame(
        [(i, [7, i], 100, row) for i, row in enumerate(sketch.tolist())],
        "rep long, bands array<long>, kinds long, odd array<long>",
    ).repartition(8)
    shared = near_copies._shared_buckets(texts)
    none = spark.createDataFrame([], "node long, root long")
    found = near_copies._open_pairs(shared, texts, none, 0.8)
    assert sorted(rows_of(found)) == [(i, i + 1) for i in range(0, 10, 2)]
    tiles = -(-n // near_copies.TILE_ROWS)
    assert tiles * n * 2 <= 20 * n


def test_pairs_with_the_best_connected_rows(spark):
    """Those that share enough bands with a hub, against plain Python; ids repeat over bands."""
    draw = np.random.default_rng(5)
    bands = draw.integers(0, 12, (60, near_copies.BANDS)).tolist()
    texts = spark.createDataFrame(list(enumerate(bands)), "rep long, bands array<long>").repartition(4)
    found = rows_of(near_copies._hub_pairs(near_copies._shared_buckets(texts)))
    buckets = {}
    for rep, keys in enumerate(bands):
        for band, key in enumerate(keys):
            buckets.setdefault((band, key), []).append(rep)
    buckets = {k: reps for k, reps in buckets.items() if len(reps) > 1}
    met = {rep: sum(len(r) for r in buckets.values() if rep in r) for rep in range(60)}
    common = {}
    for (band, _), reps in buckets.items():
        hubs = sorted(reps, key=lambda r: (-met[r], r))[: near_copies.HUBS]
        for a, b in {(min(r, h), max(r, h)) for r in reps for h in hubs if r != h}:
            common.setdefault((a, b), set()).add(band)
    assert sorted(found) == sorted(p for p, b in common.items() if len(b) >= near_copies.SHARED_BANDS)
    assert found and len(found) < len(common)


def test_rows_are_split_by_a_filter_of_ids(spark):
    """No listed id is among the others; few are taken that are not listed; nulls are others."""
    docs = spark.range(-3_000, 3_000).selectExpr("id as doc_id", "'t' as text")
    docs = docs.union(spark.sql("select null, 'none'"))
    ids = spark.range(-3_000, 3_000, 7).select(F.col("id").alias("doc_id"))
    found, others = near_copies._by_ids(docs, ids)
    assert found.columns == others.columns == docs.columns
    found, others = [{r.doc_id for r in side.collect()} for side in (found, others)]
    listed = set(range(-3_000, 3_000, 7))
    assert listed <= found and None in others and not found & others
    assert found | others == {None, *range(-3_000, 3_000)} and len(found - listed) < 300
    assert near_copies._by_ids(docs, ids.limit(0))[0].isEmpty()


def test_a_full_filter_takes_all_rows(spark, monkeypatch):
    """Beyond the largest filter more rows are looked up, none is lost."""
    monkeypatch.setattr(near_copies, "MOST_BLOCKS", 1)
    docs = spark.range(400_000).selectExpr("id as doc_id")
    found, others = near_copies._by_ids(docs, docs)
    assert (found.count(), others.count()) == (400_000, 0)


def _shuffle_bytes(spark) -> int:
    context = spark.sparkContext
    gateway = context._gateway
    no_list = gateway.jvm.java.util.ArrayList()
    store = context._jsc.sc().statusStore()
    stages = store.stageList(no_list, False, False, gateway.new_array(gateway.jvm.double, 0), no_list)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_that_stay_are_not_shuffled(spark, tmp_path):
    """Of 600 long texts 20 have a near copy: the texts shuffled are those, not all three times."""
    draw = np.random.default_rng(3)
    texts = [" ".join(np.base_repr(x, 36) for x in draw.integers(1 << 40, 1 << 41, 2_000)) for _ in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1_000 + i, f"{texts[i]} more") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    # As with tables too large for Spark to broadcast on its own.
    settings = {f"spark.sql{part}.autoBroadcastJoinThreshold": -1 for part in ("", ".adaptive")}
    given = {key: spark.conf.get(key) for key in settings}
    before = _shuffle_bytes(spark)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        near_copies.drop_near_copies(docs).write.parquet(f"{tmp_path}/kept")
    finally:
        for key, value in given.items():
            spark.conf.set(key, value)
    moved = _shuffle_bytes(spark) - before
    assert sorted(r.doc_id for r in spark.read.parquet(f"{tmp_path}/kept").collect()) == list(range(600))
    assert moved < 0.5 * sum(len(t) for t in texts)
