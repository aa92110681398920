"""The pipeline and the registered queries against plain Python on the sample."""

import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from reelhouse.llm import queries
from reelhouse.session import new_work_path
from tests.conftest import SAMPLE_FOLDER


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_equals_its_sql(spark, name):
    found = queries.all_queries()[name](spark, SAMPLE_FOLDER)
    assert differences(found, connect(SAMPLE_FOLDER), queries.all_sql()[name]) == []


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.all_queries())
    assert numbers == list(range(1, 14))


def _groups(docs):
    """doc_id -> least doc_id reachable over shingle sets at least 0.8 alike."""
    sets = {}
    for d in docs:
        words = d.text.lower().split()
        sets[d.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    holders = defaultdict(list)
    root = {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for doc in sorted(sets):
        root[doc] = doc
        common = defaultdict(int)
        for shingle in sets[doc]:
            for other in holders[shingle]:
                common[other] += 1
            holders[shingle].append(doc)
        for other, n in common.items():
            if n >= 0.8 * (len(sets[doc]) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: find(doc) for doc in root}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SAMPLE_FOLDER}/labels.parquet").collect()}
    extra = docs.limit(1).selectExpr("-1L as doc_id", "'12 !!' as text", "lang", "source", "n_chars")
    given = docs.union(extra)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, given, SAMPLE_FOLDER).write.parquet(f"{tmp_path}/{name}")
        given = spark.read.parquet(f"{tmp_path}/{name}")
        after[name] = given
        if name != "packing":
            assert given.columns == docs.columns
    rows = {name: df.collect() for name, df in after.items()}
    assert {r.doc_id for r in rows["language"]} == {r.doc_id for r in docs.collect()}
    kept = {r.doc_id for r in rows["quality"]}
    good = {d for d, q in labels.items() if q}
    assert len(good & kept) >= 0.99 * len(good)
    assert len(set(labels) - good - kept) >= 0.95 * len(set(labels) - good)
    roots = _groups(rows["quality"])
    assert {r.doc_id for r in rows["near_duplicates"]} == set(roots.values())
    assert {r.doc_id for r in rows["packing"]} == set(roots.values())
    filled = defaultdict(int)
    for r in rows["packing"]:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 4096
    assert len(filled) <= -(-sum(filled.values()) // 4096) + 2


def test_stage_columns_may_clash(spark):
    docs = spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet").limit(40)
    odd = docs.selectExpr("*", "'a' as score", "1 as keep", "2 as lang_pred", "3 as rep", "4 as piece")
    for name, stage in corpus_pipeline.STAGES[:3]:
        found = stage(spark, odd, SAMPLE_FOLDER)
        assert found.schema == odd.schema
        assert {(r.score, r.keep, r.lang_pred) for r in found.collect()} == {("a", 1, 2)}
    assert corpus_pipeline.STAGES[3][1](spark, odd, SAMPLE_FOLDER).count() >= 40


def test_run_on_an_empty_table(spark, tmp_path):
    for table in ("documents", "labels"):
        rows = spark.read.parquet(f"{SAMPLE_FOLDER}/{table}.parquet").limit(0)
        rows.write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("lang", ["cast(null as string)", "'und'", "case when crc32(binary(string(doc_id))) % 4 = 2 then lang end"])
def test_language_stage_keeps_all_lettered_texts(spark, lang):
    docs = spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet").limit(60).selectExpr(
        "doc_id", "text", f"{lang} as lang", "source", "n_chars", "7 as lettered"
    )
    odd = docs.limit(3).selectExpr(
        "-1L - doc_id as doc_id", "element_at(array('12 !!', '', null), int(doc_id % 3) + 1) as text",
        "lang", "source", "n_chars", "lettered",
    )
    found = corpus_pipeline.identify_language(spark, docs.union(odd), SAMPLE_FOLDER)
    assert found.columns == docs.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, docs.collect()))


def test_language_stage_names_the_language_of_documents_without_one(spark):
    docs = spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet")
    given = {r.doc_id: r.lang for r in docs.collect()}
    some = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    found = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, some, SAMPLE_FOLDER).collect()}
    filled = [i for i in found if i % 5 == 0 and given[i]]
    assert len(filled) > 100
    assert all(found[i] == given[i] for i in found if i % 5)
    assert sum(found[i] == given[i] for i in filled) >= 0.98 * len(filled)


def test_run_leaves_the_last_table_only(spark):
    folder = new_work_path(spark, "sample")
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SAMPLE_FOLDER}/{table}.parquet").limit(60).write.parquet(f"{folder}/{table}.parquet")
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 0
    (used,) = {Path(f.removeprefix("file:")).parent for f in rows.inputFiles()}
    assert [p.name for p in used.parent.iterdir()] == ["packing"]
