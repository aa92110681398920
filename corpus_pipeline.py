"""Documents to training sequences: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored and read again as
the next stage's documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import cotraining, hd_language, near_copies, vector_packing
from reelhouse.session import new_work_path, remove_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _filtered(docs: DataFrame, added: tuple[str, ...], judge, keep, filled=None) -> DataFrame:
    """Rows that ``keep`` accepts of what ``judge`` adds; columns of ``docs`` named so are set aside.

    ``filled`` holds new values of other columns, made from what was added.
    """
    aside = {c: f"given {c}" for c in docs.columns if c.lower() in added}
    judged = judge(docs.withColumnsRenamed(aside)).where(keep)
    back = {new: old for old, new in aside.items()}
    rows = judged.withColumns(filled or {}).drop(*added).withColumnsRenamed(back)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: a null text, or one without a letter; name the others' language.

    A document whose ``lang`` is null gets the predicted one, which the later stages read; where none was
    learned it stays null. A given ``lang`` is left as it is, and every document with a letter stays.
    """
    prototypes = hd_language.learn(docs.where(~hd_language.held_out(F.col("doc_id"))))
    return _filtered(
        docs,
        ("lang_pred", "score", "lettered"),
        lambda rows: hd_language.identify(rows, prototypes, lettered=True),
        F.col("lettered"),
        {"lang": F.coalesce("lang", F.nullif("lang_pred", F.lit(hd_language.UNKNOWN)))},
    )


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the two co-trained views together find bad."""
    model = cotraining.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _filtered(
        docs, cotraining.ADDED, lambda rows: cotraining.score(rows, model), F.col("keep")
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    return near_copies.drop_near_copies(docs, words=5, similarity=0.8)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place in it."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = vector_packing.token_pieces(docs, tokenizer, max_tokens=4096, end_id=1)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return vector_packing.pack(digests, docs.count(), vector_packing.Capacities(tokens=4096))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_copies),
    ("packing", pack_sequences),
]

#: No stage can be expressed in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are a Parquet table.

    A stage's table is removed once the next one's is written; the last one stays.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = new_work_path(spark, "corpus"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            remove_path(spark, before)
        before = f"{folder}/{name}"
        docs = spark.read.parquet(before)
    return docs
