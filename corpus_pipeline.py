"""From ``documents`` to a sharded training corpus, five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; its result is written as Parquet in the shared folder and
read back as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns where each document goes.

Null or empty texts are documents like others (they are scored, are copies of
each other, match no benchmark item, stay once in the mix and get a slot).
Null ids, repeated rows and additional columns are carried through; wholly
repeated rows are copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.llm import bm25_wand, label_shards, mixing, quality_cnn, simhash
from supplyscope.llm.common import crc_fold, free_names, table
from supplyscope.session import drop_path, scratch_path

GOOD = 0.3                 # least quality score of a document that stays


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores ``GOOD`` or more, learned from the labelled folds 1 to 4 of 5."""
    model = quality_cnn.train(docs, table(spark, sf_dir, "labels"), crc_fold("doc_id", 5) != 0)
    (score,) = free_names(docs, "_score")
    return quality_cnn.scored(docs, model, name=score).where(F.col(score) >= GOOD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints at 3 bits or fewer of 3-word shingles."""
    return simhash.representatives(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return bm25_wand.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row."""
    out = label_shards.shard_documents(docs)
    return out.select(F.col("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "law", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shards", shards),
]

#: Trained weights, fingerprints and label propagation have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"corpus-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last is not None:
            drop_path(spark, last)
        last = path
    return docs
