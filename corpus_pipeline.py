"""Corpus pipeline: five stages over ``documents``, each one operator of ``tariffloom.llm``.

Every stage reads what its predecessor kept, as a written table, and works on all of it:

toxicity          rows scored at least 0.5 go; the model learns from the labels of the training folds
near duplicates   one document of each SimHash component stays, its smallest id
decontamination   documents that the contamination rule marks go
secrets           every span is masked in the text, and n_chars follows
packing           the last stage: doc_id, length in words, bucket, bucket_len, batch, slot, padding

NULL and empty texts pass the filters (they are one near-duplicate component); empty tables pass through; other columns,
whatever their names, are kept until packing. SQL can't express learned scores or XXH64, so there is no SQL answer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm import decontam, packing, secrets, simhash, toxicity
from tariffloom.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", packing.word_count(F.col("text")).alias("length")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_batches),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each is written to the session's shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
