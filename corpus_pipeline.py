"""A corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, mixing to target weights, BPE encoding.

Each stage gets all rows that the one before it kept, as Parquet in the folder that the cluster shares, and returns the columns of
documents; the last returns one row per document (repeats of the mix included) with token counts and digests. An empty
table passes through every stage. Columns of documents besides doc_id, text and source are carried as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import bpe, exact_dedup, mixing, quality, simhash
from tidewell.llm.shared import shared_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field predicts to be good. Fitted on the labelled rows that are not held out."""
    chain = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, chain)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: 0, 1 or 2 times."""
    return mixing.repeat_rows(docs, mixing.mix(docs, mixing.words()))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, digests of ids and decoded text."""
    return bpe.encode(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("bpe encoding", encoding_stage),
]

#: SQL expresses neither the fitted field nor the tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written in the shared folder and read again, then what it read is deleted."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
    return docs
