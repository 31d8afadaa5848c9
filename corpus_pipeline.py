"""The corpus pipeline: documents in, token ids of the documents worth training on out.

Every stage takes the documents that the stage before kept and returns documents again; the last one returns
their encoding. ``run`` writes each stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.llm import byte_bpe, decontaminate, ngram_join, quality, substring_dedup
from kerbside.llm.words import bound_batches
from kerbside.operators.staging import shared_folder

#: The stages' decisions come from fitted trees and a tokenizer's merges, which SQL cannot express.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; of rows that repeat a ``doc_id``, each is judged by its own text."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one whose id names the group."""
    return ngram_join.keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere too; documents that nothing is left of go."""
    bound_batches(spark)
    cut = substring_dedup.remove_repeated(docs).withColumn("n_chars", F.length("text").cast("long"))
    return cut.where(F.length(F.coalesce("text", F.lit(""))) > 0).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with their count and digests."""
    bound_batches(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(byte_bpe.encode_documents(docs, ranks, pattern, decode=True))


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over all documents of ``sf_dir``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
