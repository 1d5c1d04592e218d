"""Corpus pipeline: toxicity, line dedup, MinHash near-dedup, mixing to target weights, SentencePiece ids.

Each stage takes what its predecessor kept, written as Parquet to the shared folder and read again.  All but the last return
the columns of ``documents``:

1. documents whose toxicity score reaches 0.5 go;
2. lines that match an earlier line of the corpus go, and documents of which nothing is left;
3. of each group of near-duplicates the document with the smallest id stays;
4. sources are mixed to weights 1, 2, 3, repeating by code point: a document stays once, twice or three times, or goes;
5. texts become the ids of a public SentencePiece model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidbox.llm import bagminhash, linejoin, mixing, spm, toxicity
from bidbox.llm.common import materialize, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linejoin.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids); null for a null text."""
    return spm.encode(docs).withColumn("n_ids", F.when(F.col("ids").isNotNull(), F.size("ids")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("SentencePiece", to_ids),
]

#: No stage is expressible in SQL; tests/llm/test_pipeline.py holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
