"""The corpus pipeline: documents pass the stages in order, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citygrain.llm import bpe, decontaminate, simhash, suffix_dedup, toxicity
from citygrain.llm.queries import VOCABULARY
from citygrain.scale import work_folder


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of toxicity; the model learns from the labels of the training fold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~toxicity.held_out())
    return toxicity.drop_toxic(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that stand more than once among the documents left."""
    return suffix_dedup.without_repeats(docs, suffix_dedup.LONG_WORDS, words=True)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold passages of the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digests of ids and decoded text."""
    return bpe.encode_documents(docs, VOCABULARY)


STAGES = [
    ("toxicity", clean),
    ("simhash", distinct),
    ("suffix_dedup", unrepeated),
    ("decontamination", uncontaminated),
    ("bpe", encoded),
]

#: Learned weights, fingerprints and merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what a stage keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
