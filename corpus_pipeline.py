"""From raw documents to packed sequences: language, quality, near duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linewatch.llm import language, quality, simhash
from linewatch.llm.packing import pack
from linewatch.session import staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those in none of the languages that the corpus is labelled with."""
    labelled = docs.select("lang", "text")
    model = language.learn(labelled)
    return docs.where(language.is_known(model, least=language.least_shares(labelled, model)))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that fail the quality rules; trusted texts are those labelled good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return docs.where(quality.is_good(docs, labels))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group linked by SimHash: shingles of 4 words, at most 4 bits apart."""
    return simhash.keep_first(docs, width=4, distance=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 ids."""
    return pack(docs, length=2048)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("packing", packed),
]

ORACLE_SQL = None  # neither hashing texts nor learning languages is SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every other stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
