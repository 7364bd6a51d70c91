"""A corpus made ready for training: five stages over ``documents``.

Each stage takes what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import line_crf, packing, simhash, substrings, toxicity
from turnloom.llm.queries import CATEGORIES, table, tokenizer_path
from turnloom.operators.scale import cut_lineage


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below the threshold."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.fit(documents, labels, CATEGORIES)
    p = toxicity.probabilities(chain).getField("toxic")
    return docs.filter(p < toxicity.THRESHOLD)


def poor_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = line_crf.fit(documents, labels)
    return docs.filter(line_crf.judge(field).getField("kept"))


def near_duplicates_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def repeated_passages_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    return substrings.with_kept_text(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in training sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxic_documents_go),
    ("quality rules", poor_documents_go),
    ("simhash near-dedup", near_duplicates_go),
    ("substring dedup", repeated_passages_go),
    ("best-fit packing", packed),
]

# The stages train models, search by bits and pack: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
