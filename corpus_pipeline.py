"""A training corpus from raw documents, in stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's documents.  All but the last keep
the columns of documents.  Rules, near copies and sampling drop documents;
secrets are masked in the text of documents that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm import op2_mixing, op4_quality_votes, op7_simhash_trie, op8_packing, op10_secret_scan
from docsmith.llm.common import table
from docsmith.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps."""
    return op4_quality_votes.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return op7_simhash_trie.one_per_group(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return op10_secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the budget's size whose expected tokens meet the target
    shares as far as the documents' tokens allow."""
    return op2_mixing.sample_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return op8_packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing", source_mixing),
    ("best-fit packing", packing),
]

#: SQL has neither XXH64 nor the tokenizer: tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
