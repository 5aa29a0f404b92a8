"""The corpus pipeline: documents through quality rules, line dedup, near-dedup, secret scans and packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next stage's `docs`. All stages but the last return the columns of `documents`.
NULL texts, repeated rows and empty tables are handled as the operators of `starlog.llm` state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.llm import line_dedup, packing, quality_rules, secret_scan, simhash
from starlog.llm.queries import WORD_TOKENIZER
from starlog.session import scratch_path
from starlog.sources.files import read_table


def _as_documents(cut: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with n_chars brought up to a changed text."""
    counted = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return counted.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their hosts' boilerplate lines."""
    return _as_documents(line_dedup.dedup_lines(docs, count=None), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every found secret replaced by a mark."""
    found = secret_scan.scan(docs, scratch_path(spark, "ledger"))
    return _as_documents(secret_scan.redact_found(docs, found), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, WORD_TOKENIZER, end_id=2)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("packing", pack),
]

#: Tokenizing is beyond SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
