"""From raw documents to tokens: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, pieces, quality, simhash, suffix_dedup
from tidemark.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash, the one with the smallest doc_id stays."""
    return simhash.deduplicated(docs, words=4, seed=42)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that also start elsewhere go; a document that loses all its text goes."""
    return suffix_dedup.cleaned(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, segmented with seeded merge-dropout."""
    return pieces.encoded(docs, pieces.model_file(), dropout=0.1, seed=42)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier and the Golay keys are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None
