"""Documents to training sequences: quality rules, quality classifier, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import near_text, packing, quality_rules, quality_sampling, queries
from panelforge.llm.common import stored


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have no words and go; equal rows are judged alike and all stay or go."""
    return quality_rules.keep_good(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards labelled good ones keeps. Null and empty texts have no n-grams: weight zero; equal rows draw alike."""
    return quality_sampling.keep_sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest id: SimHash candidates, verified at
    Jaccard 0.8 on five-word shingles. Null and empty texts are copies of each other; of equal rows one stays."""
    return near_text.near_duplicate_free(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it. A null text is its end id alone; equal rows are packed each."""
    pieces = packing.token_pieces(docs, queries.WORD_BPE, end_id=2, capacity=4096)
    return packing.pack(pieces, capacity=4096).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: SQL cannot express tokenization, fingerprints or subset sums; tests compare run() with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
