"""From raw documents to packed training bins, in five stages.

Each stage works on all rows that its predecessor kept, written as Parquet and read again:

1. language ID: rows whose language cannot be told go;
2. MinHash near-dedup: the row with the smallest doc_id of each group of near-duplicates stays;
3. suffix-array dedup: byte strings of 200 that start elsewhere too are cut out;
4. benchmark decontamination: rows that hold a window of a benchmark item go;
5. best-fit packing: the rest is packed into bins.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratawell.llm import bayes_language, best_fit_packing, positional_index, repeated_substrings, tensored_minhash
from stratawell.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows whose language is found; the model learns from rows that are not held out."""
    model = bayes_language.fit(docs.where(~bayes_language.held_out(F.col("doc_id"))))
    return bayes_language.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates, by shingles of five words."""
    return tensored_minhash.keep_one(docs, tensored_minhash.Banding(shingle=5))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out long strings that occur elsewhere too."""
    return repeated_substrings.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows without a window of the benchmark."""
    return positional_index.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and offset of every row."""
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]
# Naive Bayes, min-hashing and packing cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
