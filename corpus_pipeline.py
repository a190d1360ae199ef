"""Corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept.  ``run`` applies the stages to ``documents``; every result is
written to the shared folder as Parquet and read again as the next one's
input, so a lost executor repeats tasks of one stage only.  All but the last
stage return the columns of ``documents``; the last returns the pieces of all
documents with their places in sequences of 4096 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import common, packing, quality, secrets, simhash, substrings, token_ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule, rules ordered on a sample."""
    common.arrow_batches(spark)
    return quality.keep(docs, [r for r, _, _ in quality.plan(docs)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    common.arrow_batches(spark)
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that an earlier document holds."""
    common.arrow_batches(spark)
    return substrings.remove(docs).withColumn("n_chars", F.length("text").cast("long"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by its kind."""
    common.arrow_batches(spark)
    return secrets.redact(docs, secrets.train(docs)).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    common.arrow_batches(spark)
    packed = packing.pack(packing.pieces(docs, token_ids.word_bpe_path()))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints, byte ranges and token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    out = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = common.stored(stage(spark, out, sf_dir), name.replace(" ", "-"))
    return out
