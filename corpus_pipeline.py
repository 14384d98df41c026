"""A corpus made ready for training: five stages over the documents.

Each stage takes (spark, docs, sf_dir) and returns the documents that it leaves, with
all their columns; the last returns packed sequences. ``run`` writes what a stage
returns as Parquet and gives that to the next.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.llm import exact_dedup, jaccard_join, language_id, packing, secret_scan
from panelyard.llm.frames import documents, ship
from panelyard.session import scratch_path, scratch_run


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or text go."""
    ship(spark)
    known = docs.where(~language_id.is_held_out(F.col("doc_id")))
    return language_id.recognised(docs, language_id.train(known))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    dedup = exact_dedup.ExactDedup(spark, scratch_path(spark, "pipeline_dedup"))
    docs = dedup.scanned(docs)
    dedup.add(docs)
    return dedup.survivors(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its 5-word shingles."""
    ship(spark)
    return jaccard_join.representatives(docs, per_cent=80, size=5)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes."""
    return secret_scan.redacted(docs, secret_scan.scan(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 4096 tokens."""
    ship(spark)
    pieces = packing.packed(docs, tokenizer("word_bpe_49k.json"), end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("language_id", identified), ("exact_dedup", without_copies), ("jaccard_join", without_near_copies),
          ("secret_scan", without_secrets), ("packing", packed)]

# Language profiles, a random forest and a tokenizer cannot be said in SQL; the tests
# hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_run(spark):  # what a stage has staged goes when it is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
