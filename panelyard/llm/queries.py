"""The registered query of each operator, with production settings."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from public_tokenizers import path as tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.llm import (
    bpe,
    exact_dedup,
    jaccard_join,
    language_id,
    lm_scoring,
    packing,
    periodic_runs,
    pieces,
    prefix_trie,
    quality_rules,
    secret_scan,
    site_quality,
    token_store,
)
from panelyard.llm.frames import documents
from panelyard.session import scratch_path


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(documents(spark, sf_dir)).withColumn("log_score", F.round("log_score", 4))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_store")
    token_store.write(documents(spark, sf_dir), folder, tokenizer("byte_bpe_50k.json"), end_id=0)
    found = token_store.read_documents(spark, folder)
    digests = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return token_store.with_starts(spark, folder, digests).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicated(documents(spark, sf_dir), scratch_path(spark, "exact_dedup"), files=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encoded(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.train_and_predict(documents(spark, sf_dir))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.with_links(documents(spark, sf_dir), per_cent=90, size=3).select(
        "doc_id", "n_shingles", "component_id")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir)).drop("text_hash")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "loss_tokens", "padded_to")


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source, its path there the language, as in the URLs of pages."""
    placed = documents(spark, sf_dir).withColumn("path", F.concat_ws("/", "source", "lang"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return site_quality.scored(placed, labels, host_col="source", path_col="path")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encoded(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", "n_tokens", F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    conv = F.col("conv_id")
    found = prefix_trie.trie(conversations, lender=conv - conv % 5,
                             n_lent=F.crc32(conv.cast("string")) % 9, most_lent=8)
    return found.withColumnRenamed("saved_bytes", "saved_tokens")


def _with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document repeats its own words from some place on; not without an id."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    start, by = h // 10 % n, 3 + h // 10 % 8
    period = 1 + (n - start) // by
    return words[:start] + [words[start + k % period] for k in range(n - start)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(documents(spark, sf_dir), reworded=_with_planted_period)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_token_store": op2_token_store,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_bpe": op5_bpe,
    "op6_language_id": op6_language_id,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_secret_scan": op8_secret_scan,
    "op9_packing": op9_packing,
    "op10_site_quality": op10_site_quality,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}
