"""Exact deduplication with keyed stream state that never expires.

Three steps, all built-in functions:

1. ``add`` writes a fingerprint of every new document: id, digest of the normalised
   text, and the locator of its content (file and row).
2. A Structured Streaming aggregation by digest reads the fingerprints once and keeps, in
   a state store on disk, the digest, how many documents have it and the smallest id
   with its locator. There is no watermark, so nothing is forgotten; a later ``add``
   or a restart goes on from the checkpoint.
3. ``decisions`` reads that state as a table. Where a digest was hit more than once, the
   full texts of its documents are compared: they are grouped by digest and bytes, and
   a group that does not hold the kept content is a group of its own. Equal texts
   meet in the partial aggregation first, so a text that a third of all documents
   share is one row per task in the shuffle.

Texts are equal when identical after every run of white space became one space.

Defined results: a null text counts as empty, and empty texts are copies of each other;
of rows with equal text and equal id the first by locator stays; a null id ranks
behind all others; an empty table gives an empty result. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.llm.frames import SPACE_RUN, at, named, numbered, or_empty, pick
from panelyard.session import file_system

_STORE = "spark.sql.streaming.stateStore"
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads its changes only, and files take no more room than they fill.
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
}
LOCATOR = ["file", "row"]
FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


@contextmanager
def checkpoint_files(spark: SparkSession, folder: str) -> Iterator[None]:
    """State files on a local or mounted disk are renamed inside the process.

    Spark's default asks eight times for each state file whether it is a link, and on such
    disks Hadoop without its native library starts a process of its own for each question.
    """
    before = spark.conf.get(FILE_MANAGER, None)
    local = file_system(spark, folder)[0].getScheme() == "file"
    if local and before is None:
        spark.conf.set(FILE_MANAGER, _BY_FILE_SYSTEM)
    try:
        yield
    finally:
        if local and before is None:
            spark.conf.unset(FILE_MANAGER)


def normalised(text: Column) -> Column:
    return F.regexp_replace(or_empty(text), SPACE_RUN, " ")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


class ExactDedup:
    """Deduplication whose state lives in ``folder``, which all executors share.

    ``digest`` of the normalised text may be any function; results do not depend on
    it, as bytes are compared.
    """

    def __init__(self, spark: SparkSession, folder: str, id_col: str = "doc_id",
                 text_col: str = "text", digest: Callable[[Column], Column] = sha256):
        self.spark, self.folder = spark, folder
        self.id_col, self.text_col, self.digest = id_col, text_col, digest

    def located(self, documents: DataFrame) -> DataFrame:
        """Id, text and locator; ``documents`` must be a plain scan of files."""
        plain = numbered(documents)
        place = plain.metadataColumn("_metadata")
        return plain.select(at(documents, self.id_col).alias("id"), at(documents, self.text_col).alias("text"),
                            place.getField("file_path").alias("file"), place.getField("row_index").alias("row"))

    def copied(self, documents: DataFrame) -> DataFrame:
        """The needed columns of any table, written to the folder to have locators."""
        path = f"{self.folder}/documents"
        rows = pick(documents, self.id_col, self.text_col)
        rows.write.mode("append").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def scanned(self, documents: DataFrame) -> DataFrame:
        """``documents`` if they are read from files; else a copy with all columns that is."""
        try:
            self.located(documents)
            return documents
        except AnalysisException:
            path = f"{self.folder}/rows/{uuid.uuid4().hex}"
            numbered(documents).write.parquet(path)
            return self.spark.read.parquet(path).toDF(*documents.columns)

    def add(self, documents: DataFrame) -> None:
        """Takes new documents, a plain scan of files, into the state."""
        rows = self.located(documents)
        prints = rows.select("id", self.digest(normalised(F.col("text"))).alias("digest"), *LOCATOR)
        path = f"{self.folder}/fingerprints"
        prints.write.mode("append").parquet(path)
        for name, value in STATE_CONF.items():
            self.spark.conf.set(name, value)
        first = F.struct(F.col("id").isNull().alias("no_id"), "id", *LOCATOR)
        with checkpoint_files(self.spark, self.folder):
            (self.spark.readStream.schema(prints.schema).parquet(path)
             .groupBy("digest").agg(F.min(first).alias("first"), F.count("*").alias("n"))
             .writeStream.outputMode("update").format("noop")
             .option("checkpointLocation", f"{self.folder}/state")
             .trigger(availableNow=True).start().awaitTermination())

    def state(self) -> DataFrame:
        """One row per digest: ``keep_id``, ``keep_file``, ``keep_row`` and ``n``."""
        raw = self.spark.read.format("statestore").load(f"{self.folder}/state")
        first = F.col("value").getField("min")
        return raw.select(
            F.col("key.digest").alias("digest"), first.getField("id").alias("keep_id"),
            *[first.getField(x).alias(f"keep_{x}") for x in LOCATOR],
            F.col("value").getField("count").alias("n"))

    def decisions(self, documents: DataFrame) -> DataFrame:
        """One row per document that was added; ``documents`` are all of them.

        Returns the id, ``keep_id``, ``group_size``, ``kept``, ``digest`` and the locator.
        """
        path = f"{self.folder}/fingerprints"
        prints = self.spark.read.parquet(path).join(self.state(), "digest")
        checked_path = f"{self.folder}/checked/{uuid.uuid4().hex}"
        texts = self.located(documents).select(*LOCATOR, normalised(F.col("text")).alias("bytes"))
        kept_here = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
        hits = prints.where("n > 1").join(texts, LOCATOR)
        (hits.groupBy("digest", "bytes")
         .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", *LOCATOR)).alias("first"),
              F.count("*").alias("n"), F.max(kept_here).alias("holds_kept"))
         .withColumn("text_key", F.when(F.col("holds_kept"), F.lit(None)).otherwise(F.col("bytes")))
         .drop("bytes").write.parquet(checked_path))
        checked = self.spark.read.parquet(checked_path)
        mixed = checked.where(~F.col("holds_kept")).select("digest").distinct()
        every = prints
        if not mixed.isEmpty():
            every = prints.join(mixed, "digest", "left_anti").unionByName(
                self._by_bytes(hits.join(mixed, "digest", "left_semi"), checked))
        return every.select(F.col("id").alias(self.id_col), "keep_id", F.col("n").alias("group_size"),
                            kept_here.alias("kept"), "digest", *LOCATOR)

    def _by_bytes(self, rows: DataFrame, checked: DataFrame) -> DataFrame:
        """Rows whose digest stands for several texts, each with its own group."""
        # The kept content's group goes without its bytes in the table.
        own = checked.where("text_key is not null").select(
            "digest", F.col("text_key").alias("bytes"), "first", F.col("n").alias("own_n"))
        kept = checked.where("text_key is null").select(
            "digest", F.col("first").alias("kept_first"), F.col("n").alias("kept_n"))
        joined = rows.join(own, ["digest", "bytes"], "left").join(kept, "digest", "left")
        first = F.coalesce("first", "kept_first")
        return joined.select(
            "digest", "id", *LOCATOR, first.getField("id").alias("keep_id"),
            *[first.getField(x).alias(f"keep_{x}") for x in LOCATOR],
            F.coalesce("own_n", "kept_n").alias("n"))

    def survivors(self, documents: DataFrame) -> DataFrame:
        """``documents``, all columns, without the copies."""
        dropped = self.decisions(documents).where(~F.col("kept")).select(*LOCATOR)
        plain = numbered(documents)
        place = plain.metadataColumn("_metadata")
        left = plain.join(dropped, (place.getField("file_path") == F.col("file"))
                          & (place.getField("row_index") == F.col("row")), "left_anti")
        return named(left, documents)


def deduplicated(documents: DataFrame, folder: str, files: bool = False, **names: str) -> DataFrame:
    """``decisions`` for one table; ``files`` if it is a plain scan of files."""
    dedup = ExactDedup(documents.sparkSession, folder, **names)
    source = documents if files else dedup.copied(documents)
    dedup.add(source)
    return dedup.decisions(source)
