"""The ingestion and windowing steps as Structured Streaming jobs.

A stream reads each landed file once, removes repeated ids, and counts per calendar chunk.
Every batch writes what it changed to a folder of its own and marks that as finished, so a
batch that is repeated after a crash changes nothing. The current state is a snapshot
with the finished changes behind it.

Two ways to count. ``chunk_totals`` keeps windows in the stream's state and closes them by the
watermark; rows and copies that come later than that are not counted. ``write_counted`` closes
nothing: each batch adds its own counts, rows that come when their chunk is over by the
watermark are also put in a side table, and the chunk's totals then hold them too.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelyard.functions.calendar import chunk_start, chunk_window_offset
from panelyard.functions.scalars import money_sum
from panelyard.session import delete, exists, make_marker, markers

TOTAL_KEYS = ("chunk_start", "tipo")
Merge = Callable[[DataFrame], DataFrame]


def stream_parquet(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet",
                   files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def unique_within_watermark(stream: DataFrame, key: str, moment: str, lateness: str) -> DataFrame:
    """At-least-once delivery made once, for copies that arrive within ``lateness``."""
    return stream.withWatermark(moment, lateness).dropDuplicatesWithinWatermark([key])


def first_copies(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first copy of every key by ``order``, however late the copies come.

    As a stream (output mode update, for ``write_changes``) the state has one row per key and
    never expires; a key is given out again when a copy of it has come, with the copy that
    is first by then. Rows without a key are one group, as in the batch.
    """
    others = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*").select(*rows.columns)


def chunk_totals(stream: DataFrame, moment: str, kind: str, value: str, chunk_days: int = 7,
                 sum_scale: int | None = None) -> DataFrame:
    """Count and value per calendar chunk and kind; works on batches as well."""
    days = f"{chunk_days} days"
    window = F.window(moment, days, days, chunk_window_offset(chunk_days))
    return (stream.groupBy(window.alias("w"), F.col(kind).alias("tipo"))
            .agg(F.count(F.lit(1)).alias("n_itens"),
                 money_sum(F.col(value), sum_scale).alias("valor_total"))
            .select(F.col("w.start").cast("date").alias("chunk_start"), "tipo",
                    "n_itens", "valor_total"))


# Tables of changes

class Changes:
    """A table that batches change.

    ``changes/epoch=N`` has what batch N wrote, ``base/generation=G`` the state after batch G.
    Both count only once their marker is there. A reader takes the last finished base and
    the finished changes behind it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def finished(self, part: str) -> list[int]:
        """Numbers of the finished folders: one for each batch since the last compaction."""
        return markers(self.spark, f"{self.path}/{part}/_finished")

    def mark(self, part: str, number: int) -> None:
        make_marker(self.spark, f"{self.path}/{part}/_finished/{number}")

    def write_batch(self, batch: DataFrame, epoch: int) -> None:
        """Writes a batch's changes. What a finished batch has written stays when it is repeated;
        it runs all the same, since the stream's state needs that."""
        base = self.finished("base")
        if epoch in self.finished("changes") or base and epoch <= base[-1]:
            batch.write.format("noop").mode("overwrite").save()
            return
        batch.write.mode("overwrite").parquet(f"{self.path}/changes/epoch={epoch}")
        self.mark("changes", epoch)

    def _read(self, base: int | None, epochs: list[int]) -> DataFrame | None:
        parts = []
        if base is not None:
            parts.append(self.spark.read.parquet(f"{self.path}/base/generation={base}"))
        if epochs:
            paths = [f"{self.path}/changes/epoch={n}" for n in epochs]
            parts.append(self.spark.read.option("basePath", f"{self.path}/changes").parquet(*paths)
                         .withColumn("epoch", F.col("epoch").cast("long")))
        return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def rows(self) -> DataFrame:
        """Base and later changes, with the ``epoch`` of each row."""
        base = (self.finished("base") or [None])[-1]
        found = self._read(base, [n for n in self.finished("changes") if base is None or n > base])
        if found is None:
            raise FileNotFoundError(f"no finished batch in {self.path}")
        return found

    def compact(self, merge: Merge) -> None:
        """Folds changes into a new base.

        The last batch may have been written and not committed, and is then repeated: it is
        left out, so a base holds committed batches only. What the new base replaces
        stays until the next compaction, for readers that have begun.
        """
        bases, epochs = self.finished("base"), self.finished("changes")
        base = bases[-1] if bases else None
        folded = [n for n in epochs[:-1] if base is None or n > base]
        if not folded:
            return
        state = merge(self._read(base, folded))
        state.write.mode("overwrite").parquet(f"{self.path}/base/generation={folded[-1]}")
        self.mark("base", folded[-1])
        if base is not None:
            for n in [n for n in epochs if n <= base]:
                delete(self.spark, f"{self.path}/changes/_finished/{n}")
                delete(self.spark, f"{self.path}/changes/epoch={n}")
            for n in bases[:-1]:
                delete(self.spark, f"{self.path}/base/_finished/{n}")
                delete(self.spark, f"{self.path}/base/generation={n}")

    def check_checkpoint(self, checkpoint: str) -> None:
        """Batches are numbered by the checkpoint, so a table goes with one of them."""
        if self.finished("changes") and not exists(self.spark, f"{checkpoint}/metadata"):
            raise ValueError(f"{self.path} has batches, but the checkpoint {checkpoint} is new")


def latest(rows: DataFrame, keys=TOTAL_KEYS) -> DataFrame:
    """Of the rows of a key the one of the last batch."""
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("_last")).select(*keys, "_last.*")


def write_changes(rows: DataFrame, table: str, checkpoint: str,
                  after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Processes what is there and stops. Restarting with the same checkpoint
    continues after the last committed batch. ``after`` is called when a batch is written
    and not yet committed."""
    changes = Changes(rows.sparkSession, table)
    changes.check_checkpoint(checkpoint)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        changes.write_batch(batch, epoch)
        if after:
            after(epoch)

    return (rows.writeStream.outputMode("update").foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def compact(spark: SparkSession, table: str, keys=TOTAL_KEYS) -> None:
    """Folds the changes of a table of latest rows into one snapshot."""
    Changes(spark, table).compact(lambda rows: latest(rows, keys))


def current_rows(spark: SparkSession, table: str, keys=TOTAL_KEYS) -> DataFrame:
    """The latest state of every key."""
    return latest(Changes(spark, table).rows(), keys).drop("epoch")


def current_totals(spark: SparkSession, table: str) -> DataFrame:
    """The latest state of every window: the row of its last batch."""
    return current_rows(spark, table)


# Counts that late rows still change

_COUNT_KEYS = [*TOTAL_KEYS, "late"]


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_COUNT_KEYS).agg(
        F.sum("n_itens").alias("n_itens"), F.sum("valor").alias("valor"),
        F.max("newest").alias("newest"), F.max("epoch").alias("epoch"))


def write_counted(stream: DataFrame, moment: str, kind: str, value: str, table: str, checkpoint: str,
                  lateness: timedelta, chunk_days: int = 7, sum_scale: int | None = None) -> StreamingQuery:
    """Counts and values per calendar chunk and kind, late rows as well.

    A row is late if its chunk had ended by ``lateness`` before the newest moment of the batches
    before. Late rows are kept whole in ``late_rows`` and added to their chunk, marked as
    late. Each batch writes the sums of its own rows, so nothing is held in the stream's
    state. Rows without a moment have no chunk; they are counted under a null one.
    """
    spark = stream.sparkSession
    counts, side = Changes(spark, f"{table}/counts"), Changes(spark, f"{table}/late")
    counts.check_checkpoint(checkpoint)
    number = F.col(value).cast(f"decimal(38,{sum_scale})") if sum_scale is not None else F.col(value)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        if epoch in counts.finished("changes"):
            return
        mark = _watermark(counts, epoch, lateness)
        chunk = chunk_start(F.col(moment), chunk_days)
        over = F.date_add(chunk, chunk_days).cast("timestamp") <= F.lit(mark) if mark else F.lit(False)
        placed = batch.withColumns({"_chunk": chunk, "late": F.coalesce(over, F.lit(False))}).persist()
        try:
            side.write_batch(placed.where("late").drop("_chunk", "late"), epoch)
            counts.write_batch(placed.groupBy(
                F.col("_chunk").alias("chunk_start"), F.col(kind).alias("tipo"), "late").agg(
                F.count(F.lit(1)).alias("n_itens"), F.sum(number).alias("valor"),
                F.max(F.col(moment).cast("timestamp")).alias("newest")), epoch)
        finally:
            placed.unpersist()

    return (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _watermark(counts: Changes, epoch: int, lateness: timedelta) -> datetime | None:
    if not counts.finished("changes") and not counts.finished("base"):
        return None
    newest = counts.rows().where(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
    return newest - lateness if newest else None


def counted_totals(spark: SparkSession, table: str) -> DataFrame:
    """Count and value per chunk and kind of all rows, and how many of them were late."""
    rows = Changes(spark, f"{table}/counts").rows()
    return rows.groupBy(*TOTAL_KEYS).agg(
        F.sum("n_itens").alias("n_itens"),
        F.coalesce(F.sum("valor").cast("double"), F.lit(0.0)).alias("valor_total"),
        F.coalesce(F.sum(F.when(F.col("late"), F.col("n_itens"))), F.lit(0)).alias("n_atrasados"))


def compact_counted(spark: SparkSession, table: str) -> None:
    Changes(spark, f"{table}/counts").compact(_added)
    Changes(spark, f"{table}/late").compact(lambda rows: rows)


def late_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows that came late, with the batch (``epoch``) that brought them."""
    return Changes(spark, f"{table}/late").rows()


def land_stream(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream to a Parquet table, exactly once."""
    return (rows.writeStream.format("parquet").outputMode("append").option("path", table)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
