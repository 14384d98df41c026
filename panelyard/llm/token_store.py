"""A store of token ids with Elias-Fano encoded document boundaries.

Documents are put in ascending id order over range partitions and encoded with the
tokenizers library. A partition becomes a shard of blocks. A block is one row of a
Parquet table and holds

- ``tokens``: the ids of its documents one after the other, little-endian, 16 bits
  each where the vocabulary allows, else 32,
- ``ends_*``: where each document ends in ``tokens``, and ``keys_*``: the document
  ids less the first, both rising sequences in Elias-Fano form: the low bits packed,
  the high bits as a unary bit vector with the place of every 256th one. ``select``
  finds one document's offset in it without a table of 64-bit offsets.

A document is in one block. ``start`` of a document, the ids of all documents before
it, comes from sums of blocks in two steps: a window within each shard and one over
the shards (one row each).

Defined results: a null text counts as empty and has only the end id; documents with a
null id come first (``n_null_keys`` of a block counts them); equal ids stay apart as
rows, ordered by a hash of the text and then the text; an empty table makes an empty
store. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelyard.llm.frames import pick
from panelyard.llm.units import library_ids

SAMPLE = 256
ROW_GROUP_BYTES = 16 << 20
BLOCK_TOKENS = 1 << 18


class EliasFano:
    """A rising sequence of unsigned numbers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(low.ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u4").tobytes())

    def all(self) -> np.ndarray:
        if self.n == 0:
            return np.zeros(0, np.uint64)
        high = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        values = (high[:self.n] - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little",
                                 count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            values |= bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return values

    def select(self, i: int) -> int:
        """The i-th number, from one sample on through fewer than 256 ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(np.frombuffer(self.samples, "<u4", 1, i // SAMPLE * 4)[0])
        left = i % SAMPLE
        byte = place // 8
        bits = self.high[byte] >> place % 8 << place % 8
        while bits.bit_count() <= left:
            left -= bits.bit_count()
            byte += 1
            bits = self.high[byte]
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        return (one - i) << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        window = int.from_bytes(self.low[first // 8:(last + 7) // 8], "little")
        return window >> first % 8 & (1 << self.low_bits) - 1


_PARTS = [("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
          ("samples", pa.binary())]
_BLOCK = pa.schema([
    ("shard", pa.int64()), ("block", pa.int64()), ("n_docs", pa.int64()),
    ("n_null_keys", pa.int64()), ("n_tokens", pa.int64()), ("first_key", pa.int64()),
    ("token_bytes", pa.int32()), ("tokens", pa.binary()),
    *[(f"{kind}_{name}", t) for kind in ("ends", "keys") for name, t in _PARTS]])
_BLOCK_DDL = ("shard bigint, block bigint, n_docs bigint, n_null_keys bigint, n_tokens bigint, "
              "first_key bigint, token_bytes int, tokens binary, " + ", ".join(
                  f"{k}_low_bits int, {k}_low binary, {k}_high binary, {k}_samples binary"
                  for k in ("ends", "keys")))


def _parts(kind: str, coded: EliasFano) -> dict:
    return {f"{kind}_{name}": getattr(coded, name) for name, _ in _PARTS}


def _block(shard: int, number: int, keys: list, ids: list[bytes], width: int) -> pa.RecordBatch:
    tokens = np.frombuffer(b"".join(ids), "<u4")
    ends = np.cumsum([len(i) // 4 for i in ids])
    known = [k for k in keys if k is not None]
    first = known[0] if known else 0
    # The distance of any two 64-bit ids fits into an unsigned number.
    rising = np.array([k - first for k in known], np.uint64)
    row = {"shard": shard, "block": number, "n_docs": len(ids),
           "n_null_keys": len(keys) - len(known), "n_tokens": len(tokens), "first_key": first,
           "token_bytes": width, "tokens": tokens.astype(f"<u{width}").tobytes(),
           **_parts("ends", EliasFano.of(ends)), **_parts("keys", EliasFano.of(rising))}
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK)


def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
          block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the store of all documents to a folder that all executors share."""
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()
    rows = pick(documents, id_col, text_col)
    rows = rows.select(F.col(id_col).cast("long").alias("key"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    # The hash parts a range in which one id, or none, holds many rows.
    order = ["key", F.xxhash64("text"), "text"]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        keys: list = []
        ids: list[bytes] = []
        held = 0
        for batch in batches:
            encoded = library_ids(tokenizer, batch.column(1))
            for key, own in zip(batch.column(0), encoded):
                keys.append(key.as_py())
                ids.append(own + end)
                held += len(ids[-1]) // 4
                if held >= block_tokens:
                    yield _block(shard, number, keys, ids, width)
                    keys, ids, held, number = [], [], 0, number + 1
        if ids:
            yield _block(shard, number, keys, ids, width)

    rows.mapInArrow(blocks, _BLOCK_DDL).write.option("compression", "zstd") \
        .option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``shard``, ``block`` and the ids of all blocks before."""
    sizes = spark.read.schema(_BLOCK_DDL).parquet(folder).select("shard", "block", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before.orderBy("shard")), F.lit(0)).alias("base"))
    within = F.sum("n_tokens").over(before.partitionBy("shard").orderBy("block"))
    return sizes.withColumn("within", F.coalesce(within, F.lit(0))).join(shards, "shard").select(
        "shard", "block", (F.col("base") + F.col("within")).alias("before"))


def boundaries(row: dict) -> tuple[EliasFano, EliasFano]:
    """The coded document ends and ids of a block row."""
    def of(kind: str, n: int) -> EliasFano:
        return EliasFano(n, *[row[f"{kind}_{name}"] for name, _ in _PARTS])

    return of("ends", row["n_docs"]), of("keys", row["n_docs"] - row["n_null_keys"])


OUT_BYTES = 16 << 20


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a store: doc_id, n_tokens and ids (32-bit little-endian).

    ``place`` is where a document starts in its block, which ``shard`` and ``block``
    name; ``with_starts`` turns these into ``start``.
    """
    schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()),
                        ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                ends, keys = (x.all() for x in boundaries(row))
                keys = [None] * row["n_null_keys"] + [row["first_key"] + k for k in keys.tolist()]
                tokens = np.frombuffer(row["tokens"], f"<u{row['token_bytes']}")
                starts = [0, *ends.tolist()]
                step = max(1, OUT_BYTES * len(keys) // (4 * len(tokens)))
                for a in range(0, len(keys), step):
                    part = range(a, min(a + step, len(keys)))
                    yield pa.record_batch([
                        pa.array([row["shard"]] * len(part), pa.int64()),
                        pa.array([row["block"]] * len(part), pa.int64()),
                        pa.array([keys[j] for j in part], pa.int64()),
                        pa.array([starts[j] for j in part], pa.int64()),
                        pa.array([starts[j + 1] - starts[j] for j in part], pa.int64()),
                        pa.array([tokens[starts[j]:starts[j + 1]].astype("<u4").tobytes()
                                  for j in part], pa.binary())], schema=schema)

    return spark.read.schema(_BLOCK_DDL).parquet(folder).mapInArrow(
        documents, "shard bigint, block bigint, doc_id bigint, place bigint, n_tokens bigint, ids binary")


def with_starts(spark: SparkSession, folder: str, found: DataFrame) -> DataFrame:
    """``start`` in place of shard, block and place.

    Drop or digest ``ids`` before this where they are not needed: the rows may be
    shuffled to meet their block's start.
    """
    return found.join(block_starts(spark, folder), ["shard", "block"]) \
        .withColumn("start", F.col("before") + F.col("place")) \
        .drop("shard", "block", "place", "before")
