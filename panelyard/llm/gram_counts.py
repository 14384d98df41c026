"""Counts of hashed items over a whole corpus, given back to the texts that hold them.

Texts are dealt into batches of some megabytes by a hash of the row. A batch sends
each of its distinct items once, with its count there, to the task that owns that
range of hashes. There the counts are added up, and each batch is told which of its
items occur more than once in all texts, and how often. A batch then meets its texts
again (the exchange of the texts is used twice) and looks the counts up.

However frequent an item, a batch sends it once, and ranges of hashes are even, so no
task gets more than its share. One message between a batch and an owner is one row:
its items are sorted, so they travel as compressed differences. The answer is a bit per item and the counts of
those that occur more often. Hashes are cut to the bits that the caller needs.

A second round (``repeated_after``) may leave out what the answers of the first show to occur
once, such as an n-gram with a part that occurs once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20


def planes(values: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, compressed: small ones have empty planes."""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def from_planes(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def packed(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as their differences."""
    return planes(np.diff(values.astype("<u8"), prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.uint64)


def in_batches(documents: DataFrame, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, int, int]:
    """``documents`` (key, text) with ``text_hash`` and ``batch``; the number of batches and of bytes."""
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // batch_bytes))
    return documents.withColumns({
        "text_hash": F.xxhash64("text"), "batch": F.pmod(F.xxhash64("key", "text"), F.lit(n))}), n, total


def _bounds(n: int, bits: int) -> np.ndarray:
    return np.array([(k << bits) // n for k in range(1, n)], np.uint64)


@dataclass(frozen=True)
class Counting:
    """``n`` owners of hashes of ``bits`` bits; ``items`` hashes what a batch's texts hold."""

    n: int
    bits: int
    items: Callable[[pa.Table], np.ndarray]

    def cut(self, items: np.ndarray) -> np.ndarray:
        return items >> np.uint64(64 - self.bits)

    def parts(self, found: np.ndarray) -> list[tuple[int, int]]:
        """Where each owner's items are among sorted ones."""
        cuts = [0, *np.searchsorted(found, _bounds(self.n, self.bits)).tolist(), len(found)]
        return list(zip(cuts, cuts[1:]))

    def _messages(self, batch: int, items: np.ndarray) -> pa.Table:
        found, counts = np.unique(self.cut(items), return_counts=True)
        rows = [(k, packed(found[a:b]), planes(counts[a:b]))
                for k, (a, b) in enumerate(self.parts(found)) if a < b]
        return pa.table({
            "owner": pa.array([r[0] for r in rows], pa.int64()),
            "batch": pa.array([batch] * len(rows), pa.int64()),
            "items": pa.array([r[1] for r in rows], pa.binary()),
            "counts": pa.array([r[2] for r in rows], pa.binary())})

    def repeated(self, batches: DataFrame) -> DataFrame:
        """Answers: ``batch``, ``owner``, ``more`` (a bit per item) and ``totals`` of those."""
        def send(table: pa.Table) -> pa.Table:
            return self._messages(table.column("batch")[0].as_py(), self.items(table))

        return _added_up(batches.groupBy("batch").applyInArrow(send, _MESSAGES))

    def repeated_after(self, batches: DataFrame, answers: DataFrame,
                       items: Callable[[pa.Table, pa.Table], np.ndarray]) -> DataFrame:
        """Answers for what ``items`` makes of a batch's texts and its ``answers`` of a round before."""
        def send(table: pa.Table, known: pa.Table) -> pa.Table:
            if not table.num_rows:
                return self._messages(0, np.zeros(0, np.uint64))
            return self._messages(table.column("batch")[0].as_py(), items(table, known))

        return _added_up(batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(send, _MESSAGES))

    def totals(self, items: np.ndarray, answers: pa.Table) -> np.ndarray:
        """How often each item of a batch, in any order, occurs in all texts."""
        found, places = np.unique(self.cut(items), return_inverse=True)
        totals = np.ones(len(found), np.int64)
        parts = self.parts(found)
        for owner, more, counts in zip(*(answers.column(c).to_pylist() for c in ("owner", "more", "totals"))):
            a, b = parts[owner]
            bits = np.unpackbits(np.frombuffer(more, np.uint8), count=b - a).astype(bool)
            totals[a:b][bits] = from_planes(counts)
        return totals[places]


_MESSAGES = "owner bigint, batch bigint, items binary, counts binary"


def _added_up(sent: DataFrame) -> DataFrame:
    """What the owners answer to the messages ``sent``."""
    def add_up(table: pa.Table) -> pa.Table:
        parts = [unpacked(x.as_py()) for x in table.column("items")]
        counts = np.concatenate([from_planes(x.as_py()) for x in table.column("counts")])
        _, places = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(places, counts.astype(float))[places].astype(np.uint64)
        ends = np.cumsum([len(p) for p in parts]).tolist()
        more = [totals[a:b] for a, b in zip([0, *ends], ends)]
        return pa.table({
            "batch": table.column("batch"), "owner": table.column("owner"),
            "more": pa.array([np.packbits(t > 1).tobytes() for t in more], pa.binary()),
            "totals": pa.array([planes(t[t > 1]) for t in more], pa.binary())})

    return sent.groupBy("owner").applyInArrow(add_up, "batch bigint, owner bigint, more binary, totals binary")
