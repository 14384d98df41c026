"""Vector bin packing of tokenised examples into training sequences.

A sequence has room for so many tokens, segments and loss-bearing tokens. The dot-product
heuristic fills one sequence at a time: of the examples that fit, it takes the one
whose demands, as shares of the limits, have the largest dot product with what is
left, so a sequence rich in one resource gets examples that need that one. Examples
with equal demands form one class, so a choice looks at classes. When nothing fits
whole, a cut example fills the rest. Full-length parts of long examples become
sequences of their own first.

Each input partition packs its examples in blocks as they arrive, without a shuffle;
what the last sequence of a block holds goes into the next block. The tail of a
partition, or a sequence that ran into another limit than tokens, is cut into
sequences of powers of two, which need no padding.

A segment is a piece of one example; an example's tokens before ``loss_from`` (its
prompt) bear no loss. Every id is in exactly one piece.

Defined results: a null text (or prompt) counts as empty, and its example is the end id
alone; repeated rows are packed one by one; null ids stay null; an empty table gives
no pieces. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.llm.frames import pick
from panelyard.llm.units import library_ids


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 4096
    segments: int = 1024
    loss_tokens: int = 4096


@dataclass(frozen=True)
class Piece:
    """Tokens ``start`` to ``stop`` of an example."""

    example: int
    start: int
    stop: int
    loss_from: int

    @property
    def tokens(self) -> int:
        return self.stop - self.start

    @property
    def loss(self) -> int:
        return max(0, self.stop - max(self.start, self.loss_from))

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        at = self.start + tokens
        return (Piece(self.example, self.start, at, self.loss_from),
                Piece(self.example, at, self.stop, self.loss_from))

    def longest(self, tokens: int, loss: int) -> int:
        """Tokens from its start that fit into so much room."""
        free = max(0, self.loss_from - self.start)
        return min(self.tokens, tokens, free + loss)


def pack(pieces: list[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """Sequences of pieces; the last one may have room left."""
    classes: dict[tuple[int, int], list[Piece]] = defaultdict(list)
    for piece in pieces:
        # A full sequence of one example first, as long as it fills one.
        while (n := piece.longest(limits.tokens, limits.loss_tokens)) < piece.tokens \
                or n == limits.tokens:
            full, piece = piece.cut(n)
            yield [full]
            if not piece.tokens:
                break
        if piece.tokens:
            classes[piece.tokens, piece.loss].append(piece)
    bounds = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
    keys: list[tuple[int, int]] = list(classes)
    demand = np.array([(t, 1, x) for t, x in keys], float).reshape(-1, 3)
    alive = np.ones(len(keys), bool)

    def drop(k: int) -> Piece:
        piece = classes[keys[k]].pop()
        alive[k] = bool(classes[keys[k]])
        return piece

    def put_back(piece: Piece) -> None:
        nonlocal demand, alive
        key = (piece.tokens, piece.loss)
        if key not in classes:
            keys.append(key)
            demand = np.vstack([demand, [(key[0], 1, key[1])]])
            alive = np.append(alive, False)
            places[key] = len(keys) - 1
        classes[key].append(piece)
        alive[places[key]] = True

    places = {key: k for k, key in enumerate(keys)}
    while alive.any():
        chosen: list[Piece] = []
        left = bounds.copy()
        while (left[:2] > 0).all() and alive.any():
            fits = alive & (demand <= left).all(axis=1)
            if fits.any():
                worth = np.where(fits, (demand / bounds) @ (left / bounds), -1.0)
                piece = drop(int(worth.argmax()))
            else:
                # Nothing fits whole: of the pieces that have a part that does, the longest.
                k = int(np.where(alive, demand[:, 0], -1.0).argmax())
                n = classes[keys[k]][-1].longest(int(left[0]), int(left[2]))
                if n == 0:
                    starts = [c for c in np.flatnonzero(alive) if keys[c][1] < keys[c][0]]
                    if not starts:
                        break
                    k = starts[0]
                    n = classes[keys[k]][-1].longest(int(left[0]), int(left[2]))
                    if n == 0:
                        break
                piece, rest = drop(k).cut(n)
                if rest.tokens:
                    put_back(rest)
            chosen.append(piece)
            left -= (piece.tokens, 1, piece.loss)
        yield chosen


def powers_of_two(sequence: list[Piece]) -> Iterator[list[Piece]]:
    """The same pieces in sequences whose lengths are powers of two, longest first."""
    left = sum(p.tokens for p in sequence)
    queue = list(reversed(sequence))
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        out = []
        while room:
            piece = queue.pop()
            if piece.tokens > room:
                piece, rest = piece.cut(room)
                queue.append(rest)
            out.append(piece)
            room -= piece.tokens
        yield out


SCHEMA = pa.schema([
    ("place", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("loss_tokens", pa.int64()),
    ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("padded_to", pa.int64())])
BLOCK_TOKENS, BLOCK_EXAMPLES = 1 << 21, 1 << 14
OUT_BYTES = 8 << 20


class _Packer:
    """Packs the examples of one partition, block by block."""

    def __init__(self, limits: Limits, partition: int):
        self.limits, self.partition = limits, partition
        self.sequences = 0
        self.examples: list[tuple[object, bytes]] = []
        self.waiting: list[Piece] = []
        self.held = 0

    def add(self, key, ids: bytes, loss_from: int) -> None:
        self.waiting.append(Piece(len(self.examples), 0, len(ids) // 4, loss_from))
        self.examples.append((key, ids))
        self.held += len(ids) // 4

    @property
    def full(self) -> bool:
        return self.held >= BLOCK_TOKENS or len(self.waiting) >= BLOCK_EXAMPLES

    def sequences_of_block(self, last: bool) -> Iterator[list[Piece]]:
        found = pack(self.waiting, self.limits)
        ahead = next(found, None)
        self.waiting = []
        while ahead is not None:
            sequence, ahead = ahead, next(found, None)
            total = sum(p.tokens for p in sequence)
            if total == self.limits.tokens:
                yield sequence
            elif ahead is None and not last and len(sequence) < BLOCK_EXAMPLES // 2:
                self.waiting = sequence
            else:
                yield from powers_of_two(sequence)

    def flush(self, last: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for sequence in self.sequences_of_block(last):
            number = self.partition << 40 | self.sequences
            self.sequences += 1
            total = sum(p.tokens for p in sequence)
            padded = total if total & total - 1 == 0 else self.limits.tokens
            offset = 0
            for p in sequence:
                key, ids = self.examples[p.example]
                rows.append((key, p.start, p.tokens, p.loss, ids[4 * p.start:4 * p.stop],
                             len(ids) // 4, number, offset, padded))
                offset += p.tokens
                size += 4 * p.tokens
            if size >= OUT_BYTES:
                yield _rows(rows, id_type)
                rows, size = [], 0
        if rows:
            yield _rows(rows, id_type)
        # What waits for the next block keeps its examples, numbered anew.
        order = list(dict.fromkeys(p.example for p in self.waiting))
        kept = {e: i for i, e in enumerate(order)}
        self.examples = [self.examples[e] for e in order]
        self.waiting = [Piece(kept[p.example], p.start, p.stop, p.loss_from) for p in self.waiting]
        self.held = sum(p.tokens for p in self.waiting)


def _rows(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.record_batch([pa.array(columns[0], id_type),
                            *[pa.array(c, f.type) for c, f in zip(columns[1:], list(SCHEMA)[1:])]],
                           names=SCHEMA.names)


def packed(documents: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(),
           id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None) -> DataFrame:
    """The pieces of all sequences, one row each.

    Returns the id, ``start``, ``length``, ``loss_tokens`` and ``ids`` (32-bit little-endian)
    of the piece, ``doc_tokens`` of the whole example, its ``sequence_id`` and
    ``offset`` there, and the length ``padded_to`` of the sequence.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1 or limits.tokens & limits.tokens - 1:
        raise ValueError(f"limits must be positive, tokens a power of two: {limits}")
    rows = pick(documents, id_col, text_col, *([prompt_col] if prompt_col else []))
    rows = rows.toDF("key", "text", *(["prompt"] if prompt_col else []))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, kind = _Packer(limits, TaskContext.get().partitionId()), pa.null()
        for batch in batches:
            kind = batch.column(0).type
            encoded = [library_ids(tokenizer, column) for column in batch.columns[1:]]
            prompts = encoded[1] if prompt_col else repeat(b"")
            for key, after, before in zip(batch.column(0), encoded[0], prompts):
                packer.add(key.as_py(), before + after + end, len(before) // 4)
                if packer.full:
                    yield from packer.flush(False, kind)
        yield from packer.flush(True, kind)

    key_type = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(run, f"place {key_type}, start bigint, length bigint, loss_tokens bigint, "
                                 "ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, "
                                 "padded_to bigint")
    return found.select(F.col("place").alias(id_col), *SCHEMA.names[1:])
