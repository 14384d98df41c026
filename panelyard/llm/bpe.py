"""BPE encoding and decoding from a vocabulary and merge ranks.

A word starts as a doubly linked list of byte symbols. A priority queue holds the
merges that are possible, lowest rank first, the leftmost first among equals; an
entry whose symbols have changed meanwhile is stale and skipped. A word of n bytes
takes O(n log n), however long it is. Decoding puts the vocabulary strings of the
ids together.

The tokenizer file gives vocabulary, merges, special tokens, word-end mark and the
kind of text treatment. Two kinds are supported: byte-level words with their leading
space, and lower-cased words with an end mark.

Defined results: a null text counts as empty and gives no ids and an empty decoded
text; repeated rows are encoded one by one; an empty table gives an empty result;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelyard.llm.frames import pick
from panelyard.llm.units import KEPT_CHARS, Units
from panelyard.llm.words import BYTE_OF, TextTreatment


KNOWN_WORDS = 500_000


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        self.vocabulary: dict[str, int] = dict(model["vocab"])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges[self.vocabulary[a], self.vocabulary[b]] = rank, self.vocabulary[a + b]
        self.end_mark = model["end_of_word_suffix"] or ""
        self.treatment = TextTreatment.of(path)
        if self.treatment is None:
            raise ValueError(f"{path}: neither kind of tokenizer that is supported")
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.strings = {i: s for s, i in self.vocabulary.items()} | {
            i: s for s, i in self.special.items()}
        self.joins_bytes = config["decoder"] is not None
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        self.known: dict[str, list[int]] = {}

    def merged(self, word: str) -> list[int]:
        """The ids of one word."""
        letters = list(self.treatment.letters(word))
        letters[-1] += self.end_mark
        ids = [self.vocabulary[c] for c in letters if c in self.vocabulary]
        before = list(range(-1, len(ids) - 1))
        after = [*range(1, len(ids)), -1]
        alive = [True] * len(ids)
        merges = self.merges
        queue = []

        def offer(i: int, j: int) -> None:
            found = merges.get((ids[i], ids[j]))
            if found:
                heapq.heappush(queue, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(len(ids) - 1):
            offer(i, i + 1)
        while queue:
            _, i, left, right, new = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale
            ids[i], alive[j] = new, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x, there in zip(ids, alive) if there]

    def word_ids(self, word: str) -> list[int]:
        """``merged``, remembered for short words."""
        ids = self.known.get(word)
        if ids is None:
            ids = self.merged(word)
            if len(word) <= KEPT_CHARS:
                if len(self.known) >= KNOWN_WORDS:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                out.append(self.special[part])
            else:
                for word in self.treatment.words(part):
                    out += self.word_ids(word)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Vocabulary strings put together.

        Byte-level strings become the bytes that they stand for. Without a decoder in
        the file the strings stay as they are, with a space between them.
        """
        strings = [self.strings[i] for i in ids]
        if not self.joins_bytes:
            return " ".join(strings)
        raw = b"".join(bytes(BYTE_OF[c] for c in s) if s not in self.special else s.encode()
                       for s in strings)
        return raw.decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def _units(path: str) -> tuple[Bpe, Units[tuple[bytes, str]]]:
    bpe = Bpe(path)

    def unit(piece: str) -> tuple[bytes, str]:
        ids = bpe.encode(piece)
        return array("I", ids).tobytes(), "" if bpe.joins_bytes else bpe.decode(ids)

    return bpe, Units(unit, limit=500_000)


def encode_and_decode(path: str, texts: pa.Array) -> Iterator[tuple[bytes, str]]:
    """Ids as little-endian 32-bit numbers, and the text decoded from them."""
    bpe, units = _units(path)
    for found in units.of_column(texts):
        ids = b"".join([i for i, _ in found])
        if bpe.joins_bytes:  # a character's bytes may be in two tokens, so not by piece
            yield ids, bpe.decode(np.frombuffer(ids, "<u4").tolist())
        else:
            yield ids, " ".join([s for _, s in found if s])


BATCH_BYTES = 16 << 20


def encoded(documents: DataFrame, path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """The id, ``ids`` (little-endian unsigned 32-bit), ``n_tokens`` and ``decoded``."""
    rows = pick(documents, id_col, text_col)
    schema = pa.schema([pa.field("id", pa.null()), pa.field("ids", pa.binary()),
                        pa.field("n_tokens", pa.int64()), pa.field("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            own = schema.set(0, pa.field(id_col, keys.type))
            start, held, out = 0, 0, []
            for both in encode_and_decode(path, batch.column(1)):
                out.append(both)
                held += len(both[0]) + len(both[1])
                if held >= BATCH_BYTES:
                    yield _batch(own, keys.slice(start, len(out)), out)
                    start, held, out = start + len(out), 0, []
            if out:
                yield _batch(own, keys.slice(start, len(out)), out)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary, n_tokens bigint, decoded string")


def _batch(schema: pa.Schema, keys: pa.Array, out: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch([keys, pa.array([i for i, _ in out], pa.binary()),
                            pa.array([len(i) // 4 for i, _ in out], pa.int64()),
                            pa.array([s for _, s in out], pa.string())], schema=schema)
