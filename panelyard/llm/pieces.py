"""SentencePiece BPE by merge rounds over flat arrays, and decoding from the vocabulary.

The symbols of many words lie behind each other in one array. In each round the rank of
every adjacent pair is looked up, the smallest rank of each word is found, and all pairs
of that rank are merged at once, the leftmost first where two overlap; then the array is
compacted and words without a pair leave it. Merging several pairs at once is what merging
one by one gives, as long as no merge makes a pair whose rank is as good. For which pairs
that may happen is known from the vocabulary; a word with several pairs to merge, such a
one among them (runs of spaces), is merged pair by pair with a priority queue instead.

Texts are cut into words wherever two characters meet that no piece holds side by side,
so no merge can go over the cut, and each distinct word of a block is merged once. Texts
of any length are worked through in blocks of characters; memory follows the block and
the ids of one text.

Models with the identity normaliser, a space put before the text, spaces as U+2581 and byte
fallback are supported; others are refused with a ValueError.

Defined results: a null or empty text gives no ids and an empty decoded text; characters
that are no piece become the pieces of their UTF-8 bytes; repeated rows and rows with
equal ids are encoded one by one; an empty table gives an empty result; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelyard.llm.frames import pick
from panelyard.llm.wordhash import mix

SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: types of pieces in the file
BPE = 2  # fixed value: the type of model
NONE = np.iinfo(np.int64).max
BLOCK_CHARS = 1 << 20
BATCH_BYTES = 16 << 20


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield tag >> 3, raw[at:at + size]
        at += size


class PairTable:
    """Values of pairs of small numbers, looked up for whole arrays at once."""

    def __init__(self, pairs: dict[tuple[int, int], int], bound: int):
        self.bound = np.uint64(bound)
        bits = max(4, int(4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(1 << bits, -1, np.int64)
        keys = np.array([a * bound + b for a, b in pairs], np.uint64)
        values = np.array(list(pairs.values()), np.int64)
        slots, self.probes = self._slot(keys), 0
        while len(keys):
            # Of the keys that want a free slot the last one gets it.
            free = self.values[slots] < 0
            self.keys[slots[free]], self.values[slots[free]] = keys[free], values[free]
            left = self.keys[slots] != keys
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & (len(self.keys) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        keys = left.astype(np.uint64) * self.bound + right.astype(np.uint64)
        slots = self._slot(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], -1)
        open_ = np.flatnonzero((there != keys) & (self.values[slots] >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            found, own = self.keys[slots[open_]], keys[open_]
            values = self.values[slots[open_]]
            out[open_] = np.where(found == own, values, -1)
            open_ = open_[(found != own) & (values >= 0)]
        return out


class PieceModel:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        parts = [dict(_fields(value)) for number, value in fields if number == 1]
        self.texts = [p.get(1, b"").decode() for p in parts]
        self.kinds = [p.get(3, NORMAL) for p in parts]
        scores = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in parts]
        self._check(dict(_fields(b"".join(v for n, v in fields if n == 2))),
                    dict(_fields(b"".join(v for n, v in fields if n == 3))))
        n = len(parts)
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}
        # Equal scores are equal ranks, the best score is rank 0.
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.ranks = np.array([order.get(s, 0) for s in scores], np.int64)
        self.bound = n + 0x110000  # characters without a piece are numbered from n on
        self.of_char = np.arange(n, self.bound, dtype=np.int64)
        for text, i in self.ids.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        merges, beside = {}, {}
        for text, i in self.ids.items():
            for k in range(1, len(text)):
                left, right = self.ids.get(text[:k]), self.ids.get(text[k:])
                beside[text[k - 1:k + 1]] = 1
                if left is not None and right is not None:
                    merges[left, right] = i
        self.merges, self.beside = merges, beside
        hasty = self._hasty()
        self.pairs = PairTable({p: 2 * new + (p in hasty) for p, new in merges.items()}, self.bound)
        self.neighbours = PairTable({(int(self.of_char[ord(a)]), int(self.of_char[ord(b)])): 1
                                     for a, b in beside}, self.bound)
        self.byte_ids = np.array([self.texts.index(f"<0x{b:02X}>") for b in range(256)], np.int64)
        shown = [self._shown(i) for i in range(n)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_at = np.concatenate([[0], np.cumsum([len(s) for s in shown])])
        self.opens = np.array([k == NORMAL and t.startswith(SPACE)
                               for t, k in zip(self.texts, self.kinds)])

    def _hasty(self) -> set[tuple[int, int]]:
        """Pairs after whose merge a pair of a rank as good may be there.

        That is a pair (a, b) that makes p, where p and a neighbour x make a piece as good
        as p, while b and x (or x and a) would not have been merged before.
        """
        found, rank = set(), self.ranks
        for text, i in self.ids.items():
            for k in range(1, len(text)):
                for end in range(k + 1, len(text)):
                    a, b, c = (self.ids.get(t) for t in (text[:k], text[k:end], text[end:]))
                    if a is None or b is None or c is None:
                        continue
                    first, last = self.merges.get((a, b)), self.merges.get((b, c))
                    if first is not None and rank[i] <= rank[first] and (
                            last is None or rank[last] >= rank[first]):
                        found.add((a, b))
                    if last is not None and rank[i] <= rank[last] and (
                            first is None or rank[first] > rank[last]):
                        found.add((b, c))
        return found

    def _check(self, trainer: dict, normaliser: dict) -> None:
        # The fields of the file, and what they are where they are not given.
        plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) \
            and normaliser.get(5, 1)
        whole = trainer.get(3) == BPE and trainer.get(35, 0) and not trainer.get(24, 0)
        if not plain or not whole or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a kind of SentencePiece model that is supported")

    def _shown(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.texts[i][3:5], 16)])
        if self.kinds[i] == NORMAL:
            return self.texts[i].replace(SPACE, " ").encode()
        return UNKNOWN_TEXT.encode() if self.kinds[i] == UNKNOWN else b""

    # Encoding

    def parts(self, text: str) -> Iterator[str]:
        """The text as the model sees it, in parts that no merge goes over."""
        if not text:
            return
        text = SPACE + text.replace(" ", SPACE)
        start = 0
        while len(text) - start > BLOCK_CHARS:
            cut = start + BLOCK_CHARS
            while cut > start and text[cut - 1:cut + 1] in self.beside:
                cut -= 1
            if cut == start:  # no cut in the whole block: go on behind it
                cut = start + BLOCK_CHARS
                while cut < len(text) and text[cut - 1:cut + 1] in self.beside:
                    cut += 1
            yield text[start:cut]
            start = cut
        if start < len(text):
            yield text[start:]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        owners, parts, held, done = [], [], 0, []

        def flush() -> None:
            nonlocal held
            for owner, ids in zip(owners, self._encode_parts(parts)):
                done[owner - base].append(ids)
            owners.clear()
            parts.clear()
            held = 0

        base = 0
        for number, text in enumerate(texts):
            done.append([])
            for part in self.parts(text):
                owners.append(number)
                parts.append(part)
                held += len(part)
                if held >= BLOCK_CHARS:
                    flush()
                    yield from map(_joined, done[:-1])  # the last text may have more parts
                    base, done = base + len(done) - 1, done[-1:]
        flush()
        yield from map(_joined, done)

    def _encode_parts(self, parts: list[str]) -> list[np.ndarray]:
        if not parts:
            return []
        sizes = np.array([len(p) for p in parts])
        symbols = self.of_char[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        cut = np.ones(len(symbols), bool)
        cut[1:] = self.neighbours.of(symbols[:-1], symbols[1:]) < 0
        cut[np.cumsum(sizes)[:-1]] = True
        starts = np.flatnonzero(cut)
        word_of, first = _distinct(symbols, starts)
        ends = np.append(starts[1:], len(symbols))
        ids, counts = self._merged(*_ragged(symbols, starts[first], ends[first] - starts[first]))
        ids, counts = self._with_bytes(ids, counts)
        offsets = np.cumsum(counts) - counts
        out, _ = _ragged(ids, offsets[word_of], counts[word_of])
        words_before = np.searchsorted(starts, np.cumsum(sizes))
        return np.split(out, np.cumsum(counts[word_of])[words_before - 1][:-1])

    def _merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words when no pair is left, and their number by word."""
        n_words = int(word[-1]) + 1
        found, owner = [], []
        pair = np.full(len(symbols), -1, np.int64)
        todo = np.flatnonzero(word[:-1] == word[1:])
        while True:
            pair[todo] = self.pairs.of(symbols[todo], symbols[todo + 1])
            rank = np.where(pair >= 0, self.ranks[pair >> 1], NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            ready = np.repeat(best == NONE, sizes)
            wanted = (rank == np.repeat(best, sizes)) & ~ready
            place = np.arange(len(symbols))
            run = np.maximum.accumulate(np.where(wanted & ~np.append(False, wanted[:-1]), place, 0))
            taken = wanted & ((place - run) % 2 == 0)
            queued = np.repeat((np.add.reduceat(taken, starts, dtype=np.int64) > 1)
                               & np.logical_or.reduceat(wanted & (pair & 1 > 0), starts), sizes)
            for word_symbols, number in _groups(symbols, word, queued):
                merged = self._queued(word_symbols)
                found.append(np.array(merged, np.int64))
                owner.append(np.full(len(merged), number))
            found.append(symbols[ready])
            owner.append(word[ready])
            stay = ~ready & ~queued
            symbols, word, pair = symbols[stay], word[stay], pair[stay]
            taken = np.flatnonzero(taken[stay])
            if not len(symbols):
                break
            symbols[taken] = pair[taken] >> 1
            keep = np.ones(len(symbols), bool)
            keep[taken + 1] = False
            moved = taken - np.arange(len(taken))  # places after compaction
            symbols, word, pair = symbols[keep], word[keep], pair[keep]
            todo = np.unique(np.concatenate([moved, np.maximum(moved - 1, 0)]))
            pair[todo] = -1
            todo = todo[todo < len(word) - 1]
            todo = todo[word[todo] == word[todo + 1]]
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(found)[order], np.bincount(owner, minlength=n_words)

    def _queued(self, symbols: np.ndarray) -> list[int]:
        """One word pair by pair: best rank first, then leftmost."""
        ids: list[int] = symbols.tolist()
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), len(ids)]
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(ids)
            new = self.merges.get((ids[i], ids[j])) if j < len(ids) else None
            if new is not None:
                heapq.heappush(queue, (int(self.ranks[new]), i, ids[i], ids[j], new))

        for i in range(len(ids) - 1):
            offer(i)
        while queue:
            _, i, left, right, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # stale
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [x for x in ids if x >= 0]

    def _with_bytes(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        odd = ids >= len(self.texts)
        if not odd.any():
            return ids, counts
        strange = np.where(odd, ids - len(self.texts), 0)
        size = np.where(odd, 1 + (strange >= 0x80) + (strange >= 0x800) + (strange >= 0x10000), 1)
        word = np.repeat(np.arange(len(counts)), counts)
        out = np.repeat(ids, size)
        raw = "".join(map(chr, strange[odd].tolist())).encode()
        out[np.repeat(odd, size)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        return out, np.bincount(word, weights=size, minlength=len(counts)).astype(np.int64)

    # Decoding

    def decode(self, ids: np.ndarray) -> str:
        """The strings of the pieces put together; the space before the text goes."""
        if not len(ids):
            return ""
        raw, _ = _ragged(self.shown, self.shown_at[ids], self.shown_at[ids + 1] - self.shown_at[ids])
        raw = raw[1:] if self.opens[ids[0]] else raw
        try:
            return raw.tobytes().decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: np.ndarray) -> str:
        """Every byte of a run of byte pieces that is in no character becomes U+FFFD."""
        out, run = [], b""

        def flush() -> None:
            nonlocal run
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                run = run[size:]

        for place, i in enumerate(ids.tolist()):
            own = self._shown(i)
            if self.kinds[i] == BYTE:
                run += own
            else:
                flush()
                out.append(own.decode()[1 if place == 0 and self.opens[i] else 0:])
        flush()
        return "".join(out)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)


def _ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``values`` behind each other, and the number of each value's stretch."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return values[np.arange(len(owner)) + (starts - before)[owner]], owner


def _groups(symbols: np.ndarray, word: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    symbols, word = symbols[chosen], word[chosen]
    if len(word):
        for part in np.split(np.arange(len(word)), np.flatnonzero(word[1:] != word[:-1]) + 1):
            yield symbols[part], int(word[part[0]])


def _distinct(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its distinct word, and the first word of each.

    Words are compared symbol by symbol with the word that has the same hash; one that
    differs stays a distinct word of its own.
    """
    sizes = np.diff(np.append(starts, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(starts, sizes)
    hashes = np.add.reduceat(mix(symbols.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
                                 + place.astype(np.uint64)), starts)
    _, first, word_of = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[word_of]
    at = np.minimum(np.repeat(starts[like], sizes) + place, len(symbols) - 1)
    other = np.logical_or.reduceat(symbols[at] != symbols, starts) | (sizes != sizes[like])
    if other.any():
        word_of = word_of.copy()
        word_of[other] = np.arange(len(first), len(first) + int(other.sum()))
        first = np.concatenate([first, np.flatnonzero(other)])
    return word_of, first


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(documents: DataFrame, path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """The id, ``ids`` (numbers of pieces), ``n_tokens`` and ``decoded``; nothing is shuffled."""
    rows = pick(documents, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            start, held, found = 0, 0, []
            for ids in pieces.encode(t.as_py() or "" for t in batch.column(1)):
                found.append((ids, pieces.decode(ids)))
                held += 4 * len(ids) + len(found[-1][1])
                if held >= BATCH_BYTES:
                    yield _batch(batch.column(0).slice(start, len(found)), found)
                    start, held, found = start + len(found), 0, []
            if found:
                yield _batch(batch.column(0).slice(start, len(found)), found)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, n_tokens bigint, decoded string")


def _batch(keys: pa.Array, found: list[tuple[np.ndarray, str]]) -> pa.RecordBatch:
    sizes = np.array([len(ids) for ids, _ in found])
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([i for i, _ in found]), pa.int32()))
    return pa.record_batch([keys, ids, pa.array(sizes, pa.int64()),
                            pa.array([d for _, d in found], pa.string())],
                           names=["id", "ids", "n_tokens", "decoded"])
