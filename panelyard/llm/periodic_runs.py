"""Periodic runs of words, found over a harmonic grid with difference-cover LCE.

A run is a stretch of words with smallest period q, at least ``max(min_length, 2 q)`` words
long, that cannot be made longer. For each period p every run of that period covers a grid
point i together with i + p, so two longest common extensions from there, one to each side,
give its ends. The grids of all periods have about n ln n points; only those with equal words
at i and i + p are looked at further.

Extensions come from a structure over few suffixes. Positions whose number modulo V is in
a difference cover are sorted by their suffixes (first by V words, then doubling from
sample to sample), neighbours get their longest common prefix, and a sparse table holds
range minima of those. For any two positions some distance below V leads to a sample from
both: the words up to there are compared one by one, then the table gives the rest. Texts
none of whose candidates gets that far never need a table. All of this runs over flat arrays of
many texts behind each other.

A document is worked on where it is read; nothing is shuffled. Memory follows a block of
words and the words of one text (about 150 bytes for each), grid points come in slices.

Defined results: a null, empty or wordless text has no runs and an empty collapsed text;
repeated rows are worked on one by one; an empty table gives an empty result; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelyard.llm.frames import pick

# Every distance modulo 21 is a difference of two of these.
V = 21
COVER = np.array([0, 1, 4, 14, 16])
BLOCK_WORDS = 1 << 18
POINTS = 1 << 20


def _shifts() -> np.ndarray:
    """For two places modulo V, the least distance after which both are samples."""
    out = np.full((V, V), V, np.int64)
    for shift in range(V - 1, -1, -1):
        at = (COVER - shift) % V
        out[np.ix_(at, at)] = shift
    return out


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions to the right in one array of words.

    ``words`` are positive numbers, texts are ``starts`` to the next start, and a 0 stands
    behind each text. Both places of a question lie in one text, so the 0 behind it ends
    the later one.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self.size = len(words)
        self.words = np.concatenate([words, np.zeros(2 * V, words.dtype)])
        self.starts = starts
        self.table: list[np.ndarray] | None = None

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of equal words from ``left`` and ``right`` (larger) on."""
        out = np.zeros(len(left), np.int64)
        shift = SHIFTS[left % V, right % V]
        open_ = np.arange(len(left))
        for k in range(V):
            at_sample = open_[shift[open_] == k]
            if len(at_sample):
                out[at_sample] = k + self._from_samples(left[at_sample] + k, right[at_sample] + k)
                open_ = open_[shift[open_] > k]
            if not len(open_):
                break
            same = (self.words[left[open_] + k] == self.words[right[open_] + k]) \
                & (self.words[right[open_] + k] > 0)
            out[open_[~same]] = k
            open_ = open_[same]
        return out

    def _from_samples(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), np.int64)
        # A question whose first words differ needs no table.
        same = np.flatnonzero((self.words[left] == self.words[right]) & (self.words[right] > 0))
        if len(same):
            if self.table is None:
                self._build()
            a, b = self.place[self.number[left[same]]], self.place[self.number[right[same]]]
            low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
            level = np.frexp((high - low).astype(float))[1] - 1
            width = 1 << level
            out[same] = np.minimum(self.table[level, low], self.table[level, high - width])
        return out

    def _build(self) -> None:
        """Sorted samples, the common prefixes of neighbours, and their sparse table."""
        samples = np.flatnonzero(np.isin(np.arange(self.size) % V, COVER))
        samples = samples[self.words[samples] > 0]
        n = len(samples)
        self.number = np.full(self.size + V, -1, np.int64)
        self.number[samples] = np.arange(n)
        text = np.searchsorted(self.starts, samples, side="right")
        # Rank by the first V words, within a text, in keys of as many words as fit.
        bits = max(1, int(self.words.max()).bit_length())
        per_key = max(1, 63 // bits)
        ended = np.zeros(n, bool)  # a word behind the end of the text counts as 0
        keys = [text.astype(np.int64)]
        for first in range(0, V, per_key):
            key = np.zeros(n, np.int64)
            for k in range(first, min(first + per_key, V)):
                word = self.words[samples + k]
                ended |= word == 0
                key = (key << bits) | np.where(ended, 0, word)
            keys.append(key)
        rank = _ranks(keys)
        levels = [(V, rank)]
        step = V
        bounds = np.append(self.starts, self.size)[text]
        while rank.max() + 1 < n:  # suffixes of one text differ in length, so this ends
            nxt = samples + step
            there = nxt < bounds
            follow = np.where(there, self.number[np.minimum(nxt, self.size)], -1)
            rank = _ranks([rank, np.where(follow >= 0, rank[follow] + 1, 0)])
            step *= 2
            levels.append((step, rank))
        order = np.argsort(rank, kind="stable")
        self.place = np.empty(n, np.int64)
        self.place[order] = np.arange(n)
        a, b = samples[order[:-1]], samples[order[1:]]
        common = np.zeros(n, np.int64)
        at = np.zeros(max(n - 1, 0), np.int64)
        inside = text[order[:-1]] == text[order[1:]]
        for width, own in reversed(levels):
            x, y = self.number[np.minimum(a + at, self.size)], self.number[np.minimum(b + at, self.size)]
            same = inside & (x >= 0) & (y >= 0) & (own[x] == own[y])
            at = np.where(same, at + width, at)
        for _ in range(V):
            x, y = np.minimum(a + at, self.size), np.minimum(b + at, self.size)
            same = inside & (self.words[x] == self.words[y]) & (self.words[x] > 0)
            at = at + same
        common[1:] = at
        self.table = np.empty((int(n).bit_length(), n), np.int32)
        self.table[0] = common
        for k in range(1, len(self.table)):
            half = 1 << (k - 1)
            self.table[k] = self.table[k - 1]
            self.table[k, :n - half] = np.minimum(self.table[k - 1, :n - half], self.table[k - 1, half:])


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of the rows of several keys, the first key first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


@dataclass
class Runs:
    """Runs of many texts, by text, start and period; ``start`` counts within the text."""
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _grid(sizes: np.ndarray, min_length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, i, p) for all grid points, in slices. A run of period p and least length has
    ``max(min_length, 2 p) - p`` places i whose partner i + p is in the run too."""
    tops = np.where(sizes < min_length, 0, sizes // 2)
    alive = np.flatnonzero(tops > 0)
    p = 1
    while len(alive):
        # As many periods at once as make about a slice of points.
        step = max(min_length, 2 * p) - p
        each = int(np.sum(sizes[alive] // step + 1))
        many = max(1, POINTS // max(each, 1))
        most = int(tops[alive].max())
        periods = np.arange(p, min(p + many, most + 1))
        text, period = np.repeat(alive, len(periods)), np.tile(periods, len(alive))
        fits = period <= tops[text]
        text, period = text[fits], period[fits]
        steps = np.maximum(min_length, 2 * period) - period
        counts = np.maximum(0, -(-(sizes[text] - period) // steps))
        owner = np.repeat(np.arange(len(text)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield text[owner], number * steps[owner], period[owner]
        p = int(periods[-1]) + 1
        alive = alive[tops[alive] >= p]


def find_runs(words: np.ndarray, sizes: np.ndarray, min_length: int = 12) -> Runs:
    """All runs of texts whose words (positive numbers) lie behind each other."""
    n_texts = len(sizes)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    spaced = np.zeros(int(np.sum(sizes + 1)), np.int64)
    text_of = np.repeat(np.arange(n_texts), sizes)
    spaced[np.arange(len(words)) + text_of] = words
    forward = Extensions(spaced, starts)
    # The same backwards, with the 0 behind each text again: place i becomes last - i.
    back = np.append(spaced[::-1][1:], 0) if len(spaced) else spaced
    last = len(spaced) - 2
    backward = Extensions(back, np.sort(last - (starts + sizes - 1))) if len(spaced) else forward
    found = []
    for text, i, p in _grid(sizes, min_length):
        at = starts[text] + i
        hit = np.flatnonzero(spaced[at] == spaced[at + p])
        text, at, p = text[hit], at[hit], p[hit]
        right = forward.of(at, at + p)
        # To the left of both places: the later place comes first backwards.
        left = _backward(backward, last, at, p, starts[text])
        long_ = left + right + p >= np.maximum(min_length, 2 * p)
        begin = (at - left - starts[text])[long_]
        found.append(np.stack([text[long_], begin, (left + right + p)[long_], p[long_]], axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    # A stretch found with several periods has the least of them.
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return Runs(rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3])


def _backward(backward: Extensions, last: int, at: np.ndarray, p: np.ndarray,
              start: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > start)
    if len(inner):
        # Backwards the place with the smaller number is the later one.
        out[inner] = backward.of(last - (at[inner] + p[inner] - 1), last - (at[inner] - 1))
    return out


def kept_words(runs: Runs, starts: np.ndarray, n_words: int) -> np.ndarray:
    """False for a word that lies in some run after that run's first period."""
    edge = np.zeros(n_words + 1, np.int64)
    first = starts[runs.text] + runs.start
    np.add.at(edge, first + runs.period, 1)
    np.add.at(edge, first + runs.length, -1)
    return np.cumsum(edge[:-1]) == 0


def _blocks(rows: Iterable[tuple[int, list[bytes]]]) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    numbers, held, texts = [], 0, []
    for number, words in rows:
        numbers.append(number)
        texts.append(words)
        held += len(words) + 1
        if held >= BLOCK_WORDS:
            yield numbers, texts
            numbers, held, texts = [], 0, []
    if numbers:
        yield numbers, texts


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = 12,
                  reworded: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """The id, ``runs`` (start, length and period, by start and period) and ``collapsed``,
    the words outside of repeats joined by spaces.

    ``reworded`` may change a document's words before runs are looked for; it gets the id.
    """
    rows = pick(documents, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)

            def texts() -> Iterator[tuple[int, list[bytes]]]:
                for number, (key, text) in enumerate(zip(keys, batch.column(1))):
                    words = (text.as_py() or "").encode().split()
                    yield number, reworded(key.as_py(), words) if reworded else words

            for numbers, block in _blocks(texts()):
                yield _answers(keys.slice(numbers[0], len(numbers)), block, min_length)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, runs array<struct<start:bigint,"
                                "length:bigint,period:bigint>>, collapsed string")


def _answers(keys: pa.Array, block: list[list[bytes]], min_length: int) -> pa.RecordBatch:
    sizes = np.array([len(words) for words in block], np.int64)
    known: dict[bytes, int] = {}
    flat = np.fromiter((known.setdefault(w, len(known) + 1) for words in block for w in words),
                       np.int64, int(sizes.sum()))
    runs = find_runs(flat, sizes, min_length)
    starts = np.cumsum(sizes) - sizes
    kept = kept_words(runs, starts, len(flat))
    touched = np.zeros(len(block), bool)
    touched[runs.text] = True
    collapsed = [b" ".join([w for w, k in zip(words, kept[a:a + len(words)]) if k] if hit else words)
                 for words, a, hit in zip(block, starts.tolist(), touched.tolist())]
    counts = np.bincount(runs.text, minlength=len(block)) if len(block) else np.zeros(0, np.int64)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    each = pa.StructArray.from_arrays([pa.array(runs.start), pa.array(runs.length), pa.array(runs.period)],
                                      names=["start", "length", "period"])
    return pa.record_batch([keys, pa.ListArray.from_arrays(offsets, each),
                            pa.array(collapsed, pa.binary()).cast(pa.string())],
                           names=["id", "runs", "collapsed"])
