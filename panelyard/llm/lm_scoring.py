"""Stupid-backoff language-model scores of documents.

N-grams of all orders are hashed, counted over all documents by the owners of their
hashes, and given back to the batches whose texts hold them (``gram_counts``); each
batch joins the counts to its n-grams and sums logarithms per document. Words and 2-grams come
first: a longer n-gram with a 2-gram that occurs once occurs once, and is not sent.

Every document is scored by the counts of all the others: its own occurrences are
taken off. A word's score is c(n-gram) / c(context) for the longest n-gram that ends in
the word and that other documents hold, times ``BACKOFF`` for each longer one that they do
not; at the start of a text the longest n-gram is shorter. The last step is
c(word) / (N + 1) with N words in the other documents, where an unseen word counts as one.

Defined results: a text without words (null and empty ones too) has no score, null; the
only document of a table has nothing but unseen words; repeated rows are documents of
their own; an empty table gives an empty result. N-grams are told apart by 64-bit hashes; two
that share one share their count, which moves a score but never makes it infinite or a
word's share larger than 1. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.llm.frames import pick
from panelyard.llm.gram_counts import BATCH_BYTES, Counting, in_batches
from panelyard.llm.units import chunks
from panelyard.llm.wordhash import windows, word_hashes
from panelyard.session import staged

ORDER = 3
BACKOFF = 0.4
PART_BYTES = 1 << 20  # of text hashed at a time


def grams_of(column: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per size from 1 to ``order`` the n-gram hashes of all texts, and the words of each text."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in chunks(column.combine_chunks(), PART_BYTES):
        h, c = word_hashes(part)
        hashes.append(h)
        counts.append(c)
    words, counts = np.concatenate(hashes), np.concatenate(counts)
    return [windows(words, counts, n)[0] for n in range(1, order + 1)], counts


def _by_word(values: np.ndarray, counts: np.ndarray, size: int, end: bool) -> np.ndarray:
    """Values of n-grams at the word that ends them, or at the word behind them; else 0."""
    number = np.maximum(counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), number)
    within = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    place = (np.cumsum(counts) - counts)[text] + within + (size - 1 if end else size)
    if not end:  # the last n-gram of a text is nobody's context
        fits = within + size < counts[text]
        place, values = place[fits], values[fits]
    out = np.zeros(int(counts.sum()), values.dtype)
    out[place] = values
    return out


def scores(grams: list[np.ndarray], counts: np.ndarray, totals: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Per text: sum of logarithms without the division by N + 1, and words scored at each size.

    ``totals`` are the counts of ``grams`` in all texts.
    """
    order, n_texts = len(grams), len(counts)
    text_of_word = np.repeat(np.arange(n_texts), counts)
    others = []
    for size, (own, total) in enumerate(zip(grams, totals), 1):
        kinds, place = np.unique(own, return_inverse=True)
        text = np.repeat(np.arange(n_texts), np.maximum(counts - size + 1, 0))
        _, again, here = np.unique(text * max(1, len(kinds)) + place, return_inverse=True, return_counts=True)
        others.append(total - here[again])
    at_word = [_by_word(o, counts, size, True) for size, o in enumerate(others, 1)]
    log_score = np.full(len(text_of_word), np.nan)
    level = np.zeros(len(text_of_word), np.int64)
    within = np.arange(len(text_of_word)) - np.repeat(np.cumsum(counts) - counts, counts)
    for size in range(order, 0, -1):
        seen = at_word[size - 1] > 0
        open_words = np.isnan(log_score) & (seen if size > 1 else True) & (within >= size - 1)
        value = np.log(np.maximum(at_word[size - 1][open_words], 1))
        if size > 1:
            # A context occurs as often as its n-gram at least; where a shared hash says
            # otherwise, the n-gram's count stands for both.
            context = np.maximum(_by_word(others[size - 2], counts, size - 1, False), at_word[size - 1])
            value -= np.log(context[open_words])
        longest = np.minimum(within[open_words] + 1, order)
        log_score[open_words] = value + (longest - size) * math.log(BACKOFF)
        level[open_words] = size
    by_size = [np.bincount(text_of_word[level == size], minlength=n_texts) for size in range(1, order + 1)]
    return np.bincount(text_of_word, log_score, minlength=n_texts), *by_size


def in_repeated(pairs: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """For the n-grams of each size from 3 to ``order``: whether all their 2-grams occur more than once.

    ``pairs`` are the counts of the 2-grams of all texts in all texts.
    """
    out, kept, n = [], pairs > 1, np.maximum(counts - 1, 0)
    for size in range(3, order + 1):
        # N-grams of a text are one less than those a word shorter: each joins two of them.
        joined = np.append(kept[:-1] & kept[1:], False)
        last = (np.cumsum(n) - 1)[n > 0]
        kept = np.delete(joined[:len(kept)], last)
        n = np.maximum(n - 1, 0)
        out.append(kept)
    return out


def scored(documents: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text",
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The id, ``n_words``, the words scored at each size and ``log_score``, their summed logarithms."""
    rows = pick(documents, id_col, text_col).toDF("key", "text")
    batches, n, _ = in_batches(rows, batch_bytes)
    sizes = [f"n_{size}_gram" for size in range(1, order + 1)]

    def items(table: pa.Table) -> np.ndarray:
        return np.concatenate(grams_of(table.column("text"), min(order, 2))[0])

    counting = Counting(n, 64, items)

    def split(joined: np.ndarray, grams: list[np.ndarray]) -> list[np.ndarray]:
        return np.split(joined, np.cumsum([len(g) for g in grams])[:-1])

    def short_totals(grams: list[np.ndarray], answers: pa.Table) -> list[np.ndarray]:
        return split(counting.totals(np.concatenate(grams[:2]), answers), grams[:2])

    def longer(texts: pa.Table, answers: pa.Table) -> np.ndarray:
        grams, counts = grams_of(texts.column("text"), order)
        kept = in_repeated(short_totals(grams, answers)[1], counts, order)
        return np.concatenate([g[k] for g, k in zip(grams[2:], kept)])

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        grams, counts = grams_of(texts.column("text"), order)
        first = pc.equal(answers.column("round"), 1)
        totals = short_totals(grams, answers.filter(first))
        if order > 2:
            kept = in_repeated(totals[1], counts, order)
            sent = [g[k] for g, k in zip(grams[2:], kept)]
            known = split(counting.totals(np.concatenate(sent), answers.filter(pc.invert(first))), sent)
            for g, k, t in zip(grams[2:], kept, known):
                totals.append(np.ones(len(g), np.int64))
                totals[-1][k] = t
        raw, *by_size = scores(grams, counts, totals)
        return pa.table([texts.column("key"), pa.array(counts, pa.int64()), pa.array(raw, pa.float64()),
                         *[pa.array(b, pa.int64()) for b in by_size]], names=["key", "n_words", "raw", *sizes])

    short = counting.repeated(batches)
    answers = short.withColumn("round", F.lit(1))
    if order > 2:
        answers = answers.unionByName(
            counting.repeated_after(batches, short, longer).withColumn("round", F.lit(2)))
    found = staged(batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        score, f"key {rows.schema['key'].dataType.simpleString()}, n_words bigint, raw double, "
        + ", ".join(f"{s} bigint" for s in sizes)), "scores")
    words = found.agg(F.sum("n_words")).first()[0] or 0
    # Words scored alone were divided by nothing yet.
    log_score = F.col("raw") - F.col(sizes[0]) * F.log(F.lit(words + 1) - F.col("n_words"))
    return found.select(F.col("key").alias(id_col), "n_words", *sizes,
                        F.when(F.col("n_words") > 0, log_score).alias("log_score"))
