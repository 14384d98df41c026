"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. An n-gram is
the product of its letters' vectors, each rotated by its place (binding). The vector
of a text is the sum over its n-grams (bundling), the prototype of a language the sum over its
training texts. A text gets the language whose prototype has the largest cosine.

Texts are lower-cased; a run of other characters than letters is one blank, and a text
has a blank at both ends, so that one letter makes one 3-gram.

Training sums vectors per task and language, then over tasks by language and
coordinate. All sums are whole numbers, so the result does not depend on their order. Vectors of
n-grams are made a slice at a time, and a very long text is read in parts: memory has a bound.
The prototypes, one vector per language, go to the tasks; more than
``MAX_LANGUAGES`` distinct values are refused as no list of languages.

Defined results: a null text, or one without letters, is ``und`` with score 0, and so is every
text when there is nothing to learn from; of equal cosines the first language in
alphabetical order wins; the score is the cosine, at least 0; rows with a null id are
held out; repeated rows are judged one by one; an empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.llm.frames import named, numbered, pick

DIMENSIONS = 1024
GRAM = 3
SEED = 20_011
MAX_LANGUAGES = 4096
UNKNOWN = "und"
CHUNK_CHARS = 1 << 20
CHUNK_TEXTS = 2000
SLICE = 1 << 13  # kinds of n-grams whose vectors are in memory
TEXT_WEIGHT = 1 << 24  # of a training text as a whole, shared by its n-grams
_DENSE = 1 << 22
_CODES = 0x110000


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(_CODES)), bool, _CODES)


@lru_cache(1 << 15)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    """The vector of a letter; code 0 is the blank."""
    bits = np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, dimensions)
    return (2 * bits - 1).astype(np.int8)


@dataclass
class Grams:
    """The n-grams of some texts."""

    has_letters: np.ndarray  # by text
    ends: np.ndarray  # of each text in ``kinds``
    kinds: np.ndarray  # rows of ``letters``
    letters: np.ndarray = field(repr=False)  # code points of each kind of n-gram


def _symbols(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which characters count, and what they are: letters, and 0 for the first other one after a letter."""
    letter = _is_letter()[points]
    kept = letter | first
    kept[1:] |= letter[:-1]
    return kept, np.where(letter, points, 0)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _kinds(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text and the kind of each n-gram, and the letters of each kind."""
    alphabet = np.unique(symbols)
    places = np.searchsorted(alphabet, symbols)
    size, n = len(alphabet), max(0, len(places) - GRAM + 1)
    same = text[:n] == text[GRAM - 1:]
    codes = np.zeros(n, np.int64)
    for k in range(GRAM):
        codes = codes * size + places[k:k + n]
    codes, text = codes[same], text[:n][same]
    if size ** GRAM <= _DENSE:
        present = np.flatnonzero(np.bincount(codes.astype(np.int64), minlength=1))
        lookup = np.zeros(size ** GRAM, np.int64)
        lookup[present] = np.arange(len(present))
        kinds = lookup[codes]
    else:
        present, kinds = np.unique(codes, return_inverse=True)
    letters = np.stack([alphabet[present // size ** (GRAM - 1 - k) % size] for k in range(GRAM)], axis=1)
    return text, kinds, letters


def grams(texts: list[str]) -> Grams:
    lowered = [t.lower() for t in texts]
    points = _points("".join(f" {t} " for t in lowered))
    sizes = np.array([len(t) + 2 for t in lowered], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    first = np.zeros(len(points), bool)
    first[np.cumsum(sizes) - sizes] = True
    kept, symbols = _symbols(points, first)
    has = np.bincount(text[symbols > 0], minlength=len(texts)) > 0
    text, kinds, letters = _kinds(symbols[kept], text[kept])
    return Grams(has, np.cumsum(np.bincount(text, minlength=len(texts))), kinds, letters)


def long_grams(text: str) -> Iterator[Grams]:
    """The n-grams of one text, ``CHUNK_CHARS`` characters at a time."""
    low = f" {text.lower()} "
    carried = np.zeros(0, np.uint32)
    for start in range(0, len(low), CHUNK_CHARS):
        points = _points(low[max(0, start - 1):start + CHUNK_CHARS])
        first = np.zeros(len(points), bool)
        first[0] = True
        kept, symbols = _symbols(points, first)
        if start:  # the character before is there for the one after it only
            kept[0] = False
        symbols = np.concatenate([carried, symbols[kept]])
        _, kinds, letters = _kinds(symbols, np.zeros(len(symbols), np.int64))
        yield Grams(np.array([(symbols > 0).any()]), np.array([len(kinds)]), kinds, letters)
        carried = symbols[-(GRAM - 1):]


def gram_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors, one row per n-gram: letter k is rotated by its distance to the end."""
    return next(vector_slices(letters, dimensions, max(1, len(letters))), np.ones((0, dimensions), np.int8))


def vector_slices(letters: np.ndarray, dimensions: int, size: int) -> Iterator[np.ndarray]:
    """``gram_vectors``, ``size`` n-grams at a time."""
    known, rows = np.unique(letters, return_inverse=True)
    rows = rows.reshape(letters.shape)
    table = np.empty((len(known), dimensions), np.int8)
    for i, code in enumerate(known.tolist()):
        table[i] = letter_vector(code, dimensions)
    for a in range(0, len(letters), size):
        out = table[rows[a:a + size, GRAM - 1]]
        for k in range(GRAM - 1):
            shift, part = GRAM - 1 - k, table[rows[a:a + size, k]]
            out[:, shift:] *= part[:, :-shift]
            out[:, :shift] *= part[:, -shift:]
        yield out


def bundled(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: whether it has letters, its number of n-grams, and the sum of their vectors.

    The sums are whole numbers. Vectors are made for ``SLICE`` kinds of n-grams at a time.
    """
    has, sizes = np.zeros(len(texts), bool), np.zeros(len(texts), np.int64)
    sums = np.zeros((len(texts), dimensions))

    def add(found: Grams, rows: list[int]) -> None:
        has[rows] |= found.has_letters
        sizes[rows] += np.diff(found.ends, prepend=0)
        counted = []
        for start, stop in zip([0, *found.ends], found.ends):
            own = found.kinds[start:stop]
            if len(own) * 16 < len(found.letters):
                counted.append(np.unique(own, return_counts=True))
            else:
                counts = np.bincount(own)
                there = np.flatnonzero(counts)
                counted.append((there, counts[there]))
        for k, vectors in enumerate(vector_slices(found.letters, dimensions, SLICE)):
            a, vectors = k * SLICE, vectors.astype(np.float32)
            for row, (there, counts) in zip(rows, counted):
                i, j = np.searchsorted(there, [a, a + SLICE])
                if i < j:
                    sums[row] += counts[i:j].astype(np.float32) @ vectors[there[i:j] - a]

    short = [i for i, t in enumerate(texts) if len(t) < CHUNK_CHARS]
    if short:
        add(grams([texts[i] for i in short]), short)
    for i, text in enumerate(texts):
        if len(text) >= CHUNK_CHARS:
            for found in long_grams(text):
                add(found, [i])
    return has, sizes, sums


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of parts of a batch that have bounded size."""
    start, held, texts = 0, 0, []
    for i, value in enumerate(batch.column(column)):
        texts.append(value.as_py() or "")
        held += len(texts[-1]) + 2
        if held >= CHUNK_CHARS or len(texts) == CHUNK_TEXTS:
            yield start, texts
            start, held, texts = i + 1, 0, []
    if texts:
        yield start, texts


@dataclass(frozen=True)
class Prototypes:
    languages: tuple[str, ...]
    vectors: np.ndarray  # unit length, one row per language


def train(examples: DataFrame, dimensions: int = DIMENSIONS, text_col: str = "text",
          lang_col: str = "lang") -> Prototypes:
    """Prototypes of the languages of ``examples``; rows without text or language do not count."""
    rows = pick(examples, lang_col, text_col).toDF("lang", "text").where("lang is not null and text is not null")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, texts in _chunks(batch, 1):
                has_letters, size, own = bundled(texts, dimensions)
                share = np.where(has_letters, np.maximum(1, TEXT_WEIGHT // np.maximum(size, 1)), 0)
                labels, of_text = np.unique(np.array(langs[start:start + len(texts)], object), return_inverse=True)
                for k, lang in enumerate(labels):
                    chosen = of_text == k
                    total = sums.setdefault(lang, np.zeros(dimensions, np.int64))
                    total += share[chosen] @ own[chosen].astype(np.int64)
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.string()),
                                   pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                                  names=["lang", "vector"])

    partial = rows.mapInArrow(bundle, "lang string, vector array<bigint>")
    summed = (partial.select("lang", F.posexplode("vector").alias("at", "x"))
              .groupBy("lang", "at").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
              .select("lang", F.transform("v", lambda s: s["x"]).alias("v")).orderBy("lang"))
    found = summed.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"column {lang_col} has more than {MAX_LANGUAGES} values: not languages")
    vectors = np.array([r["v"] for r in found], float).reshape(len(found), dimensions)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Prototypes(tuple(r["lang"] for r in found),
                      (vectors / np.where(length == 0, 1, length)).astype(np.float32))


def judge(texts: list[str], prototypes: Prototypes) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    names, scores = [], []
    for has, _, own in zip(*bundled(texts, prototypes.vectors.shape[1])):
        if not has or not prototypes.languages:
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        own = own.astype(np.float32)
        cosine = prototypes.vectors @ (own / max(float(np.linalg.norm(own)), 1e-9))
        best = int(cosine.argmax())
        names.append(prototypes.languages[best])
        scores.append(min(1.0, max(0.0, float(cosine[best]))))
    return names, scores


def predict(documents: DataFrame, prototypes: Prototypes, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """The id, ``lang_pred`` and ``score`` of every document."""
    rows = pick(documents, id_col, text_col).toDF("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _chunks(batch, 1):
                names, scores = judge(texts, prototypes)
                yield pa.record_batch([batch.column(0).slice(start, len(texts)), pa.array(names, pa.string()),
                                       pa.array(scores, pa.float64())], names=["key", "lang_pred", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double") \
        .select(F.col("key").alias(id_col), "lang_pred", "score")


def recognised(documents: DataFrame, prototypes: Prototypes, text_col: str = "text") -> DataFrame:
    """``documents``, all columns, without those whose language is ``und``.

    Without any prototype there is nothing to tell languages by: those with letters stay.
    """
    place = documents.columns.index(text_col)
    plain = numbered(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _chunks(batch, place):
                if prototypes.languages:
                    kept = [name != UNKNOWN for name in judge(texts, prototypes)[0]]
                else:
                    kept = [any(c.isalpha() for c in t) for t in texts]
                yield batch.slice(start, len(texts)).filter(pa.array(kept, pa.bool_()))

    return named(plain.mapInArrow(run, plain.schema), documents)


FOLDS = 5


def is_held_out(id_col: Column) -> Column:
    """One fold of the documents, by their id; those without id are in it."""
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(True))


def train_and_predict(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """Learns from the folds that are not held out and predicts all documents."""
    known = pick(documents, id_col, text_col, lang_col).where(~is_held_out(F.col(id_col)))
    prototypes = train(known, text_col=text_col, lang_col=lang_col)
    return predict(documents, prototypes, id_col, text_col).select(
        id_col, is_held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")
