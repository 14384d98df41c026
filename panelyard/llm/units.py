"""Token ids of whole texts, put together from remembered pieces.

A tokenizer that splits at white space never forms a token over the boundary before
a space that a visible character follows. Texts are therefore cut at such spaces,
each distinct piece of many texts is encoded once, and pieces seen before are looked
up: prose repeats its words. Pieces with other white space in them stay whole, so every
text gets exactly the ids of the whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Generic, TypeVar

import pyarrow as pa
import pyarrow.compute as pc

from panelyard.llm.words import TextTreatment

T = TypeVar("T")

# A space with no printable ASCII character, letter or digit behind it.
_OTHER_SPACE = re.compile(r" (?![!-~]|[^\W_])")
_VISIBLE = re.compile(r"[!-~]|[^\W_]")

CHUNK_BYTES = 1 << 23
KEPT_CHARS = 64  # longer pieces hardly come again


def pieces(text: str) -> list[str]:
    """The text cut before single spaces; each piece but the first lost that space."""
    first, *rest = text.split(" ")
    out = [first]
    for part in rest:
        if _VISIBLE.match(part):
            out.append(part)
        else:
            out[-1] = f"{out[-1]} {part}"
    return out


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of a string column with about so many bytes, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy().tolist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield column.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(sizes):
        yield column.slice(start)


class Units(Generic[T]):
    """What ``encode`` gives for the pieces of texts, remembered for up to ``limit`` pieces."""

    def __init__(self, encode: Callable[[str], T], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.known: dict[str, T] = {}

    def get(self, piece: str) -> T:
        """For a piece behind a space that it lost."""
        value = self.known.get(piece)
        if value is None:
            value = self.encode(f" {piece}")
            if len(piece) <= KEPT_CHARS:
                self.known[piece] = value
        return value

    def of_column(self, column: pa.Array) -> Iterator[list[T]]:
        """For each text what its pieces give, in order; nothing for a null."""
        for chunk in chunks(column):
            if len(self.known) > self.limit:
                self.known.clear()
            texts = chunk.to_numpy(zero_copy_only=False).tolist()
            plain = [bool(t) and not _OTHER_SPACE.search(t) for t in texts]
            parts = pc.split_pattern(pc.if_else(pa.array(plain, pa.bool_()), chunk, ""), " ")
            coded = parts.flatten().dictionary_encode()
            values = list(map(self.get, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
            places = coded.indices.to_numpy().tolist()
            stops = pc.cumulative_sum(pc.list_value_length(parts)).to_numpy().tolist()
            for text, is_plain, start, stop in zip(texts, plain, [0, *stops], stops):
                if not text:
                    yield []
                elif is_plain:
                    head = text[:text.find(" ")] if " " in text else text
                    yield [self.encode(head), *[values[i] for i in places[start + 1:stop]]]
                else:
                    head, *rest = pieces(text)
                    yield [self.encode(head), *map(self.get, rest)]


KNOWN_WORDS = 600_000


def _library_encode(path: str) -> Callable[[str], bytes]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    treatment = TextTreatment.of(path)

    def whole(piece: str) -> bytes:
        return array("I", tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    if treatment is None:
        return whole
    known: dict[str, bytes] = {}
    tokenize, words_of, letters = tokenizer.model.tokenize, treatment.words, treatment.letters
    holds_special = treatment.holds_special

    def new(word: str) -> bytes:
        ids = array("I", [t.id for t in tokenize(letters(word))]).tobytes()
        if len(word) <= KEPT_CHARS:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[word] = ids
        return ids

    def by_word(piece: str) -> bytes:
        """The library's model for each distinct word, whose ids do not depend on others."""
        if holds_special(piece):
            return whole(piece)
        words = words_of(piece)
        if len(words) == 1:
            return known.get(words[0]) or new(words[0])
        return b"".join([known.get(w) or new(w) for w in words])

    return by_word


@lru_cache(maxsize=4)
def _library_units(path: str) -> Units[bytes]:
    return Units(_library_encode(path))


def library_ids(path: str, column: pa.Array) -> Iterator[bytes]:
    """Ids of the tokenizers library for each text, as little-endian 32-bit numbers."""
    return map(b"".join, _library_units(path).of_column(column))
