import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelyard.llm import bpe, units

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
LIBRARY = {f: Tokenizer.from_file(path(f)) for f in FILES}
OWN = {f: bpe.Bpe(path(f)) for f in FILES}

ODD = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb", "\ta\x0b\x0cb\r\n", "don't we'll I'M",
       "x<|endoftext|>y", "x <|endoftext|> y<|startoftext|>", "ΑΣ ΣΑΣ", "İstanbul", "é è", "é ́a",
       "123 4567", "!!!??? ...", "\x1c a\x1d", "a\xa0b \xa0 c", "日本語 テキスト", "👩‍👩‍👧 x", "a" * 3000,
       " a 　 b", "_ __ _a", "²³ ½", "ß ẞ", "\x00 \x01a", "trailing   "]


@pytest.mark.parametrize("file", FILES)
def test_odd_texts_like_the_library(file):
    rng = random.Random(3)
    mixed = ["".join(rng.choice(ODD[1:]) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    for text in ODD + mixed:
        want = LIBRARY[file].encode(text, add_special_tokens=False).ids
        assert OWN[file].encode(text) == want, repr(text)
        [(ids, decoded)] = bpe.encode_and_decode(path(file), pa.array([text]))
        assert ids == b"".join(i.to_bytes(4, "little") for i in want), repr(text)
        assert decoded == LIBRARY[file].decode(want, skip_special_tokens=False), repr(text)
        assert [*units.library_ids(path(file), pa.array([text]))] == [ids], repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]),
                                  st.sampled_from(" \n\t'.sStT")), max_size=60))
def test_any_text_like_the_library(text):
    for file in FILES:
        want = LIBRARY[file].encode(text, add_special_tokens=False).ids
        assert [*units.library_ids(path(file), pa.array([text]))] == [b"".join(i.to_bytes(4, "little") for i in want)]
        assert OWN[file].encode(text) == want


@pytest.mark.parametrize("file", FILES)
def test_many_texts_at_once(file):
    texts = ODD + [" ".join(ODD), "", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b"]
    want = [b"".join(i.to_bytes(4, "little") for i in LIBRARY[file].encode(t, add_special_tokens=False).ids)
            for t in texts]
    assert [*units.library_ids(path(file), pa.array(texts))] == want
    assert [ids for ids, _ in bpe.encode_and_decode(path(file), pa.array(texts))] == want


def test_forgetting_changes_nothing():
    small = units.Units(str, limit=20)
    texts = [" ".join(f"w{i % 37}" for i in range(k, 500)) for k in range(30)] + ["", " ", "  a", " a" * 100]
    assert ["".join(found) for found in small.of_column(pa.array(texts))] == texts


def test_query_rows(docs):
    file = FILES[0]
    rows = [(1, "Hello there, world"), (2, None), (3, ""), (None, "again again"), (1, "Hello there, world"),
            (5, "long " * 30_000)]
    frame = docs(rows).withColumn("ids", F.lit("x")).withColumnRenamed("source", "Text")
    got = bpe.encoded(frame, path(file)).collect()
    assert len(got) == len(rows)
    for row, (key, text) in zip(got, rows):
        want = LIBRARY[file].encode(text or "", add_special_tokens=False).ids
        assert (row["doc_id"], row["n_tokens"]) == (key, len(want))
        assert hashlib.sha256(bytes(row["ids"])).digest() == hashlib.sha256(
            b"".join(i.to_bytes(4, "little") for i in want)).digest()
        assert row["decoded"] == LIBRARY[file].decode(want, skip_special_tokens=False)
    assert bpe.encoded(docs([]), path(file)).count() == 0
