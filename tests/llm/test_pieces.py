import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

import __spark_entry__ as entry
from panelyard.llm import pieces

FILE = path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)
OWN = pieces.model(FILE)
ODD = ["", " ", "  ", " a", "a ", "a  b", "▁", "a▁b", "a\x00b\n\tc", "<s>x</s>", "<0x41>", "ﬁ ｆ é", "漢字テキスト",
       "🙂👩‍👩‍👧 x", "𐍈𐍈", "a" * 3000, " " * 3000, "the" * 2000, "thethe  ingtion", "  x�", "²³ ½"]


def check(texts):
    for text, ids in zip(texts, OWN.encode(texts), strict=True):
        want = LIBRARY.encode(text)
        assert ids.tolist() == want, repr(text)
        assert OWN.decode(ids) == LIBRARY.decode(want), repr(text)


def test_odd_texts_like_the_library():
    rng = random.Random(5)
    bits = [*ODD[1:13], "ing", "er", "tion", " the", "th", "aa", "1", "梦"]
    check(ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(3000)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]),
                                           st.sampled_from("  \n▁aeinrst")), max_size=50), max_size=5))
def test_any_texts_like_the_library(texts):
    check(texts)


@pytest.mark.parametrize("block", [1, 7, 64])
def test_texts_of_many_blocks(block, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", block)
    rng = random.Random(block)
    check(["".join(rng.choice(["the", " ", "  ", "x", "ing\n", "🙂"]) for _ in range(80)) for _ in range(50)] + ODD[:16])


def test_long_texts_without_spaces():
    rng = random.Random(2)
    check(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000)), " " * 100_000])


def test_words_with_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(pieces, "mix", lambda x: x * np.uint64(0))
    check(["the thing and a thing", "other words, other things", ""])


def test_decoding_of_any_ids():
    rng = random.Random(7)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randint(0, 9))]
        assert OWN.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_other_kinds_of_models_are_refused(tmp_path):
    raw = open(FILE, "rb").read()
    unigram = tmp_path / "unigram.model"
    unigram.write_bytes(raw + b"\x12\x02\x18\x01")  # the type of model once more
    with pytest.raises(ValueError):
        pieces.PieceModel(str(unigram))


def test_edges_of_the_operator(spark, docs):
    frame = docs([(1, None), (2, ""), (2, ""), (None, "a b"), (3, " x ")]).withColumnRenamed("n_chars", "ids")
    rows = {(r.doc_id, r.n_tokens, r.decoded) for r in pieces.encoded(frame, FILE).collect()}
    assert rows == {(1, 0, ""), (2, 0, ""), (None, 2, "a b"), (3, len(LIBRARY.encode(" x ")), " x ")}
    assert pieces.encoded(frame, FILE).count() == 5
    assert pieces.encoded(frame.limit(0), FILE).collect() == []


def test_query_like_the_library(spark, sf):
    found = {r.doc_id: r for r in entry.queries()["op11_sentencepiece"](spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(texts)
    for row in texts:
        ids, got = LIBRARY.encode(row.text or ""), found[row.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
