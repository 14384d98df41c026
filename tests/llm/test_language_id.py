import tracemalloc
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from panelyard.llm import language_id as lid

D = 256


def by_hand(text):
    """The vector of a text, n-gram by n-gram."""
    symbols = [0]
    for c in text.lower():
        if c.isalpha():
            symbols.append(ord(c))
        elif symbols[-1]:
            symbols.append(0)
    if symbols[-1]:
        symbols.append(0)
    total = np.zeros(D, int)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        total += np.roll(lid.letter_vector(a, D), 2).astype(int) * np.roll(lid.letter_vector(b, D), 1) \
            * lid.letter_vector(c, D)
    return total


TEXTS = ["The boat", "", "a", " .. Ünder-dem 12 Haus!", "x1y2", "日本語のテキスト", "12 34", "İstanbul ß", "a" * 5000,
         "".join(chr(0x4E00 + i) for i in range(400))]


def test_vectors_match_brute_force():
    for texts in (TEXTS, TEXTS[:3], [""], ["1"], []):
        found = lid.grams(texts)
        vectors = lid.gram_vectors(found.letters, D)
        start = 0
        for text, stop, has in zip(texts, found.ends, found.has_letters):
            got = vectors[found.kinds[start:stop]].astype(int).sum(axis=0)
            if has:
                assert (got == by_hand(text)).all(), text
            assert has == any(c.isalpha() for c in text)
            start = stop


def test_training_equals_brute_force(docs, spark):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(
        [("the boat and the river", "en"), ("der Fluss und das Boot", "de"), (None, "en"), ("the end", "en"),
         ("ignored", None), ("123", "xx")] * 3)]
    got = lid.train(docs(rows).repartition(4), D)
    assert got.languages == ("de", "en", "xx")
    for lang, vector in zip(got.languages, got.vectors):
        want = sum((by_hand(t) / (len(t) + 0.0) for _, t, x, _ in rows if x == lang and t and t != "123"),
                   np.zeros(D))
        assert np.allclose(vector, want / max(np.linalg.norm(want), 1e-9), atol=1e-4)


def test_cases(docs, spark):
    rows = [(None, "the boat", "en", "s"), (1, None, "en", "s"), (2, "", "en", "s"), (3, "77 !", None, "s"),
            (4, "w " * 60_000, "en", "s")]
    rows += [(10 + i, "the boat and the river and the hill", "en", "s") for i in range(20)]
    rows += [(40 + i, "der Fluss und das Boot und der Berg", "de", "s") for i in range(20)]
    frame = docs(rows).withColumn("score", F.lit("x")).withColumn("LANG_PRED", F.lit(1))
    got = {r["doc_id"]: r for r in lid.train_and_predict(frame).collect()}
    assert len(got) == len(rows)
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0
    assert got[None]["held_out"] and got[None]["lang_pred"] in ("de", "en")
    for key, _, lang, _ in rows[5:]:
        assert got[key]["lang_pred"] == lang and 0 <= got[key]["score"] <= 1
        assert got[key]["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
    nothing = docs([(1, "words", None, "s"), (2, "words", None, "s")])
    assert {r["lang_pred"] for r in lid.train_and_predict(nothing).collect()} == {"und"}
    assert lid.train_and_predict(docs([])).count() == 0


def test_held_out_accuracy_and_no_leak(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    table = table.where("text is not null")
    got = lid.train_and_predict(table).collect()
    truth = {r["doc_id"]: r["lang"] for r in table.collect()}
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    right = Counter(truth[r["doc_id"]] == r["lang_pred"] for r in held)
    assert right[True] / len(held) >= 0.97
    # Other languages on the held-out rows change nothing.
    other = table.withColumn("lang", F.when(lid.is_held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(lid.train_and_predict(other).collect()) == sorted(got)


def test_slices_and_parts_change_nothing(monkeypatch):
    """Long texts in parts and n-grams in slices give the sums of one go."""
    texts = [*TEXTS, "Straße, ΟΔΟΣ! 12 " * 9, " 1 " * 40 + "x", "ab" * 30]
    whole = lid.bundled(texts, D)
    for chars, size in ((7, 50), (64, 1000), (1 << 20, 30)):
        monkeypatch.setattr(lid, "CHUNK_CHARS", chars)
        monkeypatch.setattr(lid, "SLICE", size)
        for want, got in zip(whole, lid.bundled(texts, D)):
            assert (want == got).all()
    assert all((own == by_hand(t)).all() for t, has, own in zip(texts, whole[0], whole[2]) if has)


def test_many_kinds_of_ngrams_need_bounded_memory():
    """A million characters from a large alphabet: nearly every n-gram is another."""
    rng = np.random.default_rng(3)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 1_000_000)))
    lid.bundled(["warm"], 1024)
    tracemalloc.start()
    try:
        has, sizes, sums = lid.bundled([text], 1024)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert has[0] and sizes[0] == 1_000_000 and sums.any()
    assert peak < 500e6
