import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

STAGE = dict(corpus_pipeline.STAGES)


def secret(i):
    return hashlib.sha512(str(i).encode()).hexdigest()[:40]


@pytest.fixture
def table(spark, docs, tmp_path):
    def build(rows, name="t", **extra):
        frame = docs(rows)
        for column, value in extra.items():
            frame = frame.withColumn(column, F.lit(value))
        frame.repartition(2).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))
    return build


def corpus():
    rng = random.Random(3)
    en = [f"the {a}{b}" for a in ("riv", "tow", "mor", "boa") for b in ("er", "n", "ning", "t", "ted", "ing")]
    de = [f"der {a}{b}" for a in ("Flu", "Sta", "Mor", "Schi") for b in ("ss", "dt", "gen", "ff", "ung", "keit")]
    rows = []
    for i in range(60):
        words, lang = (en, "en") if i % 3 else (de, "de")
        rows.append((i, " ".join(rng.choice(words) for _ in range(80)), lang, f"s{i % 4}"))
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 !! 34", None, None), (103, rows[7][1], None, "s"),
             (104, rows[7][1].replace(" ", "\n", 3), "en", "s"), (None, rows[8][1], "en", "s")]
    # Near copies of one document, one word changed; and secrets.
    base = rows[10][1].split(" ")
    for k in range(12):
        words = list(base)
        words[5 * k + 3] = f"changed{k}"
        rows.append((200 + k, " ".join(words), "en", "s1"))
    for k in range(12):
        rows.append((300 + k, f'{rows[20 + k][1][:200]} {"kvw"[k % 3] * 3} token = "{secret(k)}" {k * 7919} '
                     + " ".join(rng.choice(en) for _ in range(70)), "en", "s2"))
    return rows


def test_stages_by_hand(spark, table):
    docs = table(corpus(), label="x", digest=1, _id=2, c0="y")
    columns = docs.columns
    known = STAGE["language_id"](spark, docs, "")
    assert known.columns == columns
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    kept = {(r["doc_id"], r["text"]) for r in known.collect()}
    assert texts - kept == {(100, None), (101, ""), (102, "12 !! 34")}

    known.write.parquet(docs.inputFiles()[0].rsplit("/", 2)[0] + "/known")
    docs = spark.read.parquet(docs.inputFiles()[0].rsplit("/", 2)[0] + "/known")
    unique = STAGE["exact_dedup"](spark, docs, "")
    assert unique.columns == columns
    left = {r["doc_id"] for r in unique.collect()}
    assert {r["doc_id"] for r in docs.collect()} - left == {103, 104, None}

    apart = STAGE["jaccard_join"](spark, unique, "")
    assert apart.columns == columns
    assert left - {r["doc_id"] for r in apart.collect()} == set(range(200, 212))

    clean = STAGE["secret_scan"](spark, apart, "")
    assert clean.columns == columns
    before = {r["doc_id"]: r for r in apart.collect()}
    for r in clean.collect():
        old = before.pop(r["doc_id"])
        want = old["text"].replace(secret((r["doc_id"] or 0) - 300), "[SECRET]")
        assert (r["text"], r["n_chars"], r["label"]) == (want, len(want), "x")
    assert not before

    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in clean.collect()}
    got = defaultdict(int)
    for r in STAGE["packing"](spark, clean, "").collect():
        got[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == want[r["doc_id"]]
    assert got == want


def test_nothing_to_learn_languages_from(spark, table):
    rows = [(i, text, None, source) for i, text, _, source in corpus()[:20]] + [(102, "12 !! 34", None, None)]
    for name, some in (("unlabelled", rows), ("without_ids", [(None, t, "en", s) for _, t, _, s in rows])):
        kept = STAGE["language_id"](spark, table(some, name), "").collect()
        assert sorted(r["text"] for r in kept) == sorted(t for _, t, _, _ in rows[:-1]), name


def test_empty_table(spark, table):
    docs = table([])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 0, name
    assert STAGE["packing"](spark, docs, "").count() == 0


def test_whole_run(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = corpus_pipeline.run(spark, sf).collect()
    ids = {r["doc_id"] for r in pieces}
    assert ids <= {r["doc_id"] for r in table.collect()}
    assert len(ids) > 0.6 * table.count()
    offsets = defaultdict(list)
    for r in pieces:
        offsets[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in offsets.values():
        rows.sort()
        assert [o for o, _ in rows] == [0, *np.cumsum([n for _, n in rows])[:-1].tolist()]
