import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelyard.llm import packing
from panelyard.llm.packing import Limits, Piece, pack, powers_of_two

FILE = path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(30))
def test_limits_hold_and_every_token_is_placed_once(seed):
    rng = random.Random(seed)
    limits = Limits(64, rng.choice([1, 2, 5, 100]), rng.choice([1, 7, 30, 64]))
    items = []
    for i in range(rng.randint(0, 60)):
        n = rng.choice([1, 3, 64, 65, 128, rng.randint(1, 400)])
        items.append(Piece(i, 0, n, rng.choice([0, n, rng.randint(0, n)])))
    seen = defaultdict(list)
    for sequence in pack(items, limits):
        assert 0 < sum(p.tokens for p in sequence) <= limits.tokens
        assert len(sequence) <= limits.segments
        assert sum(p.loss for p in sequence) <= limits.loss_tokens
        split = list(powers_of_two(sequence))
        assert all((n := sum(p.tokens for p in s)) & (n - 1) == 0 for s in split)
        for s in split:
            for p in s:
                seen[p.example] += range(p.start, p.stop)
    assert {i: sorted(v) for i, v in seen.items()} == {p.example: list(range(p.stop)) for p in items}


def test_the_heuristic_mixes_demands():
    # Long prompts with little loss go with short prompts that are all loss.
    items = [Piece(i, 0, 50, 50) for i in range(10)] + [Piece(10 + i, 0, 14, 0) for i in range(10)]
    sequences = list(pack(items, Limits(64, 8, 14)))
    assert len(sequences) == 10 and all(len(s) == 2 for s in sequences)


def test_pieces_of_documents(docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["a", "boat", "winter", "!", "letters"]) for _ in range(
        rng.choice([0, 1, 20, 500, 9000])))) for i in range(150)]
    rows += [(None, None), (3, rows[3][1])]
    frame = docs(rows).withColumn("start", F.lit("x")).withColumnRenamed("lang", "TEXT").repartition(3)
    library = Tokenizer.from_file(FILE)
    want = defaultdict(int)
    for key, text in rows:
        want[key, tuple([*library.encode(text or "", add_special_tokens=False).ids, 2])] += 1
    check(packing.packed(frame, FILE, 2).collect(), want)


def check(got, want):
    """Pieces of the documents ``want`` counts, by id and tokens; ids repeat only as copies."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        parts[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append(r)
    made = defaultdict(int)
    for key, pieces in parts.items():
        text = []
        copies = sum(n for (k, _), n in want.items() if k == key)
        for start, ids, total in sorted(pieces):
            text += [(start + j, t) for j, t in enumerate(ids)]
        text.sort()
        made[key, tuple(t for _, t in text[::copies])] += copies
        assert len(text) == copies * pieces[0][2]
    assert made == want
    padding = 0
    for rows in sequences.values():
        rows.sort(key=lambda r: r["offset"])
        total = 0
        for r in rows:
            assert r["offset"] == total
            total += r["length"]
        assert total <= 4096
        padding += 0 if total & total - 1 == 0 else 4096 - total
        assert rows[0]["padded_to"] == (total if total & total - 1 == 0 else 4096)
    assert padding == 0


def test_prompts_bear_no_loss(docs):
    frame = docs([(1, "an answer of some words"), (2, None)]).withColumn("prompt", F.lit("the question"))
    got = packing.packed(frame, FILE, 2, prompt_col="prompt").collect()
    library = Tokenizer.from_file(FILE)
    n = len(library.encode("the question", add_special_tokens=False).ids)
    for key in (1, 2):
        rows = [r for r in got if r["doc_id"] == key]
        assert sum(r["length"] - r["loss_tokens"] for r in rows) == n


def test_empty_table(docs):
    assert packing.packed(docs([]), FILE, 2).count() == 0
    with pytest.raises(ValueError):
        packing.packed(docs([]), FILE, 2, Limits(1000))


def test_query_on_the_table(spark, sf):
    from panelyard.llm.queries import QUERIES

    library = Tokenizer.from_file(FILE)
    got = QUERIES["op9_packing"](spark, sf).collect()
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
           for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    covered = defaultdict(int)
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        covered[r["doc_id"]] += r["length"]
    assert covered == {k: len(v) for k, v in ids.items()}
