import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelyard.llm import components, gram_counts, jaccard_join, wordhash


def grams(text, size=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def by_hand(rows, per_cent=90, size=3):
    sets = [grams(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)), key=repr)


def result(frame, **settings):
    return sorted((tuple(r)[:3] for r in jaccard_join.join(frame, **settings).collect()), key=repr)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 5)}"
        out.append(" ".join(words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "one", "One", "two words", "two  WORDS", "a b c", "a b c d", "A\tb c", "é É", "É É"]
    for length, n, edits in [(60, 25, 3), (120, 15, 8), (12, 10, 1), (300, 10, 12)]:
        base = [f"w{rng.randint(0, 400)}" for _ in range(length)]
        texts += near_copies(rng, base, n, edits)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} u{i} v{i}" for i in range(8)] + [f"{passage} {passage} k{i % 2}" for i in range(6)]
    texts += [" ".join(f"r{rng.randint(0, 9)}" for _ in range(rng.randint(1, 40))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,settings", [(1, {}), (2, {"batch_bytes": 500}), (3, {"per_cent": 60, "batch_bytes": 2000}),
                                           (4, {"per_cent": 100}), (5, {"per_cent": 80, "size": 5})])
def test_brute_force(docs, seed, settings):
    rows = corpus(seed)
    batch = settings.pop("batch_bytes", 1 << 20)
    assert result(docs(rows).repartition(3), batch_bytes=batch, **settings) == by_hand(rows, **settings)


def test_ties_nulls_and_clashing_names(docs):
    rows = [(None, "a b c d"), (None, "q r s t"), (4, "a b c d"), (4, "a b c d"), (2, "z y x w v"), (2, "other text here")]
    odd = docs(rows).withColumn("batch", F.lit(1)).withColumn("n", F.lit("x")).withColumn("component_id", F.lit(0)) \
        .withColumnRenamed("lang", "DOC_ID")
    assert result(odd) == by_hand(rows)
    assert result(docs([])) == []
    assert result(docs([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_component_stays(docs):
    rows = corpus(6) + [(None, "a b c d e f"), (None, "a b c d e  f"), (77, "a b c d e f"), (3, "same id other text")]
    odd = docs(rows).withColumn("_id", F.lit(1)).withColumn("_hash", F.lit(1)).withColumn("stays", F.lit(False))
    left = jaccard_join.representatives(odd, per_cent=80, size=5)
    assert left.columns == odd.columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr)
    root = {i: r for i, _, r in by_hand([(i, t) for i, (_, t) in enumerate(rows)], 80, 5)}
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root[i], []).append(row)
    assert len(got) == len(groups)
    for members in groups.values():
        [kept] = [m for m in members if m in got]
        ids = [k for k, _ in members if k is not None]
        assert kept[0] == (min(ids) if ids else None)


def test_a_large_group_of_near_copies_makes_few_pairs(docs, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = list(enumerate(near_copies(rng, base, 400, 2)))
    made = []
    linked = jaccard_join._Search.linked
    monkeypatch.setattr(jaccard_join._Search, "linked",
                        lambda self, pairs: made.append(pairs.count()) or linked(self, pairs))
    assert result(docs(rows)) == by_hand(rows)
    assert sum(made) < 400 * 20


def test_near_copies_in_many_blocks_make_few_pairs(docs, monkeypatch):
    # So unlike that their prefixes fall into many blocks, each of which had a pivot of its own.
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = list(enumerate(near_copies(rng, base, 600, 12)[120:]))
    made = []
    linked = jaccard_join._Search.linked
    monkeypatch.setattr(jaccard_join._Search, "linked",
                        lambda self, pairs: made.append(pairs.count()) or linked(self, pairs))
    assert result(docs(rows), per_cent=80, size=5) == by_hand(rows, 80, 5)
    assert sum(made) < 480 * 4, made


def links_by_hand(rows, per_cent=90, size=3):
    """By document, with how many others it is linked; rows with equal ids and texts are one."""
    kinds = list(dict.fromkeys(rows))
    sets = [grams(t, size) for _, t in kinds]
    found = dict.fromkeys(range(len(kinds)), 0)
    for i, j in combinations(range(len(kinds)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
            found[i] += 1
            found[j] += 1
    of = {kind: found[i] for i, kind in enumerate(kinds)}
    return sorted(((k, of[k, t]) for k, t in rows), key=repr)


@pytest.mark.parametrize("seed,settings", [(1, {}), (2, {"batch_bytes": 500}), (3, {"per_cent": 60}),
                                           (4, {"per_cent": 100}), (5, {"per_cent": 80, "size": 5})])
def test_every_link_is_counted(docs, monkeypatch, seed, settings):
    monkeypatch.setattr(jaccard_join, "SLICE_GROUPS", 2)
    rng = random.Random(seed)
    copies = near_copies(rng, [f"n{i}" for i in range(100)], 60, 4)
    rows = corpus(seed) + [(1000 + i, t) for i, t in enumerate(copies)]
    rows += [(None, copies[0]), (None, copies[0]), (1001, copies[1]), (1001, copies[2] + " end")]
    found = jaccard_join.with_links(docs(rows).repartition(3), **settings).collect()
    known = {k: v for k, v in settings.items() if k != "batch_bytes"}
    assert sorted(((r["doc_id"], r["n_links"]) for r in found), key=repr) == links_by_hand(rows, **known)
    assert sorted((tuple(r)[:3] for r in found), key=repr) == by_hand(rows, **known)
    plain = jaccard_join.join(docs(rows), **settings).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(map(tuple, plain), key=repr)
    assert jaccard_join.with_links(docs([(1, None), (2, "")])).select("n_links").collect() == [(0,), (0,)]
    assert jaccard_join.with_links(docs([])).collect() == []


def test_the_query_verifies_pairs_that_are_connected_already(docs, spark, tmp_path, monkeypatch):
    from panelyard.llm.queries import QUERIES

    # Three texts that are linked with each other: one link more than connects them.
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(3)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    verified = []
    linked = jaccard_join._Search.linked
    monkeypatch.setattr(jaccard_join._Search, "linked",
                        lambda self, pairs: verified.append(linked(self, pairs).count()) or linked(self, pairs))
    got = sorted(tuple(r) for r in QUERIES["op7_jaccard_join"](spark, str(tmp_path)).collect())
    assert got == by_hand(rows)
    assert sum(verified) == 3


def test_n_grams_of_the_same_groups_are_one_block(docs, monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(30)]
    rows = list(enumerate(texts + [f"{t} end" for t in texts] + [f"alone {t[::-1]}" for t in texts]))
    seen = []
    components = jaccard_join._components
    monkeypatch.setattr(jaccard_join, "_components", lambda search: seen.append(search) or components(search))
    assert result(docs(rows)) == by_hand(rows)
    # One block a pair; an entry for each of its prefix n-grams would make some 20 times as many.
    assert seen[0].index.count() == 60
    assert seen[0].index.select("token").distinct().count() == 30


def test_very_long_text(docs):
    long = " ".join(f"w{i % 7919}{i % 13}" for i in range(150_000))
    rows = [(1, long), (2, long + " end"), (3, "short one")]
    got = result(docs(rows))
    assert [r[2] for r in got] == [1, 1, 3]


def test_word_hashes():
    texts = ["The  cat\tsat", None, "", "the cat SAT", "x\x0by\x0cz", "thecatsat", " lead", "trail ", "é É", "a\xa0b"]
    for column in (pa.array(texts), pa.array(["skip"] + texts).slice(1), pa.array(texts, pa.large_string())):
        hashes, counts = wordhash.word_hashes(column)
        assert counts.tolist() == [3, 0, 0, 3, 3, 1, 1, 1, 2, 1]
        assert hashes[:3].tolist() == hashes[3:6].tolist()
        assert len(set(hashes.tolist())) == 12
    words = [f"{a}{b}" for a in "abcdefghij" * 3 for b in range(3000)]
    hashes, _ = wordhash.word_hashes(pa.array([" ".join(words)]))
    assert len(set(hashes.tolist())) == len(set(words))


def test_packed_numbers():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.uint64), np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)),
                   np.array([5, 5, 2**64 - 1], np.uint64)):
        assert gram_counts.unpacked(gram_counts.packed(values)).tolist() == values.tolist()


@pytest.mark.parametrize("bits,n", [(64, 1), (64, 7), (20, 3)])
def test_counts_come_back_to_their_batches(docs, bits, n):
    rng = random.Random(n)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 30))))
            for i in range(60)]
    counting = gram_counts.Counting(n, bits, lambda t: wordhash.word_hashes(t.column("text").combine_chunks())[0])
    batches = docs(rows).selectExpr("doc_id as key", "text", "doc_id % 5 as batch")

    def totals(texts, answers):
        hashes, counts = wordhash.word_hashes(texts.column("text").combine_chunks())
        return pa.table({"key": np.repeat(texts.column("key").to_numpy(), counts),
                         "total": counting.totals(hashes, answers)})

    got = batches.groupBy("batch").cogroup(counting.repeated(batches).groupBy("batch")) \
        .applyInArrow(totals, "key long, total long").collect()
    words = [w for _, t in rows for w in t.split()]
    want = sorted((k, words.count(w)) for k, t in rows for w in t.split())
    assert sorted(map(tuple, got)) == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(400 + i, 401 + i) for i in range(40)]
    got = {r["node"]: r["root"] for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in list(parent)}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_the_table(spark, sf):
    from panelyard.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op7_jaccard_join"](spark, sf).collect()), key=repr)
    assert got == by_hand(rows)
