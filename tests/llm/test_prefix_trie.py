import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelyard.llm import prefix_trie


def trie(frame, together=prefix_trie.TOGETHER):
    conv = F.col("conv_id")
    return prefix_trie.trie(frame, conv - conv % 5, F.crc32(conv.cast("string")) % 9, 8, together)


def brute_force(rows):
    """The nodes of the contract from (conv_id, turn, role, text) rows, prefix by prefix."""
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                         key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = tuple(own.get(conv - conv % 5, [])[:h] + turns[h:])
    members, children = {}, {}
    for conv in sorted(rebuilt):
        for d in range(len(rebuilt[conv]) + 1):
            members.setdefault(rebuilt[conv][:d], []).append(conv)
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved, out = {}, {}, []
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[p] for p in below) or 1
        each = len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = (len(members[prefix]) - 1) * each + sum(saved[p] for p in below)
        ends = ",".join(str(c) for c in members[prefix] if len(rebuilt[c]) == len(prefix))
        out.append((members[prefix][0], len(prefix), members[prefix[:-1]][0] if prefix else None,
                    len(members[prefix]), len(below), leaves[prefix], saved[prefix],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def conversations(seed, n=45):
    """Shared starts, copies, one very long conversation, null turns, roles and texts."""
    rng, rows = random.Random(seed), []
    for conv in rng.sample(range(120), n):
        start = rng.choice([[1, 2, 3], [1, 2], [4] * 3, [], [5] * 70])
        turns = start + [rng.randint(0, 3) for _ in range(rng.choice([0, 0, 1, 5, 40]))] or [9]
        turns = turns * 3 if conv == 60 else turns
        for k, x in enumerate(turns):
            rows.append((conv, None if k == 0 and rng.random() < 0.3 else k,
                         "user" if rng.random() < 0.95 else None, f"tü{x}" if x != 2 else None))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("together", [1, 9, prefix_trie.TOGETHER])
def test_trie_like_brute_force(spark, together, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 16)
    monkeypatch.setattr(prefix_trie, "LISTED_IDS", 3)
    rows = conversations(together)
    found = trie(table(spark, rows), together)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows)


@pytest.mark.parametrize("seed", range(5))
def test_sums_of_any_forest(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n = rng.randint(1, 80)
        parent = [-1 if i == 0 or rng.random() < 0.05 else i - 1 if rng.random() < 0.6 else rng.randrange(i)
                  for i in range(n)]
        values = [rng.randint(-9, 99) for _ in range(n)]
        size, sums = [1] * n, list(values)
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                size[parent[i]] += size[i]
                sums[parent[i]] += sums[i]
        new = rng.sample(range(n), n)  # node i is put at new[i]
        moved = np.empty((3, n), np.int64)
        for i in range(n):
            moved[:, new[i]] = (-1 if parent[i] < 0 else new[parent[i]]), size[i], values[i]
        [got] = prefix_trie.subtree_sums(moved[0], moved[1], [moved[2]])
        assert [int(got[new[i]]) for i in range(n)] == sums


def test_a_chain_and_a_star_take_few_rounds(spark):
    rows = [(1000, k, "user", "same") for k in range(400)] + [
        (c * 5, k, "user", f"{c if k else 0}") for c in range(1, 150) for k in range(2)]
    found = trie(table(spark, rows), 20)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows)


def test_edges(spark):
    rows = [(None, 1, "user", "x"), (3, 1, None, None), (3, 1, None, None), (7, None, "user", ""), (8, 1, "", "")]
    frame = table(spark, rows).withColumn("depth", F.lit("x")).withColumn("owner", F.lit(1)) \
        .withColumn("p1", F.lit(2.5))
    frame = frame.toDF("conv_id", "turn", "role", "text", "depth", "owner", "Conv_Id")  # differs in case only
    found = sorted(tuple(r) for r in trie(frame).collect())
    assert found == brute_force(rows)
    assert trie(table(spark, rows[:1])).collect() == []
    assert trie(table(spark, [])).collect() == []


def test_equal_turns_in_a_fixed_order(spark):
    rows = [(5, 1, "user", t) for t in "abcdefgh"]
    first, second = (sorted(map(str, prefix_trie.ordered_turns(table(spark, r)).collect())) for r in (rows, rows[::-1]))
    assert first == second


def test_query_like_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    found = entry.queries()["op12_prefix_trie"](spark, sf)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                             "saved_tokens", "ends_sha256"]
    assert set(dict(found.dtypes).values()) == {"bigint", "string"}
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows)
