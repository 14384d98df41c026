import hashlib
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from panelyard.llm import periodic_runs as runs


def brute_force(words, min_length=12):
    """(start, length, period) of all runs, by start and period, period by period."""
    found = set()
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if j > i and length >= max(min_length, 2 * p):
                own = words[i:j + p]
                if all(any(own[k] != own[k + q] for k in range(length - q)) for q in range(1, p)):
                    found.add((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_runs(texts, min_length=12):
    flat = np.array([w for words in texts for w in words], np.int64)
    got = runs.find_runs(flat, np.array([len(t) for t in texts], np.int64), min_length)
    by_text = [[] for _ in texts]
    for text, *run in zip(got.text.tolist(), got.start.tolist(), got.length.tolist(), got.period.tolist()):
        by_text[text].append(tuple(run))
    return by_text


def random_texts(seed, n=600):
    rng, out = random.Random(seed), []
    for _ in range(n):
        size, kinds = rng.choice([0, 1, 11, 12, 13, 40, 90, 200]), rng.choice([1, 2, 3, 12])
        words = [rng.randint(1, kinds) for _ in range(size)]
        if size and rng.random() < 0.6:  # a planted period
            start = rng.randrange(size)
            period = rng.randint(1, 1 + (size - start) // rng.randint(1, 6))
            words[start:] = [words[start + k % period] for k in range(size - start)]
        if rng.random() < 0.4:
            words = [rng.randint(1, 60) for _ in range(rng.randint(0, 30))] + words * rng.randint(1, 3)
        out.append(words)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_like_brute_force(seed):
    texts = random_texts(seed)
    assert found_runs(texts) == [brute_force(t) for t in texts]


@pytest.mark.parametrize("min_length", [2, 3, 25])
def test_other_least_lengths(min_length):
    texts = random_texts(9, 200)
    assert found_runs(texts, min_length) == [brute_force(t, min_length) for t in texts]


def test_grid_in_small_slices(monkeypatch):
    monkeypatch.setattr(runs, "POINTS", 50)
    texts = random_texts(4, 100)
    assert found_runs(texts) == [brute_force(t) for t in texts]


def test_long_texts():
    block = list(range(1, 1501))
    assert found_runs([block * 40 + [1, 2, 9]]) == [[(0, 60002, 1500)]]
    assert found_runs([[7] * 100_000, [], [7] * 11]) == [[(0, 100_000, 1)], [], []]


def test_extensions_like_comparing_words():
    rng = random.Random(6)
    words = np.array([rng.choice([1, 2]) if k % 300 < 200 else 1 for k in range(1500)])
    words[500:900] = words[100:500]
    spaced = np.append(words, 0)
    left = np.array([rng.randrange(1400) for _ in range(4000)])
    right = np.array([rng.randrange(a + 1, 1500) for a in left])
    got = runs.Extensions(spaced, np.array([0])).of(left, right)
    for a, b, n in zip(left, right, got):
        assert (words[a:a + n] == words[b:b + n]).all()
        assert b + n == 1500 or words[a + n] != words[b + n]


def test_every_distance_reaches_samples():
    for a in range(runs.V):
        for b in range(runs.V):
            shift = runs.SHIFTS[a, b]
            assert shift < runs.V and {(a + shift) % runs.V, (b + shift) % runs.V} <= set(runs.COVER.tolist())


def test_edges_of_the_operator(spark, docs):
    song = "la " * 12
    frame = docs([(1, None), (2, " \n\t"), (3, song), (3, song), (None, song + "end"), (4, "a\x1cb")])
    frame = frame.withColumnRenamed("lang", "runs")
    rows = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed)
                   for r in runs.periodic_runs(frame).collect()), key=str)
    assert rows == sorted([(1, [], ""), (2, [], ""), (3, [(0, 12, 1)], "la"), (3, [(0, 12, 1)], "la"),
                           (None, [(0, 12, 1)], "la end"), (4, [], "a\x1cb")], key=str)
    assert runs.periodic_runs(frame.limit(0)).collect() == []


def test_query_like_brute_force(spark, sf):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found = {r.doc_id: r for r in entry.queries()["op13_periodic_runs"](spark, sf).collect()}
    table = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(table)
    planted = 0
    for row in table:
        words = (row.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if n > 3000:
            continue  # too long for the brute force
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        want, got = brute_force(words), found[row.doc_id]
        best = max(want, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        assert (got.n_runs, got.start, got.length, got.period) == (len(want), *best)
        assert got.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert got.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in want))
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        assert got.collapsed_sha256 == sha(b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    assert planted > 10
