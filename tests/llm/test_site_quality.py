import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelyard.llm import site_quality as sq

GOOD = "the river and the town were quiet in the morning and a boat came from the north with letters"
BAD = "BUY!! NOW!! $$$ ### *** BUY!! NOW!! $$$ ### *** BUY!! NOW!! 99 99"


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, host string, path string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_priors_by_hand(spark):
    # One class of text, so that the classifier says nothing about single documents.
    rows, known = [], []
    key = 0
    for host, path, good, n in [("a", "a/1", 9, 10), ("a", "a/2", 2, 10), ("b", "b/1", 1, 12), ("c", "c/1", 1, 1)]:
        for i in range(n):
            rows.append((key, "same text", host, path))
            known.append((key, int(i < good)))
            key += 1
    rows += [(900, "same text", "a", "a/new"), (901, "same text", None, None), (902, "same text", "new", "new/1"),
             (903, "same text", "b", None)]
    got = {r["doc_id"]: r for r in sq.scored(table(spark, rows), labels(spark, known), "host", "path").collect()}
    good, n = sum(x for _, x in known), len(known)
    share = good / n
    hosts = {"a": (11, 20), "b": (1, 12), "c": (1, 1)}

    def strength(groups):
        d = sum(m * (g / m - t) ** 2 for g, m, t in groups)
        c = sum(t * (1 - t) for *_, t in groups)
        total = sum(m for _, m, _ in groups)
        w = sum(m * t * (1 - t) for _, m, t in groups)
        spread = (d - c) / total
        return 1e6 if spread <= 0 else min(1e6, max(1, w / total / spread - 1))

    mh = strength([(g, m, share) for g, m in hosts.values()])
    mean = {h: (g + mh * share) / (m + mh) for h, (g, m) in hosts.items()}
    mp = strength([(9, 10, mean["a"]), (2, 10, mean["a"]), (1, 12, mean["b"]), (1, 1, mean["c"])])
    assert got[900]["host_share"] == pytest.approx(mean["a"]) == pytest.approx(got[900]["path_share"])
    assert got[901]["path_share"] == pytest.approx(share) == pytest.approx(got[902]["path_share"])
    assert got[903]["path_share"] == pytest.approx(mean["b"])
    # Document 0 is good: without its own label.
    host = (11 - 1 + mh * share) / (20 - 1 + mh)
    assert got[0]["path_share"] == pytest.approx((9 - 1 + mp * host) / (10 - 1 + mp))
    assert all(abs(r["evidence"]) < 1e-6 for r in got.values())
    assert got[0]["p_quality"] == pytest.approx(got[0]["path_share"], abs=1e-6)


def test_evidence_and_cases(spark):
    rows = [(i, f"{GOOD} number{i}" if i % 2 else f"{BAD} {i}", "h", "h/p") for i in range(80)]
    rows += [(100, None, None, None), (101, "", "h", None), (102, GOOD, "z", "z/1"), (102, GOOD, "z", "z/1"),
             (None, BAD, "h", "h/p"), (103, GOOD * 2000, "h", "h/p")]
    known = [(i, i % 2) for i in range(60)] + [(0, 0), (None, 1), (5000, 1), (7, None)]
    odd = table(spark, rows).withColumn("label", F.lit("x")).withColumn("h", F.lit(1)).withColumn("evidence", F.lit(1))
    got = sq.scored(odd, labels(spark, known), "host", "path").collect()
    assert len(got) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[i] == bool(i % 2) for i in range(80))
    assert kept[102] and not kept[None]
    assert all(0 <= r["p_quality"] <= 1 for r in got)
    assert sq.scored(table(spark, []), labels(spark, known), "host", "path").count() == 0
    none = sq.scored(odd, labels(spark, []), "host", "path").collect()
    assert {round(r["p_quality"], 6) for r in none} == {0.5}


def test_features_by_hand():
    texts = [None, "", "Ab 1! the|the\nx", "a b c a b c"]
    found = sq.features_of(pa.array(texts))
    row = dict(zip(sq.FEATURES, found[2]))
    assert row["words"] == pytest.approx(np.log1p(4)) and row["bars"] == 1 / 4 and row["exclamations"] == 1 / 4
    assert row["digits"] == 1 / 4 and row["capitals"] == 1 / 15 and row["lines"] == 1 / 4
    assert dict(zip(sq.FEATURES, found[3]))["repeated_windows"] == pytest.approx(1 - 3 / 4)
    assert dict(zip(sq.FEATURES, found[3]))["distinct_words"] == 0.5
    assert np.isfinite(found).all()


def test_held_out_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("path", F.concat_ws("/", "source", "lang"))
    known = spark.read.parquet(f"{sf}/labels.parquet")
    half = known.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    got = {r["doc_id"]: r["kept"] for r in sq.scored(docs, half, "source", "path").collect()}
    rest = known.exceptAll(half).join(docs.where("n_chars > 300"), "doc_id", "left_semi").collect()
    right = sum(got[r["doc_id"]] == bool(r["quality"]) for r in rest)
    assert right / len(rest) >= 0.9
