import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelyard.llm.exact_dedup import FILE_MANAGER, ExactDedup, checkpoint_files, deduplicated


def by_hand(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = []
    for text, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(k, keep, len(keys), digest) for k in keys]
    return sorted(out, key=repr)


ROWS = [(1, "a b"), (2, "a  b"), (3, "a\n\tb"), (4, "ab"), (5, None), (6, ""), (7, " "), (8, "\n"), (9, "a b "),
        (None, "a b"), (None, "only"), (None, "only"), (4, "ab"), (10, "é" * 50_000), (11, "é" * 50_000),
        (12, "a\xa0b"), (13, "A b")]


@pytest.mark.parametrize("cut", [64, 1, 0])
def test_brute_force_also_with_colliding_digests(docs, spark, tmp_path, cut):
    rng = random.Random(2)
    rows = ROWS + [(100 + i, rng.choice("xyz") * rng.randint(1, 3)) for i in range(60)]
    weak = (lambda t: F.substring(F.sha2(F.encode(t, "UTF-8"), 256), 1, cut)) if cut else (lambda t: F.lit("same"))
    dedup = ExactDedup(spark, str(tmp_path / "d"), digest=weak)
    source = dedup.copied(docs(rows).repartition(3))
    dedup.add(source)
    got = dedup.decisions(source).collect()
    want = by_hand(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"]) for r in got], key=repr) == \
        sorted([w[:3] for w in want], key=repr)
    if cut == 64:
        assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["digest"]) for r in got], key=repr) == want
    assert sum(r["kept"] for r in got) == len({(w[1], w[3]) for w in want})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    left = [r["text"] for r in dedup.survivors(source).collect()]
    assert len(left) == sum(r["kept"] for r in got)


def test_state_goes_on_over_restarts(docs, spark, tmp_path):
    folder = str(tmp_path / "d")
    for part in ([(5, "x"), (6, "y")], [(3, "x"), (7, "z")], [(9, "y"), (1, "w")]):
        dedup = ExactDedup(spark, folder)
        path = f"{tmp_path}/in/{part[0][0]}"
        docs(part).write.parquet(path)
        dedup.add(spark.read.parquet(path))
    every = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in ExactDedup(spark, folder).decisions(every).collect())
    assert got == [(1, 1, 1), (3, 3, 2), (5, 3, 2), (6, 6, 2), (7, 7, 1), (9, 6, 2)]
    assert ExactDedup(spark, folder).state().count() == 4


def test_empty_table_and_clashing_names(docs, spark, tmp_path):
    assert deduplicated(docs([]), str(tmp_path / "a")).count() == 0
    odd = docs([(1, "a"), (2, "a")]).withColumn("digest", F.lit(1)).withColumn("file", F.lit(2)) \
        .withColumn("n", F.lit(0)).withColumn("keep_id", F.lit(0)).withColumn("_metadata", F.lit(1))
    odd.write.parquet(str(tmp_path / "odd"))
    read = spark.read.parquet(str(tmp_path / "odd"))
    got = deduplicated(read, str(tmp_path / "b"), files=True)
    assert sorted((r["doc_id"], r["kept"]) for r in got.collect()) == [(1, True), (2, False)]
    dedup = ExactDedup(spark, str(tmp_path / "c"))
    dedup.add(read)
    assert dedup.survivors(read).columns == odd.columns and dedup.survivors(read).count() == 1


def test_tables_that_are_not_files_are_copied(docs, spark, tmp_path):
    made = docs([(1, "a"), (2, "a"), (3, "b")]).withColumn("c0", F.lit("x"))
    dedup = ExactDedup(spark, str(tmp_path / "d"))
    source = dedup.scanned(made)
    assert source.columns == made.columns
    dedup.add(source)
    assert sorted(r["doc_id"] for r in dedup.survivors(source).collect()) == [1, 3]
    made.write.parquet(str(tmp_path / "files"))
    read = spark.read.parquet(str(tmp_path / "files"))
    assert dedup.scanned(read) is read


def test_query_plan_has_no_python(spark, sf):
    from panelyard.llm.queries import QUERIES

    plan = QUERIES["op3_exact_dedup"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_state_on_a_local_disk_starts_no_processes(docs, spark, tmp_path):
    with checkpoint_files(spark, str(tmp_path)):
        assert spark.conf.get(FILE_MANAGER).endswith("FileSystemBasedCheckpointFileManager")
    assert spark.conf.get(FILE_MANAGER, None) is None
    dedup = ExactDedup(spark, str(tmp_path / "d"))
    dedup.add(dedup.copied(docs([(2, "a"), (1, "a"), (3, "b")])))
    assert spark.conf.get(FILE_MANAGER, None) is None
    assert sorted((r["keep_id"], r["n"]) for r in dedup.state().collect()) == [(1, 2), (3, 1)]
