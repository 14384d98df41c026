import datetime

import pytest
from pyspark.errors import StreamingQueryException

from panelyard.sources import pages
from panelyard.streaming import feed

SCHEMA = "event_id long, ts timestamp, kind string, value double"


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def totals_of(spark, root, lateness="3 days", after=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = feed.stream_parquet(spark, f"{root}/in/*", schema, files_per_batch=1)
    unique = feed.unique_within_watermark(stream, "event_id", "ts", lateness)
    totals = feed.chunk_totals(unique, "ts", "kind", "value")
    feed.write_changes(totals, f"{root}/out", f"{root}/state", after).awaitTermination()
    return {(str(r["chunk_start"]), r["tipo"]): (r["n_itens"], r["valor_total"])
            for r in feed.current_totals(spark, f"{root}/out").collect()}


def test_duplicates_late_rows_and_restart(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", "f1", [(1, at(2), "a", 1.0), (2, at(3), "a", 2.0), (3, at(9), "b", 4.0)])
    assert totals_of(spark, root) == {("2024-01-01", "a"): (2, 3.0), ("2024-01-08", "b"): (1, 4.0)}
    # A restart on the same checkpoint reads only what is new; the copies of 3
    # are dropped, and a row within the lateness is counted.
    land(spark, f"{root}/in", "f2", [(3, at(9), "b", 4.0), (3, at(9), "b", 4.0), (4, at(8), "b", 8.0)])
    assert totals_of(spark, root) == {("2024-01-01", "a"): (2, 3.0), ("2024-01-08", "b"): (2, 12.0)}
    # Far behind the watermark: too late for the window, which is closed.
    land(spark, f"{root}/in", "f3", [(5, at(25), "b", 1.0)])
    totals_of(spark, root)
    land(spark, f"{root}/in", "f4", [(6, at(2), "a", 99.0)])
    done = totals_of(spark, root)
    assert done[("2024-01-01", "a")] == (2, 3.0) and done[("2024-01-22", "b")] == (1, 1.0)


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, at(1 + i % 28, i % 24), "ab"[i % 2], float(i)) for i in range(200)]
    land(spark, f"{tmp_path}/in", "f1", rows[:120])
    land(spark, f"{tmp_path}/in", "f2", rows[120:])
    batch = feed.chunk_totals(spark.createDataFrame(rows, SCHEMA), "ts", "kind", "value")
    expected = {(str(r["chunk_start"]), r["tipo"]): (r["n_itens"], r["valor_total"])
                for r in batch.collect()}
    assert totals_of(spark, str(tmp_path), "60 days") == expected


def test_pages_as_a_stream(spark, tmp_path):
    folder = tmp_path / "in" / "chunk_start=2024-01-01" / "page=1"
    folder.mkdir(parents=True)
    (folder / "p.json").write_text('{"resultado": [{"id": 1}, {"id": 2}], "paginasRestantes": 0}')
    stream = pages.stream_pages(spark, f"{tmp_path}/in", pages.text_record(["id"]))
    rows = pages.page_rows(stream)
    feed.land_stream(rows, f"{tmp_path}/raw", f"{tmp_path}/state").awaitTermination()
    made = spark.read.parquet(f"{tmp_path}/raw").orderBy("position").collect()
    assert [(str(r["chunk_start"]), r["page"], r["id"]) for r in made] == [
        ("2024-01-01", 1, "1"), ("2024-01-01", 1, "2")]


def test_landing_a_stream_is_exactly_once(spark, tmp_path):
    root = str(tmp_path)
    schema = spark.createDataFrame([], SCHEMA).schema
    for name, ids in (("f1", (1, 2)), ("f2", (3,))):
        land(spark, f"{root}/in", name, [(i, at(2), "a", 1.0) for i in ids])
        stream = feed.stream_parquet(spark, f"{root}/in/*", schema)
        feed.land_stream(stream, f"{root}/raw", f"{root}/state").awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{root}/raw").collect()) == [1, 2, 3]


def die(epoch):
    raise RuntimeError("stopped inside a batch")


def test_a_batch_that_is_repeated_after_a_compaction_loses_nothing(spark, tmp_path):
    root = str(tmp_path)
    days = {"f1": 2, "f2": 9, "f3": 16, "f4": 23}
    for n, (name, day) in enumerate(days.items()):
        land(spark, f"{root}/in", name, [(n, at(day), "a", 1.0)])
        # Written and not committed; compacted twice; then the batch comes once more.
        with pytest.raises(StreamingQueryException):
            totals_of(spark, root, "60 days", die)
        for _ in range(2):
            feed.compact(spark, f"{root}/out")
        found = totals_of(spark, root, "60 days")
        assert len(found) == n + 1 and set(found.values()) == {(1, 1.0)}
    # Changes that a base has taken in go, those since the last base stay.
    changes = feed.Changes(spark, f"{root}/out")
    assert len(changes.finished("base")) <= 2 and len(changes.finished("changes")) <= 4
    rows = [(n, at(day), "a", 1.0) for n, day in enumerate(days.values())]
    batch = feed.chunk_totals(spark.createDataFrame(rows, SCHEMA), "ts", "kind", "value")
    assert sorted(map(tuple, batch.collect())) == sorted(
        tuple(r) for r in feed.current_totals(spark, f"{root}/out").collect())


def test_a_base_without_its_marker_does_not_count(spark, tmp_path):
    table = f"{tmp_path}/t"
    changes = feed.Changes(spark, table)
    row = "chunk_start string, tipo string, n long"
    for epoch, rows in enumerate([[("c1", "a", 1)], [("c1", "a", 2), ("c2", "a", 5)], [("c3", "a", 7)]]):
        changes.write_batch(spark.createDataFrame(rows, row), epoch)
    want = [("c1", "a", 2), ("c2", "a", 5), ("c3", "a", 7)]
    now = lambda: sorted(tuple(r) for r in feed.current_rows(spark, table).collect())
    # A compaction that died while it wrote, and a batch that did.
    spark.createDataFrame([("c1", "a", 99)], row).write.parquet(f"{table}/base/generation=1")
    spark.createDataFrame([("c1", "a", 98)], row).write.parquet(f"{table}/changes/epoch=3")
    assert now() == want
    feed.compact(spark, table)
    assert now() == want and changes.finished("base") == [1]
    changes.write_batch(spark.createDataFrame([("c1", "a", 97)], row), 2)  # finished: left as it is
    changes.write_batch(spark.createDataFrame([("c1", "a", 96)], row), 0)  # in the base: likewise
    assert now() == want
    changes.write_batch(spark.createDataFrame([("c1", "a", 3)], row), 3)
    feed.compact(spark, table)
    assert now() == [("c1", "a", 3), *want[1:]]


def test_a_table_goes_with_one_checkpoint(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", "f1", [(1, at(2), "a", 1.0)])
    totals_of(spark, root)
    totals = feed.chunk_totals(feed.stream_parquet(
        spark, f"{root}/in/*", spark.createDataFrame([], SCHEMA).schema).withWatermark("ts", "1 day"), "ts", "kind", "value")
    with pytest.raises(ValueError, match="new"):
        feed.write_changes(totals, f"{root}/out", f"{root}/other")
    with pytest.raises(FileNotFoundError):
        feed.current_totals(spark, f"{root}/nothing")


def test_first_copies_however_late(spark, tmp_path):
    root = str(tmp_path)
    schema = "id string, run int, v string"
    parts = [[("a", 2, "a2"), ("b", 3, "b3"), (None, 2, "n2")], [("a", 3, "a3"), ("b", 1, "b1")],
             [("a", 1, "a1"), ("c", 9, None), (None, 5, "n5")]]
    for n, rows in enumerate(parts):
        frame = spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.parquet(f"{root}/in/{n}")
        first = feed.first_copies(feed.stream_parquet(spark, f"{root}/in/*", frame.schema), ["id"], ["run"])
        feed.write_changes(first, f"{root}/out", f"{root}/state").awaitTermination()
        feed.compact(spark, f"{root}/out", ["id"])
    kept = feed.current_rows(spark, f"{root}/out", ["id"]).select("id", "run", "v").collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        [("a", 1, "a1"), ("b", 1, "b1"), (None, 2, "n2"), ("c", 9, None)], key=str)


def test_late_rows_are_counted_and_kept(spark, tmp_path):
    root, schema = str(tmp_path), spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = feed.stream_parquet(spark, f"{root}/in/*", schema)
        feed.write_counted(stream, "ts", "kind", "value", f"{root}/out", f"{root}/state",
                           datetime.timedelta(days=3), sum_scale=2).awaitTermination()
        return sorted((str(r["chunk_start"]), r["tipo"], r["n_itens"], r["valor_total"], r["n_atrasados"])
                      for r in feed.counted_totals(spark, f"{root}/out").collect())

    land(spark, f"{root}/in", "f1", [(1, at(2), "a", 1.0), (2, at(9), "a", 2.0)])
    land(spark, f"{root}/in", "f2", [(3, at(25), "a", None), (4, None, "a", 1.0)])
    assert run() == [("2024-01-01", "a", 1, 1.0, 0), ("2024-01-08", "a", 1, 2.0, 0),
                     ("2024-01-22", "a", 1, 0.0, 0), ("None", "a", 1, 1.0, 0)]
    # The newest moment was the 25th: chunks that ended by the 22nd are over.
    land(spark, f"{root}/in", "f3", [(5, at(3), "a", 4.0), (6, at(16), "b", 8.0), (7, at(23), "a", 1.0)])
    assert run()[:3] == [("2024-01-01", "a", 2, 5.0, 1), ("2024-01-08", "a", 1, 2.0, 0), ("2024-01-15", "b", 1, 8.0, 1)]
    feed.compact_counted(spark, f"{root}/out")
    land(spark, f"{root}/in", "f4", [(8, at(3), "a", 1.0)])
    assert run()[0] == ("2024-01-01", "a", 3, 6.0, 2)
    feed.compact_counted(spark, f"{root}/out")
    assert run()[0] == ("2024-01-01", "a", 3, 6.0, 2)
    assert sorted(r["event_id"] for r in feed.late_rows(spark, f"{root}/out").collect()) == [5, 6, 8]
