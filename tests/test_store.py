"""The committed store: no lost, repeated or half-written rows."""

import pytest
from pyspark.sql import functions as F

from logvigil.operators import index as I
from logvigil.sources import io
from logvigil.sources.store import Store, bucket

SCHEMA = "doc_id long, day string, llm_response string, llm_matched boolean"


@pytest.fixture
def store(spark, tmp_path):
    out = Store(spark, f"{tmp_path}/events", spark.createDataFrame([], SCHEMA).schema, F.col("day"))
    out.append(rows(spark, [(1, "2026-01-01"), (2, "2026-01-02"), (3, None)]), "first")
    return out


def rows(spark, cells):
    return spark.createDataFrame([(i, d, None, False) for i, d in cells], SCHEMA)


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def files(df):
    return {r.f for r in df.select(F.input_file_name().alias("f")).collect()}


def test_a_transaction_is_written_once(spark, store):
    for _ in range(2):
        store.append(rows(spark, [(4, "2026-01-01")]), "second")
    assert store.append(rows(spark, []), "nothing") == 0 and store.has("nothing")
    assert ids(store.read()) == [1, 2, 3, 4] and ids(store.read(["2026-01-01"])) == [1, 4] and ids(store.read(["2020-01-01"])) == []


def test_rows_without_a_commit_are_not_read(spark, store):
    store._write(rows(spark, [(9, "2026-01-01")]))  # the writer is lost before its commit
    assert ids(store.read()) == [1, 2, 3]
    store.append(rows(spark, [(9, "2026-01-01")]), "again")
    assert ids(store.read()) == [1, 2, 3, 9]


def test_merge_rewrites_touched_parts_only(spark, store):
    before = {d: files(store.read([d])) for d in ("2026-01-01", "2026-01-02", "none")}
    results = spark.createDataFrame([(1, 10, 1, "bad"), (1, 11, 2, "worse"), (3, 10, 3, "null day"), (None, 10, 4, "no match"), (77, 10, 5, "unknown")], "matched_doc long, t long, ask_id long, llm_response string")
    for _ in range(2):  # a repeated merge does nothing
        cells = I.merge_stored(store, results, "merge", fields=("llm_response",))
    assert {p for _, p in cells} == {"2026-01-01", "none"}
    assert {(r.doc_id, r.llm_response, r.llm_matched) for r in store.read().collect()} == {(1, "worse", True), (2, None, False), (3, "null day", True)}
    assert files(store.read(["2026-01-02"])) == before["2026-01-02"] and not files(store.read(["2026-01-01"])) & before["2026-01-01"]


def test_appends_during_a_merge_are_kept(spark, store):
    cells = store.touched(spark.createDataFrame([(1,)], "doc_id long"), "doc_id")
    store.append(rows(spark, [(5, "2026-01-01")]), "meanwhile")
    store.rewrite(cells, lambda d: d.withColumn("llm_matched", F.lit(True)), "merge")
    assert {(r.doc_id, r.llm_matched) for r in store.read(["2026-01-01"]).collect()} == {(1, True), (5, False)}


def test_compaction_bounds_the_files(spark, store):
    for i in range(12):
        store.append(rows(spark, [(100 + i, "2026-01-01"), (200 + i, "2026-01-02")]), f"t{i}")
        if i % 4 == 3:
            store.compact(least=4)
    assert store.live().count() <= 4 and len(files(store.read())) <= 4
    assert ids(store.read()) == [1, 2, 3, *range(100, 112), *range(200, 212)]


def test_streams_under_several_checkpoints(spark, tmp_path):
    seen = []
    for name, cells in (("a", [(1, "x"), (2, None)]), ("b", [(3, "y")])):
        spark.createDataFrame(cells, "doc_id long, day string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        e = spark.readStream.schema("doc_id long, day string").parquet(f"{tmp_path}/in")
        for checkpoint in ("one", f"two-{name}"):
            io.index_append(e, f"{tmp_path}/store", f"{tmp_path}/{checkpoint}", F.col("day"), required=("day",), available_now=True, on_batch=lambda i, n, bad: seen.append((n, bad))).awaitTermination()
    store = io.event_store(spark, f"{tmp_path}/store", e.schema, F.col("day"))
    assert ids(store.read()) == [1, 1, 1, 3, 3]  # checkpoint one: 1 and 3; two-a: 1; two-b: 1 and 3
    assert sum(n for n, _ in seen) == 5 and sum(b for _, b in seen) == 3


def test_buckets_read_are_those_of_the_ids(spark, tmp_path):
    schema = spark.createDataFrame([], "doc_id long").schema
    store = Store(spark, f"{tmp_path}/sent", schema, bucket("doc_id", 16))
    store.append(spark.range(1000).toDF("doc_id"), "many")
    asked = [str(r.b) for r in spark.createDataFrame([(5,)], "doc_id long").select(bucket("doc_id", 16).alias("b")).collect()]
    assert 5 in ids(store.read(asked)) and len(ids(store.read(asked))) < 150
