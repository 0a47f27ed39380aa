"""Bounded topics, positions with expiry, the sink of two outcomes, orders that are NULL, pages with empty lists."""

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import changes as C
from tidemark.plans.store import KeyedTable
from tidemark.session import work_dir
from tidemark.sources import checked_sink as B
from tidemark.sources import files, topics
from tidemark.streaming import drain as D
from tidemark.streaming import state as S


def broker(spark, messages):
    path = work_dir(spark, "broker")
    topics.land(spark.createDataFrame(messages, "topic string, position bigint, body string"), path, "topic", "position", per_file=40)
    return path


def test_runs_are_bounded_and_nothing_is_lost(spark):
    """Sparse positions, a topic shorter than a run, one that grows, one that comes later."""
    messages = [("a", i * 17, f"a{i}") for i in range(25)] + [("b", i, f"b{i}") for i in range(3)]
    path = broker(spark, messages)
    table, checkpoint, acks = KeyedTable(spark, work_dir(spark, "topics"), ["topic", "position"], buckets=2), work_dir(spark, "cp"), work_dir(spark, "acks")
    seen = 0
    for run in range(4):
        at = D.drain_topics(spark, path, "body string", table, checkpoint, "t", acks, max_per_topic=10)
        by = {r["topic"]: r["count"] for r in table.read().groupBy("topic").count().collect()}
        assert by["a"] - seen <= 10 and by["b"] == 3
        seen = by["a"]
        assert all(p <= at[k] for k, p in topics.read_acks(acks).items())
    assert at == {"a": 24 * 17, "b": 2}
    later = [("a", 1000, "late"), ("c", 0, "c0")]
    topics.land(spark.createDataFrame(later, "topic string, position bigint, body string"), path, "topic", "position", per_file=40)
    D.drain_topics(spark, path, "body string", table, checkpoint, "t", acks, max_per_topic=10)
    assert rows(table.read().drop("_deleted")) == sorted([*messages, *later], key=repr)


def test_message_without_position(spark):
    with pytest.raises(PySparkException, match="without topic or position"):
        broker(spark, [("a", None, "x")])


def test_last_of_batch_keeps_one_row_a_key():
    batch = pa.RecordBatch.from_pydict({"k": [1, 1, 2, None, None], "_time": [5, 7, 1, 2, 2], "_at": [5, 7, 1, 2, 2], "_position": [1, 0, 9, 4, 5]})
    out = pa.Table.from_batches(list(S._last_of_batch(["k"])([batch]))).to_pylist()
    assert sorted(((r["k"], r["_at"], r["_position"]) for r in out), key=repr) == [(1, 7, 0), (2, 1, 9), (None, 2, 5)]
    assert list(S._last_of_batch(["k"])([batch.slice(0, 0)])) == []


def test_last_of_batch_brings_batches_together():
    """One row a key over all batches of a task, and never more than the bound held at once."""
    batches = [pa.RecordBatch.from_pydict({"k": [1, 2], "_time": [i, -i], "_at": [i, -i], "_position": [i, i]}) for i in range(50)]
    out = pa.Table.from_batches(list(S._last_of_batch(["k"], most=10)(iter(batches)))).to_pylist()
    assert sorted((r["k"], r["_at"], r["_position"]) for r in out) == [(1, 49, 49), (2, 0, 0)]
    many = [pa.RecordBatch.from_pydict({"k": [2 * i, 2 * i + 1], "_time": [i, i], "_at": [i, i], "_position": [i, i]}) for i in range(50)]
    out = [b.num_rows for b in S._last_of_batch(["k"], most=10)(iter(many))]
    assert sum(out) == 100 and max(out) <= 10


def test_sink_shows_both_kinds_or_nothing(spark):
    path = work_dir(spark, "checked")
    data = spark.range(1000).repartition(8).withColumn("v", F.concat(F.lit("v"), "id"))
    with pytest.raises(PySparkException):
        B.write_checked(data, path, F.when(F.col("id") == 777, F.raise_error(F.lit("bad task")).cast("string")))
    assert B.commits(path) == []
    with pytest.raises(ValueError):
        B.read_checked(spark, path, "accepted")
    fs, root = topics._file_system(path)
    import pyarrow.fs as pf

    left = [i for i in fs.get_file_info(pf.FileSelector(root, recursive=True, allow_not_found=True)) if i.base_name.endswith(".parquet")]
    assert left == []
    B.write_checked(data, path, B.reasons({"even": F.col("id") % 2 == 0, "small": F.when(F.col("id") != 10, F.col("id") < 900)}))
    B.write_checked(data.limit(0), path, F.lit(None).cast("string"))
    good, bad = B.read_checked(spark, path, "accepted"), B.read_checked(spark, path, "rejected")
    assert good.columns == ["id", "v"] and {r["id"] for r in good.collect()} == set(range(0, 900, 2)) - {10}
    assert {r["id"]: r[B.REASON] for r in bad.collect()} == {i: "even" if i % 2 else "small" for i in range(1000) if i % 2 or i >= 900 or i == 10}
    assert B.commits(path)[0]["rows"] == {"accepted": 449, "rejected": 551}


def test_sink_task_that_ends_after_the_abort(spark):
    """A task that is still writing when its job is aborted removes its own files."""
    import pyarrow.fs as pf

    path = work_dir(spark, "late")
    writer = B.CheckedWriter({"path": path}, spark.createDataFrame([], f"id bigint, {B.REASON} string").schema)

    def batches():
        batch = pa.record_batch({"id": pa.array([1, 2], pa.int64()), B.REASON: pa.array([None, "bad"], pa.string())})
        writer.abort([])
        yield batch

    writer.write(batches())
    fs, root = topics._file_system(path)
    assert [i for i in fs.get_file_info(pf.FileSelector(root, recursive=True, allow_not_found=True)) if i.base_name.endswith(".parquet")] == []


def test_null_order_is_the_oldest(spark):
    base = spark.createDataFrame([(1, "base")], "k int, v string")
    log = spark.createDataFrame([(1, "first", 3), (1, "none", None), (2, "none", None), (3, "none", None), (3, "later", 0)], "k int, v string, o bigint")
    changes = C.upserts(log, F.col("o")).drop("o")
    assert rows(C.apply_changes(base, changes, ["k"])) == [(1, "first", False), (2, "none", False), (3, "later", False)]
    table = KeyedTable(spark, work_dir(spark, "nulls"), ["k"], buckets=2)
    table.load(base)
    table.commit(C.union_changes(changes, C.truncate(spark, base.select("k").schema, 2)))
    assert rows(table.read()) == [(1, "first", False), (2, "none", True), (3, "later", True)]


def test_drain_keeps_messages_without_order(spark):
    path, schema = work_dir(spark, "landed"), "k int, v string, o bigint"
    for batch in ([(1, "a", 5), (2, "b", None)], [(1, "old", None), (2, "c", None), (3, "d", None)], [(3, "e", 1), (2, "f", 2)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    table = KeyedTable(spark, work_dir(spark, "drained"), ["k"], buckets=2)
    D.drain(D.file_stream(spark, path, spark.read.parquet(path).schema, 1), table, work_dir(spark, "cp"), "d", order=F.col("o"))
    assert rows(table.read().select("k", "v")) == [(1, "a"), (2, "f"), (3, "e")]


def test_drain_of_a_batch_that_is_all_older(spark):
    """No message of the second batch is newer than its row, so its log is empty; the third batch goes on."""
    path, schema = work_dir(spark, "landed"), "k int, v string, o int"
    for batch in ([(1, "a", 5), (2, "b", 6)], [(1, "old", 4), (2, "old", 3)], [(2, "c", 7)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    table = KeyedTable(spark, work_dir(spark, "drained"), ["k"], buckets=2)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        D.drain(D.file_stream(spark, path, spark.read.parquet(path).schema, 1), table, work_dir(spark, "cp"), "d", order=F.struct("o", "v"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert rows(table.read().select("k", "v")) == [(1, "a"), (2, "c")]
    assert table.state() == {"batch": 2}


def test_first_list_with_records(spark):
    docs = spark.createDataFrame([([], [(2,)], None), ([(1,)], [(9,), (8,)], None), ([], [], None), (None, None, None)],
                                 "data array<struct<a:int>>, results array<struct<a:int>>, other array<struct<a:int>>")
    assert rows(files.envelope_rows(docs)) == [(1,), (2,)]
    assert files.pages_without_rows(docs).count() == 1
    assert rows(files.unchosen_lists(docs)) == [("results", 1, 2)]
