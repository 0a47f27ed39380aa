"""Merge-on-read tables: the row-by-row model, bytes written, files read, stops during compaction, clean-up."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_changes import frames, golden_log, model, model_rows, random_case, shown
from tidemark.operators import changes as C
from tidemark.plans.merge_table import MergeTable
from tidemark.session import hadoop_path, path_bytes, work_dir


def data_files(spark, path, kind=""):
    fs, folder = hadoop_path(spark, f"{path}/{kind}".rstrip("/"))
    found = []
    if fs.exists(folder):
        each = fs.listFiles(folder, True)
        while each.hasNext():
            name = each.next().getPath().toString()
            if name.endswith(".parquet"):
                found.append(name)
    return sorted(found)


def test_golden_commits(spark):
    table = MergeTable(spark, work_dir(spark, "merge"), ["product_id"], buckets=3)
    for i, (log, expected) in enumerate(golden_log(spark)):
        table.commit(log)
        assert shown(table.read()) == sorted(expected, key=repr)
        if i == 3:
            table.compact()
            assert shown(table.read()) == sorted(expected, key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_random_logs_in_several_commits(spark, broadcast):
    """Logs with truncates cut into commits, with compactions of some buckets between them, equal the model."""
    rng = random.Random(21 + broadcast)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for round_ in range(2):
            ops = []
            for case in range(25):
                ops += random_case(rng, case)[1]
            rng.shuffle(ops)
            ops.insert(rng.randint(0, len(ops)), ("T", None, {}))
            ops.insert(rng.randint(0, len(ops)), ("T", None, {}))
            _, log = frames(spark, {(0, 0): ({"a": None, "b": None}, False)}, ops, 3)
            table = MergeTable(spark, work_dir(spark, "merge"), ["c", "k"], buckets=3)
            cuts = sorted(rng.sample(range(1, len(ops)), 4)) + [len(ops)]
            at = 0
            for i, cut in enumerate(cuts):
                table.commit(log.filter((F.col("_seq") > at) & (F.col("_seq") <= cut)))
                at = cut
                assert rows(table.read().select("c", "k", "a", "b", "_deleted")) == model_rows(model({}, ops[:at]))
                if i == 1 + round_ % 2:
                    table.compact(share=0.5)
                if i == 3:
                    table.compact()
                    assert rows(table.read().select("c", "k", "a", "b", "_deleted")) == model_rows(model({}, ops[:at]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def numbers(spark, n, value="v", start=0):
    return spark.range(start, n).select(F.col("id").alias("k"), F.concat(F.lit(value), F.col("id")).alias("v"), (F.col("id") * 7).alias("w"))


def test_small_commits_write_what_they_change(spark):
    table = MergeTable(spark, path := work_dir(spark, "merge"), ["k"], buckets=8)
    table.commit(C.upserts(numbers(spark, 50_000), 0))
    table.compact()
    before, first = path_bytes(spark, f"{path}/base"), path_bytes(spark, f"{path}/delta")
    for i in range(5):
        table.commit(C.upserts(numbers(spark, 1000 * i + 100, f"n{i}-", 1000 * i), i))
    assert path_bytes(spark, f"{path}/base") == before
    logs = path_bytes(spark, f"{path}/delta") - first
    one = work_dir(spark, "log")
    C.fold_changes(C.upserts(numbers(spark, 100), 0), ["k"]).repartition(1).write.parquet(one)
    assert logs < 5 * 2 * path_bytes(spark, one)
    want = {k: f"v{k}" for k in range(50_000)} | {k: f"n{i}-{k}" for i in range(5) for k in range(1000 * i, 1000 * i + 100)}
    assert {r["k"]: r["v"] for r in table.read().collect()} == want


def test_widening_rewrites_nothing(spark):
    table = MergeTable(spark, path := work_dir(spark, "merge"), ["k"], buckets=4)
    table.commit(C.upserts(spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("int").alias("n")), 0))
    table.compact()
    base = data_files(spark, path, "base")
    table.commit(C.upserts(spark.createDataFrame([(1, 2.5)], "k bigint, n double"), 0))
    table.commit(C.upserts(spark.createDataFrame([(2, "x", "new")], "k bigint, n string, extra string"), 0))
    assert data_files(spark, path, "base") == base
    got = {r["k"]: (r["n"], r["extra"]) for r in table.read().collect()}
    assert got[1] == ("2.5", None) and got[2] == ("x", "new") and got[3][1] is None and float(got[3][0]) == 3
    table.compact()
    assert {r["k"]: (r["n"], r["extra"]) for r in table.read().collect()} == got


def test_truncate_writes_no_data(spark):
    table = MergeTable(spark, path := work_dir(spark, "merge"), ["k"], buckets=4)
    table.commit(C.upserts(numbers(spark, 500), 0))
    table.compact()
    before = data_files(spark, path)
    table.commit(C.truncate(spark, numbers(spark, 1).select("k").schema, 1))
    assert data_files(spark, path) == before
    assert table.read().where("_deleted").count() == 500
    table.commit(C.upserts(numbers(spark, 10, "again"), 0))
    assert table.active().count() == 10
    table.compact()
    assert table.active().count() == 10 and table.read().count() == 500


def test_stop_in_compaction_and_commit(spark):
    table = MergeTable(spark, path := work_dir(spark, "merge"), ["k"], buckets=4)
    table.commit(C.upserts(numbers(spark, 300), 0), state={"mark": 1})
    table.commit(C.deletes(numbers(spark, 100).select("k"), ["k"], 0), state={"mark": 2}, batch=("s", 4))
    want = rows(table.read())

    def stop():
        raise RuntimeError("lost")

    for work in (lambda: table.compact(before_publish=stop), lambda: table.commit(C.upserts(numbers(spark, 300, "bad"), 0), before_publish=stop)):
        with pytest.raises(RuntimeError, match="lost"):
            work()
        assert rows(table.read()) == want and table.state() == {"mark": 2}
    assert table.commit(C.upserts(numbers(spark, 300, "twice"), 0), batch=("s", 4)) == 2  # this batch is in

    def other():
        MergeTable(spark, path, ["k"]).commit(C.upserts(numbers(spark, 5, "other"), 0))

    with pytest.raises(RuntimeError, match="taken"):
        table.compact(before_publish=other)
    want = rows(table.read())
    table.compact()
    assert rows(table.read()) == want and table.state() == {"mark": 2}


def test_clean_removes_what_no_kept_commit_names(spark):
    table = MergeTable(spark, path := work_dir(spark, "merge"), ["k"], buckets=2)
    for i in range(4):
        table.commit(C.upserts(numbers(spark, 50, f"r{i}-"), 0))
        table.compact()
    with pytest.raises(RuntimeError):
        table.commit(C.upserts(numbers(spark, 50, "lost"), 0), before_publish=lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    want, before = rows(table.read()), len(data_files(spark, path))
    assert table.clean() == 0  # all younger than a day
    assert table.clean(older_than_s=-60) > 0
    assert rows(table.read()) == want and len(data_files(spark, path)) < before / 3
    assert len(data_files(spark, path, "delta")) == 0
    table.commit(C.upserts(numbers(spark, 60, "next"), 0))
    assert table.read().count() == 60


def test_wrong_keys_and_buckets(spark):
    table = MergeTable(spark, path := work_dir(spark, "merge"), ["k"], buckets=2)
    with pytest.raises(ValueError):
        table.read()
    table.commit(C.upserts(numbers(spark, 5), 0))
    with pytest.raises(ValueError):
        MergeTable(spark, path, ["v"])
    with pytest.raises(ValueError):
        MergeTable(spark, path, ["k"], buckets=3)
    with pytest.raises(ValueError, match="key column"):
        table.commit(C.upserts(spark.createDataFrame([("a", "b")], "k string, v string"), 0))
