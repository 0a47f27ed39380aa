"""Change application: golden tables, a row-by-row model, commits that stop, partition counts."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import changes as C
from tidemark.plans import merge_table, store
from tidemark.plans.store import KeyedTable
from tidemark.session import broadcast_limit, work_dir

PRODUCT = "product_id int, name string, category string, price double, in_stock boolean"


def products(spark, *values):
    return spark.createDataFrame(list(values), PRODUCT)


def golden_log(spark):
    """Seven steps, each with the table expected after it as (id, name, price, deleted)."""
    key, schema = ["product_id"], "product_id int, price double"
    tea, rope, lamp, ink = (11, "Green tea"), (12, "Rope 8 mm"), (13, "Oil lamp"), (14, "Blue ink")
    seeds = products(spark, (*tea, "Food", 4.25, True), (*rope, "Tools", 12.5, True))
    return [
        (C.upserts(seeds, 10), [(*tea, 4.25, False), (*rope, 12.5, False)]),
        (C.deletes(spark.createDataFrame([(12,)], "product_id int"), key, 20), [(*tea, 4.25, False), (*rope, 12.5, True)]),
        (C.upserts(products(spark, (*lamp, "Home", 31.0, False)), 30), [(*tea, 4.25, False), (*rope, 12.5, True), (*lamp, 31.0, False)]),
        (C.updates(spark.createDataFrame([(11, 5.0), (12, 9.75)], schema), key, 40), [(*tea, 5.0, False), (*rope, 9.75, True), (*lamp, 31.0, False)]),
        (C.truncate(spark, T.StructType([T.StructField("product_id", T.IntegerType())]), 50), [(*tea, 5.0, True), (*rope, 9.75, True), (*lamp, 31.0, True)]),
        (C.upserts(products(spark, (*ink, "Office", 2.0, True), (12, "Rope 10 mm", "Tools", 15.0, True)), 60),
         [(*tea, 5.0, True), (12, "Rope 10 mm", 15.0, False), (*lamp, 31.0, True), (*ink, 2.0, False)]),
        (C.updates(spark.createDataFrame([(14, 2.5), (99, 1.0)], schema), key, 70),
         [(*tea, 5.0, True), (12, "Rope 10 mm", 15.0, False), (*lamp, 31.0, True), (*ink, 2.5, False)]),
    ]


def shown(df):
    return rows(df.select("product_id", "name", F.round("price", 2), "_deleted"))


def test_golden_commits(spark):
    table = KeyedTable(spark, work_dir(spark, "golden"), ["product_id"], buckets=3)
    for log, expected in golden_log(spark):
        table.commit(log)
        assert shown(table.read()) == sorted(expected, key=repr)


def test_golden_one_commit_and_one_plan(spark):
    steps = golden_log(spark)
    log = C.union_changes(*[s for s, _ in steps])
    expected = sorted(steps[-1][1], key=repr)
    table = KeyedTable(spark, work_dir(spark, "golden"), ["product_id"], buckets=3)
    table.commit(log)
    assert shown(table.read()) == expected
    empty = spark.createDataFrame([], PRODUCT)
    assert shown(C.apply_changes(empty, log, ["product_id"], truncates=True)) == expected


def test_composite_key_by_predicate(spark):
    base = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 1, "d")], "id int, department_id int, name string")
    key = ["id", "department_id"]
    log = C.union_changes(C.delete_where(base, key, (F.col("id") == 3) & (F.col("department_id") == 1), 1),
                          C.delete_where(base, key, F.col("id") == 1, 2),
                          C.update_where(base, key, F.col("id") == 2, {"name": F.lit("z")}, 3))
    assert rows(C.apply_changes(base, log, key)) == [(1, 1, "a", True), (1, 2, "b", True), (2, 1, "z", False), (3, 1, "d", True)]


def test_incomplete_key_is_an_error(spark):
    base = spark.createDataFrame([(1, 1, "a")], "id int, department_id int, name string")
    with pytest.raises(ValueError, match="department_id"):
        C.updates(base.drop("department_id"), ["id", "department_id"], 1)
    with pytest.raises(ValueError, match="department_id"):
        C.deletes(base.drop("department_id"), ["id", "department_id"], 1)
    nulled = C.deletes(base.withColumn("department_id", F.lit(None).cast("int")), ["id", "department_id"], 1)
    with pytest.raises(PySparkException, match="NULL in key column"):
        C.apply_changes(base, nulled, ["id", "department_id"]).collect()


COLUMNS = ["a", "b"]


def model(base, ops):
    """Row by row: {key: [values, deleted]}."""
    table = {k: [dict(v), d] for k, (v, d) in base.items()}
    for op, key, values in ops:
        if op == "T":
            for row in table.values():
                row[1] = True
        elif op == "I":
            row = table.setdefault(key, [dict.fromkeys(COLUMNS), False])
            row[0].update(values)
            row[1] = False
        elif key in table:
            if op == "U":
                table[key][0].update(values)
            else:
                table[key][1] = True
    return table


def random_case(rng, case):
    base = {(case, k): ({"a": rng.choice([None, 1, 2]), "b": rng.choice([None, "x"])}, rng.random() < 0.3)
            for k in range(4) if rng.random() < 0.5}
    ops = []
    for _ in range(rng.randint(1, 9)):
        op = rng.choice("IIUUUD")
        values = {c: rng.choice([None, 7, 8] if c == "a" else [None, "y", "z"]) for c in COLUMNS if rng.random() < 0.6}
        if op == "U" and not values:
            values = {"a": 9}
        ops.append((op, (case, rng.randint(0, 3)), values if op != "D" else {}))
    return base, ops


def frames(spark, base, ops, parts):
    base_df = spark.createDataFrame([(c, k, v["a"], v["b"], d) for (c, k), (v, d) in base.items()],
                                    "c int, k int, a int, b string, _deleted boolean").repartition(parts)
    log = spark.createDataFrame(
        [(i, op, key[0] if key else None, key[1] if key else None, v.get("a"), v.get("b"), list(v)) for i, (op, key, v) in enumerate(ops, 1)],
        "_seq bigint, _op string, c int, k int, a int, b string, _supplied array<string>")
    return base_df, log.repartition(parts)


def model_rows(table):
    return sorted(((c, k, v["a"], v["b"], d) for (c, k), (v, d) in table.items()), key=repr)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_random_logs_equal_the_model(spark, parts):
    """Four hundred independent cases in one log; the number of partitions does not matter."""
    rng = random.Random(5)
    base, ops = {}, []
    for case in range(400):
        b, o = random_case(rng, case)
        base.update(b)
        ops += o
    rng.shuffle(ops)
    base_df, log = frames(spark, base, ops, parts)
    assert rows(C.apply_changes(base_df, log, ["c", "k"])) == model_rows(model(base, ops))


def test_random_logs_with_truncates(spark):
    rng = random.Random(11)
    for _ in range(3):
        base, ops = {}, []
        for case in range(20):
            b, o = random_case(rng, case)
            base.update(b)
            ops += o
        rng.shuffle(ops)
        for _ in range(2):
            ops.insert(rng.randint(0, len(ops)), ("T", None, {}))
        base_df, log = frames(spark, base, ops, 5)
        expected = model_rows(model(base, ops))
        assert rows(C.apply_changes(base_df, log, ["c", "k"], truncates=True)) == expected
        table = KeyedTable(spark, work_dir(spark, "random"), ["c", "k"], buckets=3)
        table.load(base_df)
        cut = rng.randint(1, len(ops))
        table.commit(log.filter(F.col("_seq") <= cut))
        table.commit(log.filter(F.col("_seq") > cut))
        assert rows(table.read().select("c", "k", "a", "b", "_deleted")) == expected


@pytest.mark.parametrize("log_size", ["broadcast", "hash", "unknown"])
def test_join_forms(spark, log_size):
    rng = random.Random(3)
    base, ops = {}, []
    for case in range(60):
        b, o = random_case(rng, case)
        base.update(b)
        ops += o
    base_df, log = frames(spark, base, ops, 4)
    out = C.apply_folded(base_df, C.fold_changes(log, ["c", "k"]), ["c", "k"], log_size=log_size)
    assert rows(out) == model_rows(model(base, ops))


@pytest.mark.parametrize("log_size", ["broadcast", "hash", "unknown"])
def test_commit_paths(spark, monkeypatch, log_size):
    """Whatever the measured size of the log, the table is the same."""
    monkeypatch.setattr(KeyedTable, "_log_size", lambda *a: log_size)
    base = spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    log = C.union_changes(C.upserts(spark.range(400, 700).select(F.col("id").alias("k"), F.lit("new").alias("v")), 1),
                          C.deletes(spark.range(10).select(F.col("id").alias("k")), ["k"], 2))
    table = KeyedTable(spark, work_dir(spark, "paths"), ["k"], buckets=5)
    table.load(base)
    table.commit(log)
    assert rows(table.read()) == sorted([(k, "new" if k >= 400 else "old", k < 10) for k in range(700)], key=repr)


def test_size_of_the_log_decides(spark, monkeypatch):
    table = KeyedTable(spark, work_dir(spark, "size"), ["k"], buckets=4)
    limit = broadcast_limit(spark)
    part = store.HASH_BYTES // store.IN_MEMORY
    for size, splits, expected in ((limit // store.IN_MEMORY, 1, "broadcast"), (limit // store.IN_MEMORY + 1, 1, "hash"), (part, 1, "hash"), (part + 1, 1, "unknown"), (2 * part, 2, "hash")):
        monkeypatch.setattr(store, "path_bytes", lambda *a, size=size: size)
        assert table._log_size("x", ["0"], splits) == expected


def test_large_commit_shuffles_each_side_once(spark):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table = KeyedTable(spark, work_dir(spark, "plan"), ["k"], buckets=4)
    folded = table._bucketed(C.fold_changes(C.upserts(base, 1), ["k"]))
    for log_size, join in (("hash", "ShuffledHashJoin"), ("unknown", "SortMergeJoin")):
        with store._bucket_writes(spark):
            side = table._bucketed(base)
            plan = table._applied(side, spark.createDataFrame([], folded.schema), None, None, 4, 1, log_size)._jdf.queryExecution().executedPlan().toString()
        assert join in plan and plan.count("Exchange hashpartitioning(_part") == 2 and plan.count("Exchange") == 2


def test_stopped_commit_leaves_table_and_state(spark):
    table = KeyedTable(spark, work_dir(spark, "stop"), ["k"], buckets=2)
    frame = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    table.load(frame, state={"mark": 1})

    def stop():
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        table.commit(C.upserts(frame.withColumn("v", F.lit(2)), 1), state={"mark": 2}, before_publish=stop)
    assert table.state() == {"mark": 1} and {r[1] for r in rows(table.read())} == {1}
    table.commit(C.upserts(frame.withColumn("v", F.lit(2)), 1), state={"mark": 2})
    assert table.state() == {"mark": 2} and {r[1] for r in rows(table.read())} == {2}


def test_repeated_batch_is_skipped_and_second_writer_fails(spark):
    path = work_dir(spark, "batch")
    table = KeyedTable(spark, path, ["k"], buckets=2)
    one = spark.createDataFrame([(1, 1)], "k int, v int")
    assert table.commit(C.upserts(one, 1), batch=("s", 0)) == 1
    assert table.commit(C.upserts(one.withColumn("v", F.lit(5)), 1), batch=("s", 0)) == 1
    assert rows(table.read()) == [(1, 1, False)]
    other = KeyedTable(spark, path, ["k"], buckets=2)
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(C.upserts(one, 1), before_publish=lambda: other.commit(C.upserts(one, 1)))


def test_only_touched_buckets_are_rewritten(spark):
    table = KeyedTable(spark, work_dir(spark, "touch"), ["k"], buckets=16)
    table.load(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    table.commit(C.upserts(spark.createDataFrame([(3, 9)], "k bigint, v int"), 1))
    versions = [int(a[1:a.index("-")]) for a in table.head()["buckets"].values()]
    assert versions.count(2) == 1 and versions.count(1) == 15


def test_hot_key_folds_before_the_shuffle(spark):
    """A third of the log on one key: the partial aggregate leaves one row per task for it."""
    log = spark.range(30000).select(
        F.col("id").alias("_seq"), F.lit("I").alias("_op"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"))
    folded = C.fold_changes(log, ["k"])
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert folded.filter("k = 0").select("_x_v.v").first()[0] == "29997"


def test_key_type_change_is_refused(spark):
    table = KeyedTable(spark, work_dir(spark, "key"), ["k"], buckets=2)
    table.load(spark.createDataFrame([(1, 1)], "k int, v int"))
    table.commit(C.upserts(spark.createDataFrame([(1, 2), (2**40, 3)], "k bigint, v int"), 1))
    assert rows(table.read()) == sorted([(1, 2, False), (2**40, 3, False)], key=repr)
    with pytest.raises(ValueError, match="key column"):
        table.commit(C.upserts(spark.createDataFrame([("x", 2)], "k string, v int"), 1))


def test_empty_logs(spark):
    """A run or batch without rows commits its state and changes nothing."""
    schema = "k int, v int"
    empty = spark.createDataFrame([], schema)
    table = KeyedTable(spark, work_dir(spark, "empty"), ["k"], buckets=2)
    table.commit(C.upserts(empty, 1), state={"mark": 0})
    assert table.read().count() == 0
    table.commit(C.upserts(spark.createDataFrame([(1, 1)], schema), 1), state={"mark": 1})
    table.commit(C.upserts(empty.filter("k > 0"), 1), state={"mark": 2})
    table.commit(C.upserts(spark.createDataFrame([(1, 1)], schema).filter("k > 5"), 1), state={"mark": 3})
    assert rows(table.read()) == [(1, 1, False)] and table.state() == {"mark": 3}


def test_bucket_count_and_keys_are_stored(spark):
    path = work_dir(spark, "reopen")
    frame = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    KeyedTable(spark, path, ["k"], buckets=8).load(frame)
    table = KeyedTable(spark, path, ["k"])
    table.commit(C.upserts(frame.withColumn("v", F.lit(2)), 1))
    assert table.buckets == 8 and table.read().count() == 100
    with pytest.raises(ValueError, match="8 buckets"):
        KeyedTable(spark, path, ["k"], buckets=3)
    with pytest.raises(ValueError, match="has the key"):
        KeyedTable(spark, path, ["v"])
    table.rebucket(3)
    table = KeyedTable(spark, path, ["k"], buckets=3)
    table.commit(C.upserts(frame.withColumn("v", F.lit(3)), 1))
    assert rows(table.read().select("v").distinct()) == [(3,)] and table.read().count() == 100


def test_losing_writer_leaves_the_winners_rows(spark):
    """The second writer starts from the same version and writes its data after the first has published."""
    path = work_dir(spark, "race")
    frame = spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    one, two = KeyedTable(spark, path, ["k"], buckets=2), KeyedTable(spark, path, ["k"], buckets=2)
    one.load(frame)
    stale = two.head()
    one.commit(C.upserts(frame.withColumn("v", F.lit(1)), 1))
    two.head = lambda: stale
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit(C.upserts(frame.withColumn("v", F.lit(2)), 1))
    assert rows(one.read().select("v").distinct()) == [(1,)] and one.read().count() == 50
    del two.head
    two.commit(C.upserts(frame.withColumn("v", F.lit(2)), 1))
    assert rows(one.read().select("v").distinct()) == [(2,)]


def test_load_refuses_repeated_keys(spark):
    table = KeyedTable(spark, work_dir(spark, "twice"), ["k"], buckets=2)
    with pytest.raises(ValueError, match="more than once"):
        table.load(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"))
    assert table.head() is None


def test_large_bucket_is_shared_by_tasks(spark, monkeypatch):
    from tidemark.plans import merge_table, store

    monkeypatch.setattr(store, "TASK_BYTES", 2000)
    monkeypatch.setattr(store, "broadcast_limit", lambda spark: 0)
    table = KeyedTable(spark, work_dir(spark, "shared"), ["k"], buckets=2)
    frame = spark.range(5000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    table.load(frame)
    table.commit(C.upserts(frame.withColumn("v", F.lit("new")).where("k % 2 = 0"), 1))
    files = table.read().select(F.input_file_name().alias("f"), "k", "v")
    assert files.select("f").distinct().count() > 4 and files.where("v = 'new'").count() == 2500 and files.count() == 5000


def test_bucket_of_many_small_rows_is_shared_by_tasks(spark, monkeypatch):
    """Rows that are stored in few bytes take many more in memory: the number of rows shares a bucket too, in commits and when it is bucketed anew."""
    from tidemark.plans import merge_table, store

    monkeypatch.setattr(store, "TASK_ROWS", 1000)
    monkeypatch.setattr(store, "broadcast_limit", lambda spark: 0)
    table = KeyedTable(spark, work_dir(spark, "rows"), ["k"], buckets=2)
    frame = spark.range(20000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    table.load(frame)
    largest = lambda: table.read().groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    table.commit(C.upserts(frame.withColumn("v", F.lit(2)).where("k % 2 = 0"), 1))
    assert largest() < 5000 and table.read().where("v = 2").count() == 10000 and table.read().count() == 20000
    table.rebucket(1)
    assert largest() < 5000 and table.read().where("v = 2").count() == 10000 and table.read().count() == 20000


def test_load_of_many_rows_is_shared_by_tasks(spark, monkeypatch):
    """The rows set how many tasks write a first load, not the session's shuffles alone."""
    monkeypatch.setattr(store, "TASK_ROWS", 1000)
    table = KeyedTable(spark, work_dir(spark, "loaded"), ["k"], buckets=2)
    table.load(spark.range(20000).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    largest = table.read().groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 5000 and table.read().count() == 20000


def test_fold_of_a_large_log_is_shared_by_tasks(spark, monkeypatch):
    """The bytes of a log set how many tasks read and fold it, not the session's shuffles alone; the session keeps its settings."""
    monkeypatch.setattr(store, "GROUP_BYTES", 1 << 16, raising=False)
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(n, None) for n in names]
    path = work_dir(spark, "log")
    spark.range(300000).select(F.hash("id", F.lit(1)).cast("bigint").alias("k"), F.xxhash64("id").alias("v")).dropDuplicates(["k"]).coalesce(1).write.option("parquet.block.size", 1 << 18).parquet(path)
    frame = spark.read.parquet(path)
    table = KeyedTable(spark, work_dir(spark, "folded"), ["k"], buckets=1)
    spark.sparkContext.setJobGroup("fold", "fold")
    try:
        table.commit(C.upserts(frame, 1))
        status = spark.sparkContext.statusTracker()
        tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("fold") for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    assert len([n for n in tasks if n > 8]) >= 2  # the scan and the fold; eight cores, four shuffle parts
    assert [spark.conf.get(n, None) for n in names] == before
    assert table.read().count() == frame.count() and table.read().drop("_deleted").exceptAll(frame).isEmpty()


@pytest.mark.parametrize("kind", ["keyed", "merged"])
def test_fold_does_not_follow_the_row_groups_of_a_log(spark, monkeypatch, kind):
    """A log in one row group, which no scan divides, is grouped in small parts, and so are the operations on a hot key."""
    monkeypatch.setattr(store, "GROUP_BYTES", 1 << 16)
    module, table = (store, KeyedTable) if kind == "keyed" else (merge_table, merge_table.MergeTable)
    path, parts = work_dir(spark, "log"), []
    rows = spark.range(200000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("v"), F.col("id").alias("n"))
    rows.coalesce(1).write.parquet(path)
    changes = C.upserts(spark.read.parquet(path), F.col("n")).drop("n")

    def watched(log, *args, **kw):
        with store._settings(spark, {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}):
            parts.extend(log.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("rows"), F.count_if(F.col("k") == 0).alias("hot")).collect())
        return C.fold_changes(log, *args, **kw)

    monkeypatch.setattr(module, "fold_changes", watched)
    table = table(spark, work_dir(spark, "folded"), ["k"], buckets=2)
    table.commit(changes)
    assert sum(p["rows"] for p in parts) == 200000 and max(p["rows"] for p in parts) < 40000 and max(p["hot"] for p in parts) < 20000
    wanted = changes.groupBy("k").agg(F.max_by("v", "_seq").alias("v"))
    got = table.read().select("k", "v")
    assert got.count() == wanted.count() and got.exceptAll(wanted).isEmpty()


def test_stored_row_groups_are_small(spark, monkeypatch):
    """Log and rows are stored in row groups of bounded size, or the tasks that read them would hold more as buckets grow."""
    monkeypatch.setattr(store, "ROW_GROUP_BYTES", 1 << 18, raising=False)
    table = KeyedTable(spark, path := work_dir(spark, "groups"), ["k"], buckets=1)
    rows = spark.range(200000).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"))
    table.load(rows.where("k < 100000").coalesce(1))
    table.commit(C.upserts(rows.coalesce(1), 1))
    for kind in ("log", "data"):
        files = [os.path.join(at, f) for at, _, names in os.walk(f"{path}/{kind}") for f in names if f.endswith(".parquet")]
        groups = [pq.ParquetFile(f).metadata.row_group(i).num_rows for f in files for i in range(pq.ParquetFile(f).num_row_groups)]
        assert sum(groups) >= 200000 and max(groups) < 45000
    assert table.read().count() == 200000


def test_load_of_many_parts_is_dealt_out(spark, monkeypatch):
    """Beyond the parts that a shuffle streams, rows of one row group are dealt out before they are spread; a key that comes twice still fails."""
    monkeypatch.setattr(store, "TASK_ROWS", 100)
    monkeypatch.setattr(store, "GROUP_BYTES", 1 << 16)
    path = work_dir(spark, "rows")
    spark.range(30000).select(F.col("id").alias("k"), F.xxhash64("id").alias("v")).coalesce(1).write.parquet(path)
    seen, real = [], KeyedTable._spread

    def spread(self, df, *args, **kw):
        with store._settings(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}):
            seen.append(df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0])
        return real(self, df, *args, **kw)

    monkeypatch.setattr(KeyedTable, "_spread", spread)
    table = KeyedTable(spark, work_dir(spark, "loaded"), ["k"], buckets=2)
    rows = spark.read.parquet(path)
    table.load(rows)
    assert seen[0] < 15000 and table.read().drop("_deleted").exceptAll(rows).isEmpty() and table.read().count() == 30000
    with pytest.raises(ValueError, match="more than once"):
        KeyedTable(spark, work_dir(spark, "loaded"), ["k"], buckets=2).load(rows.unionAll(rows.where("k = 7")))


@pytest.mark.parametrize("kind,low,high", [("string", "A", "B"), ("decimal(10,3)", "1.5", "10.25"), ("double", "1.5", "10.25"), ("timestamp", "2024-01-01", "2024-02-01")])
def test_order_of_any_type(spark, kind, low, high):
    log = spark.createDataFrame([(1, high, "a"), (1, low, "z"), (2, None, "n")], "k int, c string, v string").withColumn("c", F.col("c").cast(kind))
    folded = C.apply_changes(C.empty_like(log), C.upserts(log, F.struct("c")), ["k"])
    assert rows(folded.select("k", "v")) == [(1, "a"), (2, "n")]
