"""Hash trees, key sets as bits, zones of files, quantile segments, totals in the state."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import changes as C
from tidemark.operators import cursors, digests, keysets, summary
from tidemark.plans.store import KeyedTable
from tidemark.plans.zoned_table import ZonedTable
from tidemark.session import work_dir
from tidemark.sources import tables


def scanned_files(df):
    """Files that the scans of an executed plan opened."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        found += metric.get().value() if metric.isDefined() else 0
    return found


def test_tree_finds_changed_ranges_and_reads_no_other(spark):
    rng = random.Random(4)
    data = [(i, rng.choice([None, "a", "b"]), rng.choice([None, 1, 2])) for i in range(3000)]
    schema, block = "k int, a string, b int", F.floor(F.col("k") / 30)
    before = spark.createDataFrame(data, schema)
    digests.write_snapshot(before, path := work_dir(spark, "snap"), block)
    after = {k: (k, a, b) for k, a, b in data}
    for k in (35, 36, 1200):
        after[k] = (k, "changed", None)
    after[700] = (700, after[700][2] and "1", 5)  # a value moves
    del after[2999]
    after[9000] = (9000, "new", 1)
    current = spark.createDataFrame(list(after.values()), schema)
    log, blocks = digests.changes_since(spark, path, current, ["k"], block)
    assert {r[0] for r in blocks.collect()} == {1, 23, 40, 99, 300}
    assert rows(log.select("k", "_op")) == sorted([(35, "I"), (36, "I"), (700, "I"), (1200, "I"), (2999, "D"), (9000, "I")], key=repr)
    read = digests.stored_rows(spark, path, blocks, before.columns)
    assert scanned_files(read) <= 4 * 4  # four stored blocks of a hundred
    assert digests.changes_since(spark, path, before.orderBy(F.rand(1)), ["k"], block)[0].count() == 0


def test_digests_see_nulls_and_copies(spark):
    leaf = lambda data: {r["_block"]: (r["n"], r["low"], r["high"], r["mark"]) for r in digests.leaf_digests(
        spark.createDataFrame(data, "k int, a int, b int"), ["k", "a", "b"], F.lit(0)).collect()}
    assert leaf([(1, None, 2)]) != leaf([(1, 2, None)])
    assert leaf([(1, 1, 1), (1, 1, 1)]) != leaf([(1, 1, 1)])
    assert leaf([(1, 1, 1), (2, 2, 2)]) == leaf([(2, 2, 2), (1, 1, 1)])


def test_key_bits_are_exact(spark):
    rng = random.Random(6)
    edge = [0, 63, 64, -1, -64, -65, 2**63 - 1, -2**63]
    a = {rng.randrange(-500, 500) for _ in range(400)} | set(edge)
    b = {rng.randrange(-500, 500) for _ in range(400)} | {0, -65}
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys] + [(None,)], "k bigint")
    x, y = keysets.key_bits(frame([*a, *a]), "k"), keysets.key_bits(frame(b), "k")
    for f, want in ((keysets.without, a - b), (keysets.common, a & b), (keysets.either, a | b)):
        got = f(x, y)
        assert sorted(r["k"] for r in keysets.keys_of(got, "k").collect()) == sorted(want)
        assert keysets.size(got).first()["n"] == len(want)
    assert keysets.size(keysets.without(x, x)).first()["n"] == 0
    with pytest.raises(ValueError):
        keysets.key_bits(spark.createDataFrame([("a",)], "k string"), "k")


def test_zones_prune_and_count(spark):
    rng = random.Random(7)
    data = [(rng.randrange(2000), i) for i in range(6000)]
    table = ZonedTable(spark, work_dir(spark, "zones"), "c", file_rows=300)
    df = spark.createDataFrame(data, "c int, v int")
    with pytest.raises(ValueError):
        table.read()
    table.append(df.where("v < 4000"))
    table.append(df.where("v >= 4000"))
    got = table.read(100, 180)
    assert rows(got) == sorted([d for d in data if 100 <= d[0] <= 180], key=repr)
    assert scanned_files(got) <= 8 and len(table.head()["zones"]) >= 20
    order = sorted(c for c, _ in data)
    assert [table.cursor_at(n) for n in (1, 777, 6000, 6001)] == [str(order[0]), str(order[776]), str(order[-1]), None]
    behind = [c for c in order if c > 900]
    assert table.cursor_at(500, after=900) == str(behind[499])
    assert rows(table.newer(1990)) == sorted([d for d in data if d[0] > 1990], key=repr)
    page, mark = table.page(1000, 500)
    assert int(mark) == [c for c in order if c > 500][999] and page.count() == sum(500 < c <= int(mark) for c in order)
    kept = {z["file"] for z in table.head()["zones"]}
    table.delete_where(300, 310)
    table.update_where(1500, 1500, {"v": F.lit(-1)})
    assert len(kept - {z["file"] for z in table.head()["zones"]}) <= 8
    assert rows(table.read()) == sorted([(c, -1 if c == 1500 else v) for c, v in data if not 300 <= c <= 310], key=repr)
    with pytest.raises(PySparkException, match="NULL cursor"):
        table.append(spark.createDataFrame([(None, 1)], "c int, v int"))


def test_quantile_segments_of_hot_and_null_keys(spark):
    data = [(None if i % 50 == 0 else 7 if i % 2 else i % 97, i) for i in range(5000)]
    df = spark.createDataFrame(data, "k int, v int")
    cuts = tables.quantile_segments(df, "k", 10, ["v"])
    parts = [df.where(c).count() for c in cuts]
    assert sum(parts) == 5000 and max(parts) <= 2 * 5000 / len(cuts)
    assert sorted(r["v"] for c in cuts for r in df.where(c).select("v").collect()) == list(range(5000))
    one = tables.quantile_segments(df.limit(0), "k", 4, ["v"])
    assert sum(df.where(c).count() for c in one) == 5000
    path = work_dir(spark, "pull")
    assert tables.pull_segments(df, "k", cuts, path) == list(range(len(cuts))) and tables.pull_segments(df, "k", cuts, path) == []
    assert rows(tables.pulled(spark, path, df.schema)) == sorted(data, key=repr)


def test_totals_merge_and_count_once(spark):
    table = KeyedTable(spark, work_dir(spark, "totals"), ["k"], buckets=2)
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 40).cast("decimal(12,2)").alias("x"))
    for i, part in enumerate((df.where("k < 100"), df.where("k >= 100"), df.limit(0))):
        for _ in range(2):
            totals = summary.partial_totals(part, ["x"], ["k"], "k")
            summary.commit_with_totals(table, C.upserts(part, i), totals, ("s", i))
    got = summary.totals_of_text(table.state()["totals"], totals).withColumn("d", summary.distinct_count()).first()
    assert (got["n"], int(got["sum_x"]), got["min_k"], got["max_k"]) == (1000, sum(i % 40 for i in range(1000)), 0, 999)
    assert abs(got["d"] - 1000) < 50


def test_until_known(spark):
    df = spark.createDataFrame([(i, 100 - i) for i in range(50)], "k int, o int")
    known = spark.createDataFrame([(30,), (41,), (77,)], "k int")
    assert {r["k"] for r in cursors.until_known(df, ["o"], known, ["k"]).collect()} == set(range(30))
    assert cursors.until_known(df, ["o"], known.limit(0), ["k"]).count() == 50
