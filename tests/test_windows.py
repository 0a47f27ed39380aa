"""Order-dependent operators against plain Python on random and skewed rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import cursors as I
from tidemark.operators import joins, summary, windows


def greedy(values, n):
    """(lower, upper, rows) of greedy chunks with whole ties."""
    values = sorted(values)
    out, at, lower = [], 0, None
    while at < len(values):
        end = min(at + n, len(values)) - 1
        upper = values[end]
        stop = end
        while stop + 1 < len(values) and values[stop + 1] == upper:
            stop += 1
        out.append((lower, upper, stop + 1 - at))
        at, lower = stop + 1, upper
    return out


CASES = {
    "unique": list(range(57)),
    "ties": [random.Random(1).randint(0, 12) for _ in range(200)],
    "hot": [5] * 100 + list(range(40)) + [39] * 3,
    "hot first": [0] * 90 + [1, 2, 3],
    "hot last": [1, 2, 3] + [9] * 90,
    "one value": [4] * 10,
    "one row": [4],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("n", [1, 7, 30])
def test_chunk_bounds(spark, case, n):
    values = CASES[case]
    if n == 1 and case not in ("hot", "one row"):
        pytest.skip("one size per case is enough for single rows")
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    expected = sorted(greedy(values, n), key=repr)
    assert rows(windows.chunk_bounds(df, "v", n)) == expected
    if n == 7 and len(values) > 50:  # many blocks: the chain is doubled from block to block
        assert rows(windows.chunk_bounds(df, "v", n, span=16)) == expected


def test_running_sum_and_pages(spark):
    rng = random.Random(4)
    data = [(i, rng.randint(0, 3)) for i in range(500)]
    df = spark.createDataFrame(data, "k int, w int").repartition(7)
    got = {r["k"]: r["running"] for r in windows.running_sum(df, ["w", "k"], F.col("w")).collect()}
    total = 0
    for k, w in sorted(data, key=lambda r: (r[1], r[0])):
        total += w
        assert got[k] == total
    pages = rows(windows.pages(df.select("k"), ["k"], 40).select("k", "page", "page_index"))
    assert pages == sorted([(k, k // 40, k % 40) for k in range(500)], key=repr)


def test_first_rows_equal_limit(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 9 > 0, F.col("id") % 7).alias("g"))
    for order in (["g", "id"], ["id"]):
        small = rows(windows.first_rows(df, order, 300))
        assert len(small) == 300 and small == rows(windows.first_rows(df, order, 300, heap=True))
        assert rows(windows.split_at(df, order, 300)[1]) == sorted(set(map(tuple, df.collect())) - set(small), key=repr)
    assert windows.first_rows(df, ["g", "id"], 5000).count() == 1000 and windows.first_rows(df, ["g"], 0).count() == 0
    text = df.withColumn("g", F.col("g").cast("string"))
    assert rows(windows.first_rows(text, ["g", "id"], 300)) == rows(windows.first_rows(text, ["g", "id"], 300, heap=True))


@pytest.mark.parametrize("n", [1, 50, 111, 112, 130, 999])
def test_ties_keep_the_number_of_rows(spark, n):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 9 > 0, F.col("id") % 7).alias("g"))
    first, rest = windows.split_at(df, ["g"], n)
    assert first.count() == n and rest.count() == 1000 - n
    assert rows(first.select("g")) == rows(windows.first_rows(df, ["g"], n, heap=True).select("g"))


def test_valid_to_over_a_hot_key(spark):
    rng = random.Random(8)
    data = [(0 if i % 3 == 0 else rng.randint(1, 20), i) for i in range(600)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k int, at int").repartition(6)
    expected = []
    for key in {k for k, _ in data}:
        times = sorted(at for k, at in data if k == key)
        expected += [(key, a, b) for a, b in zip(times, times[1:] + [None])]
    assert rows(windows.with_valid_to(df, ["k"], "at").select("k", "at", "valid_to")) == sorted(expected, key=repr)


def test_keep_first_merges_copies_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 10).alias("k"), F.col("id").alias("at"), F.lit("x").alias("v"))
    out = windows.keep_first(df, ["k"], ["at"])
    assert rows(out) == sorted([(k, k, "x") for k in range(10)], key=repr)
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_success_prefix(spark):
    df = spark.createDataFrame([(1, False), (2, False), (3, True), (4, False)], "id int, failed boolean")
    assert rows(windows.success_prefix(df, "id", F.col("failed")).select("id")) == [(1,), (2,)]
    assert windows.success_prefix(df.filter("id <> 3"), "id", F.col("failed")).count() == 3


def test_key_based_replication_marks(spark):
    stamps = ["2023-12-31T23:59:59Z", "2024-01-01T00:00:00Z", "2024-01-01T00:00:01Z", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z"]
    df = spark.createDataFrame(list(enumerate(stamps)), "customer_id int, updated_at string")
    assert rows(df.filter(I.newer(F.col("updated_at"), "2024-01-01T00:00:00Z")).select("customer_id")) == [(2,), (3,), (4,)]
    assert df.filter(I.newer(F.col("updated_at"), None)).count() == 5


@pytest.mark.parametrize("cap", [1, 7, 50, 500])
def test_capped_runs_cover_all_rows_once(spark, cap):
    rng = random.Random(cap)
    data = [(rng.randint(0, 5), i) for i in range(23)]
    df = spark.createDataFrame(data, "ts int, id int").repartition(3)
    taken, mark = [], None
    for _ in range(40):
        batch = I.capped(df, ["ts", "id"], mark, cap)
        got = [tuple(r) for r in batch.collect()]
        assert len(got) <= cap
        if not got:
            break
        taken += got
        mark = I.position_of(batch, ["ts", "id"], mark)
    assert sorted(taken) == sorted(data)


def test_backfill_covers_the_range_once():
    now, limit, step = datetime(2024, 1, 30), datetime(2024, 1, 2), timedelta(days=1)
    windows_seen, state = [], None
    for _ in range(6):
        steps, state = I.backfill_steps(now, limit, step, 6, state)
        windows_seen += [w for w in steps if w[0] < w[1]]
    days = sorted(windows_seen)
    assert days[0][0] == limit and days[-1][1] == now
    assert all(a[1] == b[0] for a, b in zip(days, days[1:]))
    assert state == {"forward": now, "backward": limit}


def test_time_windows_are_contiguous():
    got = I.time_windows(datetime(2024, 1, 1), datetime(2024, 3, 15), timedelta(days=30))
    assert got[0][0] == datetime(2024, 1, 1) and got[-1][1] == datetime(2024, 3, 15)
    assert all(a[1] == b[0] for a, b in zip(got, got[1:])) and len(got) == 3


def test_coarse_date_skips_taken_ids_only_at_the_mark(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3), ("2024-01-03", 2)], "d string, id int")
    taken = spark.createDataFrame([(2,)], "id int")
    assert rows(I.coarse_date(df, "d", "id", "2024-01-02", taken).select("d", "id")) == [("2024-01-02", 3), ("2024-01-03", 2)]


def test_child_cursors(spark):
    children = spark.createDataFrame([(1, "a", 5), (1, "b", 9), (2, "c", 1), (3, "d", 1)], "company_id int, name string, at int")
    marks = spark.createDataFrame([(1, 5), (2, 1)], "company_id int, mark int")
    assert rows(joins.newer_children(children, marks, "company_id", "at").select("name")) == [("b",), ("d",)]


def test_frontier_counts_seeds_as_visited(spark):
    links = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (3, "y"), (3, "z"), (4, "z"), (1, "y")], "item int, via string")
    seed = spark.createDataFrame([(1,)], "item int")
    assert rows(joins.expand_frontier(seed, links, 3)) == [(1, 0), (2, 1), (3, 1), (4, 2)]
    assert rows(joins.expand_frontier(seed, links, 3, step_limit=1)) == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_frontier_through_a_hot_link(spark):
    """One link shared by a third of the items is passed once, not pair by pair."""
    links = spark.range(3000).select(F.col("id").alias("item"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("via"))
    out = joins.expand_frontier(spark.createDataFrame([(0,)], "item bigint"), links, 2)
    assert out.count() == 1000


def test_assembly_over_blocks(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"),
                                  F.when(F.col("id") % 10 != 0, F.concat(F.col("id").cast("string"), F.lit(","))).alias("piece")).repartition(5)
    for r in summary.assemble(df, "k", "seq", "piece", block=64).collect():
        assert r["text"] == "".join(f"{i}," for i in range(1000) if i % 2 == r["k"] and i % 10)
