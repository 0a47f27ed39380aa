"""Change application on whole tables; change sets are derived from the tables by key arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import with_row_id
from tidemark.operators import changes as C
from tidemark.operators import compare
from tidemark.operators import digests as G
from tidemark.plans.merge_table import MergeTable
from tidemark.plans.store import KeyedTable
from tidemark.plans.zoned_table import ZonedTable
from tidemark.queries.registry import Tables, query
from tidemark.session import path_bytes, work_dir

NEW = 1_000_000_000
ORDER = ["o_orderkey"]


def every(column: str, n: int):
    return F.col(column) % n == 0


def mixed_order_changes(t: Tables):
    """Upserts, partial updates, deletes and new keys over the orders; several operations on some keys."""
    o = t.orders
    return C.union_changes(
        C.upserts(o.filter(every("o_orderkey", 10)).withColumn("o_totalprice", F.col("o_totalprice") * 2), 1),
        C.updates(o.filter(every("o_orderkey", 7)).select("o_orderkey", (F.col("o_totalprice") + 10).alias("o_totalprice")), ORDER, 2),
        C.updates(o.filter(every("o_orderkey", 6)).select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus")), ORDER, 3),
        C.deletes(o.filter(every("o_orderkey", 15)), ORDER, 4),
        C.updates(o.select((F.col("o_orderkey") + NEW).alias("o_orderkey"), F.lit("early").alias("o_orderstatus")), ORDER, 5),
        C.upserts(o.filter(every("o_orderkey", 5)).withColumn("o_orderkey", F.col("o_orderkey") + NEW), 6),
        C.upserts(o.filter(every("o_orderkey", 30)).withColumn("o_orderstatus", F.lit("R")), 7, ["o_orderstatus"]),
    )


MIXED_SQL = """
WITH old AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 30 = 0 THEN 'R' WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 10 WHEN o_orderkey % 10 = 0 THEN o_totalprice * 2
         ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority, (o_orderkey % 15 = 0 AND o_orderkey % 30 <> 0) AS _deleted
  FROM orders)
SELECT * FROM old
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, false
FROM orders WHERE o_orderkey % 5 = 0
"""


@query("dml00_mixed_changes", MIXED_SQL)
def mixed(t: Tables):
    """All kinds of operations in one log, folded and applied in one plan."""
    return C.apply_changes(t.orders, mixed_order_changes(t), ORDER)


@query("dml01_upsert", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority, false AS _deleted
FROM orders
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority, false FROM orders WHERE o_orderkey % 5 = 0
""")
def upsert(t: Tables):
    """Load a stored table, commit an upsert log, read the table."""
    o = t.orders
    table = KeyedTable(t.spark, work_dir(t.spark, "upsert"), ORDER)
    table.load(o)
    table.commit(C.union_changes(
        C.upserts(o.filter(every("o_orderkey", 10)), 1),
        C.upserts(o.filter(every("o_orderkey", 10)).withColumns(
            {"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": F.lit("U")}), 2),
        C.upserts(o.filter(every("o_orderkey", 5)).withColumns(
            {"o_orderkey": F.col("o_orderkey") + NEW, "o_orderstatus": F.lit("N")}), 3)))
    return table.read()


@query("dml01b_upsert_lineitem", """
SELECT * REPLACE (l_quantity + CASE WHEN l_suppkey % 10 = 0 THEN 100 ELSE 0 END AS l_quantity), false AS _deleted FROM lineitem
""")
def upsert_lineitem(t: Tables):
    """A tenth of lineitem changes; rows are found by an id over all values of the source row."""
    rows = with_row_id(t.lineitem)
    changed = rows.filter(every("l_suppkey", 10)).withColumn("l_quantity", F.col("l_quantity") + 100)
    return C.apply_changes(rows, C.upserts(changed, 1), ["_row_id"]).drop("_row_id")


@query("dml01c_upsert_lineitem_table", """
SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, sum(CAST(l_quantity AS BIGINT))::BIGINT + CASE WHEN max(l_partkey) % 10 = 0 THEN 100 ELSE 0 END AS quantity, false AS _deleted
FROM lineitem GROUP BY 1, 2
""")
def upsert_lineitem_table(t: Tables):
    """Lineitem as a stored table, then a tenth of it upserted."""
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    table = KeyedTable(t.spark, work_dir(t.spark, "lineitem"), ["l_orderkey", "l_linenumber"])
    table.load(rows)
    table.commit(C.upserts(rows.filter(every("l_partkey", 10)).withColumn("quantity", F.col("quantity") + 100), 1))
    return table.read()


@query("dml01d_null_order", """
WITH log AS (
  SELECT user_id, event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN event_id END AS seq FROM events WHERE user_id % 2 = 0)
SELECT user_id, arg_max(event_type, coalesce(seq, -1) * 1000000000 + CASE WHEN seq IS NULL THEN event_id ELSE 0 END) AS event_type, false AS _deleted
FROM (SELECT * FROM log WHERE seq IS NOT NULL OR event_id IN (SELECT max(event_id) FROM log WHERE seq IS NULL GROUP BY user_id)) GROUP BY 1
""")
def null_order(t: Tables):
    """A third of the operations have no order: they are older than the others, and alone they still make the row."""
    e = t.events.filter(F.col("user_id") % 2 == 0).select("user_id", "event_id", "event_type")
    unordered = e.filter(F.col("event_id") % 3 == 0).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))
    ordered = e.filter(F.col("event_id") % 3 != 0)
    table = KeyedTable(t.spark, work_dir(t.spark, "nullorder"), ["user_id"])
    table.commit(C.union_changes(C.upserts(unordered, F.lit(None).cast("bigint")), C.upserts(ordered, F.col("event_id")).drop("event_id")))
    return table.read()


@query("dml02_partial_update", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice, false AS _deleted
FROM orders
""")
def partial_update(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    log = C.union_changes(
        C.updates(o.filter(every("o_orderkey", 7)).select("o_orderkey", (F.col("o_totalprice") + 10).alias("o_totalprice")), ORDER, 1),
        C.updates(o.filter(every("o_orderkey", 11)).select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus")), ORDER, 2),
        C.updates(o.select((F.col("o_orderkey") + NEW).alias("o_orderkey"), F.lit("X").alias("o_orderstatus")), ORDER, 3))
    return C.apply_changes(o, log, ORDER)


@query("dml03_soft_delete", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderkey % 10 = 0 AS _deleted FROM orders
""")
def soft_delete(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    log = C.union_changes(C.deletes(o.filter(every("o_orderkey", 10)), ORDER, 1),
                          C.deletes(o.select((F.col("o_orderkey") + NEW).alias("o_orderkey")), ORDER, 2))
    return C.apply_changes(o, log, ORDER)


def part_runs(t: Tables):
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    log = C.union_changes(
        C.upserts(p.filter(every("p_partkey", 3)).withColumn("p_retailprice", F.col("p_retailprice") + 1), 50),
        C.truncate(t.spark, p.select("p_partkey").schema, 100),
        C.upserts(p.filter(every("p_partkey", 4)).withColumn("p_name", F.lit("revived")), 200, ["p_name"]))
    return p, log


@query("dml04_truncate", """
SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice,
  true AS _deleted FROM part
""")
def truncate(t: Tables):
    p, log = part_runs(t)
    return C.apply_changes(p, log.filter(F.col("_seq") <= 100), ["p_partkey"], truncates=True)


@query("dml04b_truncate_mark", """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'again' ELSE p_name END AS p_name, p_retailprice, p_partkey % 4 <> 0 AS _deleted FROM part
""")
def truncate_mark(t: Tables):
    """A truncate of a table merged on read is a mark in its commit: no data file is written for it."""
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    table = MergeTable(t.spark, path := work_dir(t.spark, "marked"), ["p_partkey"])
    table.commit(C.upserts(p, 0))
    table.compact()
    before = path_bytes(t.spark, f"{path}/base") + path_bytes(t.spark, f"{path}/delta")
    table.commit(C.truncate(t.spark, p.select("p_partkey").schema, 0))
    if path_bytes(t.spark, f"{path}/base") + path_bytes(t.spark, f"{path}/delta") != before:
        raise AssertionError("a truncate wrote data")
    table.commit(C.upserts(p.filter(every("p_partkey", 4)).withColumn("p_name", F.lit("again")), 0, ["p_name"]))
    return table.read()


@query("dml05_revive", """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'revived' ELSE p_name END AS p_name,
  CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice,
  p_partkey % 4 <> 0 AS _deleted FROM part
""")
def revive(t: Tables):
    p, log = part_runs(t)
    return C.apply_changes(p, log, ["p_partkey"], truncates=True)


@query("dml06_incomplete_keys", """
SELECT l_orderkey, l_partkey, l_linenumber, 'l_linenumber' AS missing_key
FROM (SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS l_linenumber FROM lineitem)
WHERE l_linenumber IS NULL
""")
def incomplete_keys(t: Tables):
    """The rows the apply would refuse, with the key columns they lack."""
    log = t.lineitem.select("l_orderkey", "l_partkey",
                            F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("l_linenumber"))
    return C.incomplete_keys(log, ["l_orderkey", "l_linenumber"])


@query("dml07_by_predicate", """
WITH b AS (SELECT l_orderkey, l_linenumber, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity, max(l_returnflag) AS flag
           FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN flag = 'R' THEN quantity + 1 ELSE quantity END AS quantity,
  CASE WHEN flag = 'R' THEN 'changed' ELSE flag END AS flag, quantity < 10 AS _deleted FROM b
""")
def by_predicate(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    base = t.lineitem.groupBy(*keys).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
                                         F.max("l_returnflag").alias("flag"))
    log = C.union_changes(
        C.delete_where(base, keys, F.col("quantity") < 10, 1),
        C.update_where(base, keys, F.col("flag") == "R", {"quantity": F.col("quantity") + 1, "flag": F.lit("changed")}, 2))
    return C.apply_changes(base, log, keys)


def change_log(t: Tables):
    """(code, commit, intent) entries over the orders: inserts of new keys, updates, deletes, unknown codes."""
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")

    def entry(rows, code, commit, intent):
        return rows.withColumns({"code": F.lit(code), "commitseq": F.lpad(F.hex(F.lit(commit)), 20, "0"),
                                 "intentseq": F.lpad(F.hex(intent), 20, "0")})

    k = F.col("o_orderkey")
    moved = o.withColumn("o_orderkey", k + NEW)
    parts = [
        entry(moved.filter(every("o_orderkey", 5)), "I", 10, k),
        entry(o.filter(every("o_orderkey", 3)).withColumn("o_totalprice", F.col("o_totalprice") * 2), "U", 20, k),
        entry(o.filter(every("o_orderkey", 9)), "D", 30, k),
        entry(o.filter(every("o_orderkey", 27)).withColumn("o_orderstatus", F.lit("B")), "I", 30, k + NEW),
        entry(o.filter(every("o_orderkey", 2)).withColumn("o_orderstatus", F.lit("?")), "X", 40, k),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return o, out


REPLAY_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 27 = 0 THEN 'B' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 27 = 0 THEN o_totalprice WHEN o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 THEN o_totalprice * 2
       WHEN o_orderkey % 9 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  o_orderkey % 9 = 0 AND o_orderkey % 27 <> 0 AS _deleted FROM orders
UNION ALL
SELECT o_orderkey + 1000000000, o_orderstatus, o_totalprice, false FROM orders WHERE (o_orderkey + 1000000000) % 5 = 0
"""


@query("dml07b_zone_maps", """
SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31' THEN 0.0 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderdate NOT BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '1995-06-30'
""")
def zone_maps(t: Tables):
    """Update and delete by date: the commit's least and greatest date of each file say which files can hold such rows; the others stay as they are."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    table = ZonedTable(t.spark, work_dir(t.spark, "zoned"), "o_orderdate", file_rows=max(1, rows.count() // 24))
    table.append(rows)
    before = {z["file"] for z in table.head()["zones"]}
    table.update_where("1997-03-01", "1997-03-31", {"o_totalprice": F.lit(0.0)})
    table.delete_where("1995-06-01", "1995-06-30")
    if len(before - {z["file"] for z in table.head()["zones"]}) > 6:
        raise AssertionError("files of other dates were rewritten")
    return table.read()


@query("dml08_log_replay", REPLAY_SQL)
def log_replay(t: Tables):
    base, log = change_log(t)
    return C.replay_log(base, log, ORDER, "code", ["commitseq", "intentseq"])


@query("dml08b_unknown_codes", "SELECT 'X' AS code, count(*) AS skipped FROM orders WHERE o_orderkey % 2 = 0")
def log_unknown(t: Tables):
    return C.unknown_codes(change_log(t)[1], "code")


@query("dml09_initial_load_then_log", """
SELECT o_orderkey, CASE WHEN o_orderkey % 27 = 0 THEN 'B' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
  o_orderkey % 9 = 0 AND o_orderkey % 27 <> 0 AS _deleted FROM orders
""")
def initial_then_log(t: Tables):
    """Position first, then the full load, then only entries beyond the position."""
    base, log = change_log(t)
    table = KeyedTable(t.spark, work_dir(t.spark, "initial"), ORDER)
    mark = {"commitseq": f"{20:020X}", "intentseq": "F" * 20}
    table.load(base, state={"position": mark})
    mark = table.state()["position"]
    beyond = F.struct("commitseq", "intentseq") > F.struct(F.lit(mark["commitseq"]).alias("commitseq"),
                                                          F.lit(mark["intentseq"]).alias("intentseq"))
    return C.replay_log(table.read(), log.filter(beyond), ORDER, "code", ["commitseq", "intentseq"])


@query("dml10_snapshot_compare", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 7 <> 0 THEN p_retailprice + 5 ELSE p_retailprice END AS p_retailprice,
  p_name, p_partkey % 7 = 0 AS _deleted FROM part
UNION ALL SELECT p_partkey + 1000000000, p_retailprice, p_name, false FROM part WHERE p_partkey % 6 = 0
""")
def snapshot_compare(t: Tables):
    before = t.part.select("p_partkey", "p_name", "p_retailprice")
    after = (before.filter(F.col("p_partkey") % 7 != 0)
             .withColumn("p_retailprice", F.when(every("p_partkey", 5), F.col("p_retailprice") + 5).otherwise(F.col("p_retailprice")))
             .unionByName(before.filter(every("p_partkey", 6)).withColumn("p_partkey", F.col("p_partkey") + NEW)))
    log = compare.snapshot_changes(before, after, ["p_partkey"])
    return C.apply_changes(before, log, ["p_partkey"])


@query("dml10c_hash_tree", """
WITH b AS (SELECT min(p_partkey) AS lo, max(p_partkey) AS hi FROM part)
SELECT p_partkey, p_name, CASE WHEN p_partkey - lo < (hi - lo + 1) // 100 AND p_partkey % 2 = 0 THEN p_retailprice + 5 ELSE p_retailprice END AS p_retailprice,
  p_partkey - lo < (hi - lo + 1) // 100 AND p_partkey % 2 = 1 AS _deleted FROM part, b
""")
def hash_tree(t: Tables):
    """One per cent of the keys changed or gone: digests of key ranges find the ranges, and no file of another range is read."""
    before = t.part.select("p_partkey", "p_name", "p_retailprice")
    low, high = t.part.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    place = F.col("p_partkey") - low
    block = F.floor(place / max(1, (high - low + 1) // 64))
    G.write_snapshot(before, path := work_dir(t.spark, "snapshot"), block)
    touched = place < (high - low + 1) // 100
    after = before.filter(~touched | every("p_partkey", 2)).withColumn("p_retailprice", F.when(touched, F.col("p_retailprice") + 5).otherwise(F.col("p_retailprice")))
    log, blocks = G.changes_since(t.spark, path, after, ["p_partkey"], block)
    changed, of_all = blocks.count(), t.spark.read.parquet(f"{path}/rows").select(G.BLOCK).distinct().count()
    if not changed < of_all / 8:
        raise AssertionError(f"{changed} of {of_all} ranges differ")
    return C.apply_changes(before, log, ["p_partkey"])


@query("dml11_source_flag_delete", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderstatus = 'F' AS _deleted FROM orders
""")
def source_flag(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.apply_changes(C.empty_like(o), C.flagged_ops(o, F.col("o_orderstatus") == "F", F.lit(1)), ORDER)


@query("dml12_history_mode", """
SELECT o_orderkey, o_orderdate, o_orderstatus, false AS _deleted FROM orders
UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY, 'H', false FROM orders WHERE o_orderkey % 4 = 0
""")
def history(t: Tables):
    """The cursor column is part of the key, so a change is a further row."""
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    changed = o.filter(every("o_orderkey", 4)).withColumns(
        {"o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "o_orderstatus": F.lit("H")})
    same = o.filter(every("o_orderkey", 8))
    return C.apply_changes(o, C.union_changes(C.upserts(same, 1), C.upserts(changed, 2)), ["o_orderkey", "o_orderdate"])


@query("dml13_append_snapshots", """
SELECT user_id, TIMESTAMP '2024-01-16 00:00:00' AS run_at, count(*) AS events FROM events WHERE ts < '2024-01-16' GROUP BY 1
UNION ALL SELECT user_id, TIMESTAMP '2024-02-01 00:00:00', count(*) FROM events WHERE ts < '2024-02-01' GROUP BY 1
""")
def append_snapshots(t: Tables):
    """Each run appends its rows under its own run time."""
    path = work_dir(t.spark, "snapshots")
    for run in ("2024-01-16 00:00:00", "2024-02-01 00:00:00"):
        stamp = F.lit(run).cast("timestamp_ntz")
        counts = t.events.filter(F.col("ts") < stamp).groupBy("user_id").agg(F.count("*").alias("events"))
        counts.withColumn("run_at", stamp).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("dml14_full_refresh", """
SELECT n_nationkey, n_name || '!' AS n_name, n_regionkey, false AS _deleted FROM nation
UNION ALL SELECT n_nationkey + 1000, n_name, n_regionkey, false FROM nation
""")
def full_refresh(t: Tables):
    """No cursor: the whole source is upserted, rows that vanished from it stay."""
    n = t.nation
    stored = n.unionByName(n.withColumn("n_nationkey", F.col("n_nationkey") + 1000))
    return C.apply_changes(stored, C.upserts(n.withColumn("n_name", F.concat("n_name", F.lit("!"))), 1), ["n_nationkey"])


@query("dml15_two_step_load", "SELECT c_custkey, c_name AS payload, 'decoded' AS form, false AS _deleted FROM customer")
def two_step(t: Tables):
    c = t.customer.select("c_custkey", F.base64(F.encode("c_name", "UTF-8")).alias("payload"))
    encoded = c.withColumn("form", F.lit("encoded"))
    decoded = c.select("c_custkey", F.decode(F.unbase64("payload"), "UTF-8").alias("payload"), F.lit("decoded").alias("form"))
    return C.apply_changes(C.empty_like(encoded), C.union_changes(C.upserts(encoded, 1), C.upserts(decoded, 2)), ["c_custkey"])


@query("dml16b_losing_writer", MIXED_SQL)
def losing_writer(t: Tables):
    """A second writer of the same version writes its rows after the first has published: its commit fails, and its retry counts."""
    table = KeyedTable(t.spark, path := work_dir(t.spark, "race"), ORDER)
    table.load(t.orders)
    wrong = C.upserts(t.orders.withColumn("o_totalprice", F.lit(-1.0)), 1)
    other = KeyedTable(t.spark, path, ORDER)

    def first():
        other.commit(C.upserts(t.orders, 1))

    try:
        table.commit(wrong, before_publish=first)
        raise AssertionError("two writers published one version")
    except RuntimeError:
        pass
    table.commit(mixed_order_changes(t))
    return table.read()


@query("dml16_commit_point", MIXED_SQL)
def commit_point(t: Tables):
    """A commit that stops before its publish leaves table and state alone; the rerun completes it."""
    table = KeyedTable(t.spark, work_dir(t.spark, "commit"), ORDER)
    table.load(t.orders, state={"mark": 0})

    def stop():
        raise RuntimeError("executor lost")

    try:
        table.commit(mixed_order_changes(t), state={"mark": 7}, before_publish=stop)
    except RuntimeError:
        pass
    if table.state() != {"mark": 0}:
        raise AssertionError("state moved without its rows")
    table.commit(mixed_order_changes(t), state={"mark": 7})
    return table.read()
