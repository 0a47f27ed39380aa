"""Choosing the new rows of a run."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.operators import cursors as I
from tidemark.operators import joins, summary
from tidemark.plans.store import KeyedTable
from tidemark.plans.zoned_table import ZonedTable
from tidemark.queries.registry import Tables, query
from tidemark.session import materialise, work_dir

D98 = datetime(1998, 1, 1)
SLIM = ["o_orderkey", "o_custkey", "o_orderdate"]


def slim(t: Tables):
    return t.orders.select(*SLIM)


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("inc01_strictly_newer", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def strictly_newer(t: Tables):
    return slim(t).filter(I.newer(F.col("o_orderdate"), D98))


@query("inc02_newer_or_equal", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def newer_or_equal(t: Tables):
    return slim(t).filter(I.newer(F.col("o_orderdate"), D98, inclusive=True))


@query("inc03_overlap", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-14 22:00:00'")
def overlap(t: Tables):
    return t.events.select("event_id", "ts").filter(I.newer_with_overlap(F.col("ts"), datetime(2024, 1, 15), timedelta(hours=2)))


@query("inc03b_overlap_upsert", """
SELECT event_id, ts, CASE WHEN ts > TIMESTAMP '2024-01-14 22:00:00' THEN 'late' ELSE event_type END AS event_type, false AS _deleted FROM events
""")
def overlap_upsert(t: Tables):
    """Rows read again inside the overlap replace the stored ones."""
    e = t.events.select("event_id", "ts", "event_type")
    stored = e.filter(F.col("ts") <= day("2024-01-15"))
    again = e.withColumn("event_type", F.lit("late")).filter(I.newer_with_overlap(F.col("ts"), datetime(2024, 1, 15), timedelta(hours=2)))
    return C.apply_changes(stored, C.upserts(again, 1), ["event_id"])


@query("inc04_keyset", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-01', 500)
""")
def keyset(t: Tables):
    return slim(t).filter(I.after_position(["o_orderdate", "o_orderkey"], [D98, 500]))


@query("inc05_id_steps", "SELECT ((o_orderkey - 0) // 1000)::BIGINT AS step, count(*) AS rows, max(o_orderkey) AS mark FROM orders GROUP BY 1")
def id_steps(t: Tables):
    return I.id_steps(slim(t), "o_orderkey", 0, 1000).groupBy("step").agg(F.count("*").alias("rows"), F.max("o_orderkey").alias("mark"))


@query("inc06_offset", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey OFFSET 70")
def offset(t: Tables):
    return I.after_offset(t.customer.select("c_custkey", "c_name"), ["c_custkey"], 70)


@query("inc07_time_windows", """
SELECT floor((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-01-01') - 1) / 2592000000000.0)::BIGINT AS window_no, count(*) AS rows, max(o_orderdate) AS last
FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01' GROUP BY 1
""")
def time_windows(t: Tables):
    start = datetime(1995, 1, 1)
    rows = slim(t).filter(I.newer(F.col("o_orderdate"), start))
    return (rows.withColumn("window_no", I.window_number(F.col("o_orderdate"), start, timedelta(days=30)))
            .groupBy("window_no").agg(F.count("*").alias("rows"), F.max("o_orderdate").alias("last")))


@query("inc07b_window_batches", """
SELECT o_orderkey, o_orderdate, ((year(o_orderdate) - 1995) // 3)::INTEGER AS batch FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01'
""")
def window_batches(t: Tables):
    """One batch per window, the mark is the window's end."""
    rows, out = slim(t).select("o_orderkey", "o_orderdate"), None
    mark, last, cuts = datetime(1995, 1, 1), rows.agg(F.max("o_orderdate")).first()[0], []
    while last is not None and (not cuts or cuts[-1] < last):  # windows of three years until the newest row
        cuts.append(datetime(1998 + 3 * len(cuts), 1, 1) - timedelta(microseconds=1))
    for n, cut in enumerate(cuts):
        batch = rows.filter(I.in_window(F.col("o_orderdate"), mark, cut)).withColumn("batch", F.lit(n))
        out, mark = (batch if out is None else out.unionByName(batch)), cut
    return out


@query("inc08_mark_per_parent", """
WITH m AS (SELECT o_custkey AS k, max(o_orderdate) AS mark FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o_orderkey, o_custkey, o_orderdate FROM orders LEFT JOIN m ON k = o_custkey WHERE mark IS NULL OR o_orderdate > mark
""")
def mark_per_parent(t: Tables):
    marks = summary.marks_by(t.orders.filter(F.col("o_orderstatus") == "F"), ["o_custkey"], "o_orderdate")
    return joins.newer_children(slim(t), marks, "o_custkey", "o_orderdate")


@query("inc09_bootstrap_then_update", """
SELECT event_id, ts, 'bootstrap' AS phase FROM events WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT event_id, ts, 'update' FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') - INTERVAL 60 SECOND
""")
def bootstrap_then_update(t: Tables):
    e = t.events.select("event_id", "ts")
    landed = e.filter(F.col("ts") < day("2024-01-20"))
    first = landed.filter(I.bootstrap_or_update({}, "event_id", "ts", timedelta(seconds=60))).withColumn("phase", F.lit("bootstrap"))
    state = {"mode": "update", "mark": landed.agg(F.max("ts")).first()[0]}
    later = e.filter(I.bootstrap_or_update(state, "event_id", "ts", timedelta(seconds=60))).withColumn("phase", F.lit("update"))
    return first.unionByName(later)


@query("inc10_recent_then_backfill", """
SELECT event_id, ts, CASE WHEN ts > TIMESTAMP '2024-01-20' THEN 1 WHEN ts > TIMESTAMP '2024-01-11' THEN 2 ELSE 3 END::INTEGER AS run
FROM events WHERE ts > TIMESTAMP '2024-01-02' AND ts <= TIMESTAMP '2024-01-30'
""")
def recent_then_backfill(t: Tables):
    """Three runs of ten one-day steps; later runs start with an empty forward window."""
    e, out, state = t.events.select("event_id", "ts"), None, None
    for run in (1, 2, 3):
        steps, state = I.backfill_steps(datetime(2024, 1, 30), datetime(2024, 1, 2), timedelta(days=1), 10, state)
        inside = F.lit(False)
        for after, up_to in steps:
            inside = inside | I.in_window(F.col("ts"), after, up_to)
        rows = e.filter(inside).withColumn("run", F.lit(run))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("inc11_new_table", """
SELECT 'orders' AS table_name, count(*) AS rows FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_shipdate > TIMESTAMP '1990-01-01'
UNION ALL SELECT 'events', count(*) FROM events WHERE ts > TIMESTAMP '2024-01-10'
""")
def new_table(t: Tables):
    """Known tables go on from their mark, a table not seen before starts at the initial one."""
    state = {"tables": {"orders": D98, "events": datetime(2024, 1, 10)}}
    marks = {r["table_name"]: r["mark"] for r in I.table_marks(t.spark, ["orders", "lineitem", "events"], state, datetime(1990, 1, 1)).collect()}
    out = None
    for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")):
        one = getattr(t, name).filter(I.newer(F.col(column), marks[name])).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("inc12_coarse_date", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderstatus <> 'F')
""")
def coarse_date(t: Tables):
    mark = day("1998-01-01")
    taken = t.orders.filter((F.col("o_orderdate") == mark) & (F.col("o_orderstatus") == "F")).select("o_orderkey")
    return I.coarse_date(slim(t), "o_orderdate", "o_orderkey", D98, taken).select(*SLIM)


@query("inc13_client_filter", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS changed FROM orders WHERE o_orderstatus = 'P' OR o_orderdate > TIMESTAMP '1998-01-01'
""")
def client_filter(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("changed"))
    return I.client_filter(rows, "changed", D98)


@query("inc13b_client_filter_counts", """
SELECT count(*) FILTER (o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1998-01-01') AS synced, count(*) FILTER (NOT (o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1998-01-01')) AS skipped FROM orders
""")
def client_filter_counts(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("changed"))
    return I.client_filter_counts(rows, "changed", D98, missing="drop")


RUNS = 4


@query("inc16_resume_after_cap", f"""
SELECT o_orderkey, o_orderdate, (1 + (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // (1 + (SELECT count(*) FROM orders) // {RUNS}))::INTEGER AS run FROM orders
""")
def resume_after_cap(t: Tables):
    """Capped runs, each from the position the run before stored, until nothing is left."""
    rows, order = slim(t).select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]
    cap = 1 + rows.count() // RUNS
    out, mark = None, None
    for run in range(1, RUNS + 2):
        batch = materialise(I.capped(rows, order, mark, cap), "capped").withColumn("run", F.lit(run))
        after = I.position_of(batch, order, mark)
        if after == mark:
            break
        out, mark = (batch if out is None else out.unionByName(batch)), after
    return out


@query("srt05_capped_pull", """
SELECT o_orderkey, o_orderdate FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-01', 500) ORDER BY o_orderdate, o_orderkey LIMIT 100
""")
def capped_pull(t: Tables):
    return I.capped(slim(t).select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], [D98, 500], 100, heap=True)


@query("srt05b_capped_share", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem QUALIFY row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) <= (SELECT count(*) // 3 FROM lineitem)
""")
def capped_share(t: Tables):
    """A pull that takes a third of the table."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return I.capped(rows, ["l_shipdate", "l_orderkey", "l_linenumber"], None, rows.count() // 3)


@query("inc17_log_position", """
SELECT o_orderkey, upper(printf('%010x', o_custkey)) AS commitseq, upper(printf('%010x', o_orderkey)) AS intentseq FROM orders
WHERE (o_custkey, o_orderkey) > (50, 300)
""")
def log_position(t: Tables):
    """Hex positions of equal length compare as text."""
    log = t.orders.select("o_orderkey", F.lpad(F.hex("o_custkey"), 10, "0").alias("commitseq"), F.lpad(F.hex("o_orderkey"), 10, "0").alias("intentseq"))
    return log.filter(I.after_position(["commitseq", "intentseq"], [f"{50:010X}", f"{300:010X}"]))


@query("inc18_lagged_end", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-27'")
def lagged_end(t: Tables):
    test = I.lagged_window(F.col("ts"), datetime(2024, 1, 31), first_run=False, lag=timedelta(days=4), first_back=timedelta(days=60), back=timedelta(days=25))
    return t.events.select("event_id", "ts").filter(test)


@query("inc18b_lagged_end_first_run", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2023-12-02' AND ts < TIMESTAMP '2024-01-27'")
def lagged_end_first(t: Tables):
    test = I.lagged_window(F.col("ts"), datetime(2024, 1, 31), first_run=True, lag=timedelta(days=4), first_back=timedelta(days=60), back=timedelta(days=25))
    return t.events.select("event_id", "ts").filter(test)


@query("inc19_full_without_state", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def full_without_state(t: Tables):
    state: dict = {}
    return slim(t).filter(I.newer(F.col("o_orderdate"), state.get("mark")))


@query("inc20_run_start_mark", """
SELECT event_id, ts, CASE WHEN ts <= TIMESTAMP '2024-01-12' THEN 1 ELSE 2 END::INTEGER AS run FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'
""")
def run_start_mark(t: Tables):
    """The next mark is the start of the run, and a run reads up to its own start: nothing falls between runs."""
    e, mark, out = t.events.select("event_id", "ts"), datetime(2024, 1, 5), None
    for run, started in ((1, datetime(2024, 1, 12)), (2, datetime(2024, 1, 25))):
        rows = e.filter(I.in_window(F.col("ts"), mark, started)).withColumn("run", F.lit(run))
        out, mark = (rows if out is None else out.unionByName(rows)), started
    return out


@query("inc00_state_runs", "SELECT o_orderkey, o_custkey, o_orderdate, false AS _deleted FROM orders")
def state_runs(t: Tables):
    """Two runs over a stored table; the second reads beyond the mark that was committed with the first."""
    table = KeyedTable(t.spark, work_dir(t.spark, "runs"), ["o_orderkey"])
    early = slim(t).filter(F.col("o_orderdate") < day("1998-01-01"))
    table.load(early, state={"mark": early.agg(F.max("o_orderdate").cast("string")).first()[0]})
    fresh = slim(t).filter(I.newer(F.col("o_orderdate"), datetime.fromisoformat(table.state()["mark"])))
    table.commit(C.upserts(fresh, 1), state={"mark": fresh.agg(F.max("o_orderdate").cast("string")).first()[0]})
    return table.read()


@query("inc01b_newer_by_zones", "SELECT event_id, ts, user_id, least(4, (n - 1) // per + 1)::INTEGER AS page FROM (SELECT *, row_number() OVER (ORDER BY ts) AS n, (count(*) OVER () + 3) // 4 AS per FROM events)")
def newer_by_zones(t: Tables):
    """Four capped runs over files with zones: each finds its end by the counts of the files, and opens only files behind the mark."""
    rows = t.events.select("event_id", "ts", "user_id")
    n = rows.count()
    table = ZonedTable(t.spark, work_dir(t.spark, "zoned"), "ts", file_rows=max(1, n // 10))
    half = rows.agg(F.percentile_approx("ts", 0.5)).first()[0]
    table.append(rows.filter(F.col("ts") > half))
    table.append(rows.filter(F.col("ts") <= half))
    mark, out = None, None
    for page in range(1, 5):
        got, mark = table.page(-(-n // 4), mark)
        got = got.withColumn("page", F.lit(page))
        out = got if out is None else out.unionByName(got)
    return out
