"""Projections, filters, joins, aggregates, order-dependent operators, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import changes as C
from tidemark.operators import compare, joins, nested, project, summary, windows
from tidemark.operators import keysets as K
from tidemark.operators.cursors import until_known
from tidemark.plans.store import KeyedTable
from tidemark.queries.nested import order_records
from tidemark.queries.registry import Tables, query
from tidemark.session import materialise, work_dir
from tidemark.sources.files import interval_scan

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# -- projections -------------------------------------------------------------------


@query("prj01_include_exclude", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem")
def include_exclude(t: Tables):
    return project.include_exclude(t.lineitem, include=["L_ORDERKEY", "l_linenumber", "L_PartKey", "l_suppkey", "l_quantity", "l_shipdate", "l_tax"],
                                   exclude=["L_TAX"], unwanted_types=["timestamp_ntz"])


@query("prj02_allow_list", """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate, NULL::VARCHAR AS closed_at FROM orders
""")
def allow_list(t: Tables):
    declared = {"o_orderkey": "LONG", "o_orderstatus": "STRING", "o_orderdate": "UTC_DATETIME", "closed_at": "UTC_DATETIME", "absent": "INT"}
    return project.allow_list(t.orders, declared, ["yyyy-MM-dd HH:mm:ss"])


@query("prj03_rename", "SELECT event_id AS id, ts AS created, user_id AS submitted_by, event_type, value, props FROM events")
def rename(t: Tables):
    return project.rename_by(t.events, {"event_id": "id", "ts": "created", "user_id": "submitted_by", "guid": "id2"})


@query("prj04_normal_names", r"""
SELECT p_partkey, lower(regexp_replace(p_brand || ' (' || p_type || ')', '[^\w]', '_', 'g')) AS column_name,
  lower(replace(p_type, '-', '_')) || '_' || p_partkey AS table_name,
  CASE WHEN p_size % 10 = 0 THEN 'field_' || p_size || '_units__q' || p_size ELSE 'customer_name__q' || p_size END AS labelled,
  CASE WHEN p_partkey % 3 = 0 THEN 'submitted_by' ELSE p_type END AS safe FROM part
""")
def normal_names(t: Tables):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    label = F.when(F.col("p_size") % 10 == 0, F.concat(size, F.lit("  units!"))).otherwise(" Customer--Name? ")
    return t.part.select(
        "p_partkey", X.normal_name(F.concat("p_brand", F.lit(" ("), "p_type", F.lit(")"))).alias("column_name"),
        X.table_name_of_file(F.concat(F.lit("2024-01-31-"), "p_type", F.lit("-"), k.cast("string"), F.lit("__.csv"))).alias("table_name"),
        X.labelled_name(label, F.concat(F.lit("Q"), size)).alias("labelled"),
        X.keyword_safe(F.when(k % 3 == 0, "BY").otherwise(F.col("p_type"))).alias("safe"))


@query("prj06_drop_marked", """
SELECT o_orderkey AS id, o_custkey AS customer_id, '[{"code":"' || o_orderstatus || '"}]' AS codes FROM orders
""")
def drop_marked(t: Tables):
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), F.lit("W/1").alias("@odata.etag"),
        F.struct(F.col("o_custkey").alias("id"), F.lit("x").alias("id@odata.type")).alias("customer"),
        F.array(F.struct(F.col("o_orderstatus").alias("code"), F.lit("y").alias("@odata.link"))).alias("codes"))
    clean = project.drop_marked(rows)
    return nested.flatten(clean)


@query("prj07_constants", """
SELECT event_id, event_type, 'events' AS source_table, TIMESTAMP '2024-02-01 00:00:00' AS run_at, 'daily' AS report_type FROM events
""")
def constants(t: Tables):
    return project.with_constants(t.events.select("event_id", "event_type"), source_table="events", report_type="daily",
                                  run_at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("prj08_fill_by_class", """
SELECT c_custkey, coalesce(n, 0) AS number_orders, coalesce(flag, '[]') AS order_problems, coalesce(flag, '') AS note
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(CASE WHEN o_orderstatus = 'P' THEN 'P' END) AS flag FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def fill_by_class(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("number_orders"),
                                              F.max(F.when(F.col("o_orderstatus") == "P", "P")).alias("order_problems"))
    both = t.customer.select("c_custkey").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    return project.fill_by_class(both.withColumn("note", F.col("order_problems")))


@query("prj09_nan_to_null", f"SELECT {LINE_SQL}, CASE WHEN l_discount <> 0 THEN l_tax END AS share FROM lineitem")
def nan_to_null(t: Tables):
    share = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    return project.nan_to_null(t.lineitem.select(*LINE, share.alias("share")))


@query("prj10_fixed_paths", """
SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderpriority AS level,
  CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 4 > 1 THEN o_custkey + 1 END AS second_amount,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS first_tag FROM orders
""")
def fixed_paths(t: Tables):
    return order_records(t).select("id", F.col("customer.id").alias("customer_id"), F.col("customer.rank.level").alias("level"),
                                   F.get("checks", F.lit(1))["amount"].alias("second_amount"), F.get("tags", F.lit(0)).alias("first_tag"))


@query("prj11_flags_defaults", """
SELECT o_orderkey, o_orderkey % 4 = 0 AS merged, CASE WHEN o_orderkey % 3 = 0 THEN true ELSE false END AS draft,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS login FROM orders
""")
def flags_defaults(t: Tables):
    k = F.col("o_orderkey")
    rows = t.orders.select("o_orderkey", F.when(k % 4 == 0, F.col("o_orderdate")).alias("merged_at"), F.when(k % 3 == 0, F.lit(True)).alias("draft"),
                           F.when(k % 5 != 0, F.struct(F.col("o_custkey").alias("login"))).alias("user"))
    return rows.select("o_orderkey", project.present(F.col("merged_at")).alias("merged"),
                       F.coalesce("draft", F.lit(False)).alias("draft"), F.col("user.login").alias("login"))


# -- filters -----------------------------------------------------------------------


@query("flt01_id_filter", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (2, 5) AND o_custkey IN (1, 2, 3, 4, 7, 8, 10, 11, 13)
""")
def id_filter(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return rows.filter(project.id_filter(F.col("o_custkey"), include="1, 2,3,4,7,8,10,11,13", exclude="2,5"))


@query("flt02_member_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup')")
def member_filter(t: Tables):
    return t.events.select("event_id", "event_type").filter(project.member_filter(F.col("event_type"), "error, signup"))


@query("flt03_relevant", """
SELECT doc_id, lang FROM documents WHERE doc_id % 4 = 0 OR lang IN ('de', 'fr') OR contains(lower(text), 'license')
""")
def relevant(t: Tables):
    codes = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source"))
    return t.documents.filter(project.relevant(codes, ["de", "fr"], F.col("text"), "License")).select("doc_id", "lang")


@query("flt04_filter_list", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 50000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '%H%'
  AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderpriority IS NOT NULL
""")
def filter_list(t: Tables):
    filters = [{"field": "o_totalprice", "function": "greaterThanOrEqual", "argument": 50000.0},
               {"field": "o_orderstatus", "function": "isIn", "argument": ["F", "O"]},
               {"field": "o_orderpriority", "function": "contains", "argument": "H"},
               {"field": "o_orderpriority", "function": "notBlank"}]
    cursor = F.col("o_orderdate") > F.lit("1996-01-01").cast("timestamp_ntz")
    return t.orders.filter(project.filter_list(filters) & cursor).select("o_orderkey", "o_totalprice")


@query("flt05_missing_key", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'")
def missing_key(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return project.with_key(rows, ["o_orderkey", "o_custkey"])


@query("flt05b_missing_key_report", "SELECT count(*) FILTER (o_orderstatus <> 'P') AS kept, count(*) FILTER (o_orderstatus = 'P') AS dropped FROM orders")
def missing_key_report(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return project.missing_key_report(rows, ["o_orderkey", "o_custkey"])


@query("flt07_wanted_metrics", "SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'purchase')")
def wanted_metrics(t: Tables):
    wanted = t.spark.createDataFrame([("view",), ("purchase",), ("not_there",)], "event_type string")
    return t.events.select("event_id", "event_type").join(wanted, "event_type", "left_semi")


# -- joins ---------------------------------------------------------------------------


@query("jon01_look_up", """
SELECT c_custkey, coalesce(n_name, 'col_' || c_nationkey) AS title FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON n_nationkey = c_nationkey
""")
def look_up(t: Tables):
    known = t.nation.filter(F.col("n_regionkey") != 0).withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.look_up(t.customer, known, "c_nationkey", "n_name").select("c_custkey", "title")


@query("jon02_three_way_default", """
WITH s AS (SELECT s_nationkey, max(s_name) AS best, count(*) AS n FROM supplier GROUP BY 1),
m AS (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)
SELECT c_custkey, CASE WHEN m.n_nationkey IS NULL THEN 'unmapped' ELSE s.best END AS best, CASE WHEN m.n_nationkey IS NULL THEN 0 ELSE s.n END AS suppliers
FROM customer LEFT JOIN m ON m.n_nationkey = c_nationkey LEFT JOIN s ON s_nationkey = c_nationkey
""")
def three_way(t: Tables):
    result = t.supplier.groupBy("s_nationkey").agg(F.max("s_name").alias("best"), F.count("*").alias("suppliers"))
    mapped = t.nation.filter(F.col("n_regionkey") != 0).select("n_nationkey")
    both = (t.customer.join(mapped, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(result, F.col("c_nationkey") == F.col("s_nationkey"), "left"))
    return both.select("c_custkey", *joins.three_way(F.col("n_nationkey").isNotNull(), F.col("s_nationkey").isNotNull(),
                                                     {"best": ("unmapped", F.col("best")), "suppliers": (0, F.col("suppliers"))}))


@query("jon03_newer_children", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 3 <> 0
WHERE c_custkey IS NULL OR o_orderdate > TIMESTAMP '1998-01-01' + to_days((c_custkey % 365)::INTEGER)
""")
def newer_children(t: Tables):
    k = F.col("c_custkey")
    marks = t.customer.filter(k % 3 != 0).select(
        k.alias("o_custkey"), F.date_add(F.lit("1998-01-01").cast("date"), (k % 365).cast("int")).cast("timestamp_ntz").alias("mark"))
    return joins.newer_children(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), marks, "o_custkey", "o_orderdate")


@query("jon04_paired", "SELECT doc_id, n_chars > 500 AS long_text, quality FROM documents JOIN labels USING (doc_id) WHERE lang <> 'fr'")
def paired(t: Tables):
    left = t.documents.filter(F.col("lang") != "fr").select("doc_id", (F.col("n_chars") > 500).alias("long_text"))
    return joins.paired(left, t.labels.select("doc_id", "quality"), ["doc_id"])


@query("jon05_bridge", """
SELECT DISTINCT l_orderkey, l_partkey, p_name FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def bridge(t: Tables):
    links = t.lineitem.select("l_orderkey", F.array("l_partkey").alias("parts"))
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return nested.bridge(links, "l_orderkey", "parts", "l_partkey").join(names, "l_partkey")


def order_edges(t: Tables):
    single = nested.edges(t.orders, F.col("o_orderkey"), "order", F.col("o_custkey"), "customer", "placed_by")
    many = nested.edges(t.lineitem, F.col("l_orderkey"), "order", F.array("l_partkey", "l_suppkey"), "item", "contains", many=True, distinct=True)
    own = nested.edges(t.orders, F.col("o_orderkey"), "order", F.when(F.col("o_orderkey") > 0, F.col("o_orderkey") - 1), "order", "follows")
    return single.unionByName(many).unionByName(own)


EDGE_SQL = """
SELECT o_orderkey || '_placed_by_' || o_custkey AS edge_id, o_orderkey::VARCHAR AS from_id, 'order' AS from_type, o_custkey::VARCHAR AS to_id, 'customer' AS to_type, 'placed_by' AS relation FROM orders
UNION ALL SELECT * FROM (SELECT DISTINCT l_orderkey || '_contains_' || x, l_orderkey::VARCHAR, 'order', x::VARCHAR, 'item', 'contains' FROM (SELECT l_orderkey, unnest([l_partkey, l_suppkey]) AS x FROM lineitem))
UNION ALL SELECT o_orderkey || '_follows_' || (o_orderkey - 1), o_orderkey::VARCHAR, 'order', (o_orderkey - 1)::VARCHAR, 'order', 'follows' FROM orders WHERE o_orderkey > 0
"""


@query("jon06_edges", EDGE_SQL)
def edge_list(t: Tables):
    return order_edges(t)


@query("jon07_edge_pattern", """
SELECT o_orderkey || '_placed_by_' || o_custkey AS edge_id, o_orderstatus AS from_label, c_name AS to_label FROM orders JOIN customer ON c_custkey = o_custkey
""")
def edge_pattern(t: Tables):
    vertices = (t.orders.select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("label"))
                .unionByName(t.customer.select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("label"))))
    edges = order_edges(t).filter(F.col("relation") == "placed_by").select(
        "edge_id", F.concat_ws(":", "from_type", "from_id").alias("from_id"), F.concat_ws(":", "to_type", "to_id").alias("to_id"))
    return joins.pattern_pairs(vertices, edges, "id", "label").select("edge_id", "from_label", "to_label")


@query("jon09_missing_keys", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE'")
def missing_keys(t: Tables):
    return compare.missing_keys(t.customer, t.customer.filter(F.col("c_mktsegment") != "FURNITURE"), ["c_custkey"])


@query("jon09b_key_bits", "SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0")
def key_set_difference(t: Tables):
    """The keys of the last run are kept as bits; those that the source no longer has are found by and-not of 64 keys at a time."""
    last = materialise(K.key_bits(t.orders, "o_orderkey"), "keyset")
    now = K.key_bits(t.orders.filter(F.col("o_orderkey") % 11 != 0), "o_orderkey")
    return K.keys_of(K.without(last, now), "o_orderkey")


@query("jon10_compare_hashes", """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'D' WHEN p_size > 25 THEN 'U' ELSE '=' END AS verdict FROM part
UNION ALL SELECT p_partkey + 1000000000, 'I' FROM part WHERE p_brand = 'Brand#13'
""")
def compare_hashes(t: Tables):
    p = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    digest = compare.row_digest(["p_name", "p_retailprice"])
    after = p.filter(F.col("p_type") != "ECONOMY").withColumn(
        "p_retailprice", F.when(F.col("p_size") > 25, F.col("p_retailprice") * 2).otherwise(F.col("p_retailprice")))
    fresh = p.filter(F.col("p_brand") == "Brand#13").withColumn("p_partkey", F.col("p_partkey") + 1_000_000_000)
    return compare.compare_hashes(p.select("p_partkey", digest.alias("h")), after.unionByName(fresh).select("p_partkey", digest.alias("h")), ["p_partkey"], "h")


@query("jon11_open_combinations", """
WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
k AS (SELECT o_orderpriority AS kind, (CASE WHEN o_orderpriority < '4' THEN max(o_orderdate) FILTER (o_orderstatus = 'F') - INTERVAL 90 DAY END)::DATE AS mark FROM orders GROUP BY o_orderpriority)
SELECT kind, d::DATE AS day FROM (SELECT kind, mark, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM k, b) WHERE mark IS NULL OR d::DATE > mark
""")
def open_combinations(t: Tables):
    o = t.orders.withColumnRenamed("o_orderpriority", "kind")
    marks = (o.filter((F.col("kind") < "4") & (F.col("o_orderstatus") == "F")).groupBy("kind")
             .agg(F.date_sub(F.max("o_orderdate").cast("date"), 90).alias("mark")))
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return joins.open_combinations(bounds, "lo", "hi", o.select("kind").distinct(), "kind", marks)


FRONTIER_SQL = """
WITH links AS (SELECT l_partkey AS item, l_orderkey AS via FROM lineitem),
v0 AS (SELECT p_partkey AS item, 0 AS hop FROM part WHERE p_brand = 'Brand#13'),
h1 AS (SELECT l.item FROM links l WHERE l.via IN (SELECT via FROM links WHERE item IN (SELECT item FROM v0)) AND l.item NOT IN (SELECT item FROM v0)
  GROUP BY 1 ORDER BY count(*) DESC, item LIMIT 20),
v1 AS (SELECT * FROM v0 UNION ALL SELECT item, 1 FROM h1),
h2 AS (SELECT l.item FROM links l WHERE l.via IN (SELECT via FROM links WHERE item IN (SELECT item FROM h1)) AND l.item NOT IN (SELECT item FROM v1)
  GROUP BY 1 ORDER BY count(*) DESC, item LIMIT 20)
SELECT * FROM v1 UNION ALL SELECT item, 2 FROM h2
"""


REACHED_SQL = FRONTIER_SQL.replace("ORDER BY count(*) DESC, item LIMIT 20", "")


@query("jon12_frontier", FRONTIER_SQL)
def frontier(t: Tables):
    links = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("via"))
    seed = t.part.filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("item"))
    return joins.expand_frontier(seed, links, hops=2, step_limit=20)


@query("jon12b_frontier_whole", REACHED_SQL)
def frontier_whole(t: Tables):
    """Every id that two hops reach."""
    links = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("via"))
    seed = t.part.filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("item"))
    return joins.expand_frontier(seed, links, hops=2)


# -- aggregates ----------------------------------------------------------------------


@query("agg01_high_water_mark", "SELECT greatest(max(ts), TIMESTAMP '2024-01-02 00:00:00') AS mark FROM events")
def high_water_mark(t: Tables):
    return summary.high_water_mark(t.events, "ts", "2024-01-02 00:00:00")


@query("agg02_marks_by_entity", "SELECT o_custkey, max(o_orderdate) AS mark FROM orders GROUP BY 1")
def marks_by(t: Tables):
    return summary.marks_by(t.orders, ["o_custkey"], "o_orderdate")


@query("agg03_composite_mark", "SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def composite_mark(t: Tables):
    return summary.composite_mark(t.orders, ["o_orderdate", "o_orderkey"])


TOP_SQL = "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 5"


@query("agg04_top_counts", TOP_SQL)
def top_counts(t: Tables):
    return summary.top_counts(t.lineitem, ["l_partkey"], 5)


@query("agg05_conditional_counts", """
SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 100) AS large, count(*) AS total FROM events GROUP BY 1
""")
def conditional_counts(t: Tables):
    return t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors"),
                                           F.count_if(F.col("value") > 100).alias("large"), F.count("*").alias("total"))


@query("agg06_merge_counts", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1")
def merge_counts(t: Tables):
    """Two batches counted apart; the partial counts are added."""
    l = t.lineitem
    halves = [l.filter(F.col("l_linestatus") == "O"), l.filter(F.col("l_linestatus") != "O")]
    return summary.merge_counts(halves, ["l_partkey"])


@query("agg07_latest_fact", """
SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW') WHERE rn = 1
""")
def latest_fact(t: Tables):
    wanted = t.orders.filter(F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderpriority") != "5-LOW"))
    return summary.latest_fact(wanted, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], ["o_totalprice"])


@query("agg08_first_of_kind", """
SELECT doc_id, list_filter(string_split(text, ' '), lambda w: length(w) > 8)[1] AS first_long, list_filter(string_split(text, ' '), lambda w: length(w) <= 8)[1] AS first_short,
  len(string_split(text, ' '))::INTEGER AS total FROM documents
""")
def first_of_kind(t: Tables):
    """Parallel lists of kinds and words inside each document."""
    words = F.split("text", " ")
    rows = t.documents.select("doc_id", words.alias("words"), F.transform(words, lambda w: F.when(F.length(w) > 8, "long").otherwise("short")).alias("kinds"))
    return rows.select("doc_id", summary.first_of_kind(F.col("kinds"), F.col("words"), "long").alias("first_long"),
                       summary.first_of_kind(F.col("kinds"), F.col("words"), "short").alias("first_short"), F.size("words").alias("total"))


@query("agg09_batch_summary", """
SELECT event_type, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT user_id) AS users FROM events GROUP BY 1
""")
def batch_summary(t: Tables):
    return t.events.groupBy("event_type").agg(F.count("*").alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                              F.countDistinct("user_id").alias("users"))


@query("agg10_first_definitions", """
SELECT p_brand, p_type, min(p_partkey) AS first_at, arg_min(p_name, p_partkey) AS p_name, arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY 1, 2
""")
def first_definitions(t: Tables):
    return summary.first_definitions(t.part, "p_brand", "p_type", F.col("p_partkey"), ["p_name", "p_size"])


@query("agg11a_table_counts", """
SELECT 'orders' AS tbl, count(*) AS n FROM orders UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'customer', count(*) FROM customer
""")
def table_counts(t: Tables):
    out = None
    for name in ("orders", "part", "customer"):
        one = getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("agg11b_group_count", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def group_count(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("agg11c_price_filter", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice > 950")
def price_filter(t: Tables):
    return t.part.filter(F.col("p_retailprice") > 950).select("p_partkey", "p_name", "p_retailprice")


@query("agg11d_ordered_list", "SELECT c_name, c_custkey FROM customer ORDER BY c_name, c_custkey")
def ordered_list(t: Tables):
    return t.customer.select("c_name", "c_custkey").orderBy("c_name", "c_custkey")


@query("agg12_sum_or_zero", """
SELECT l_orderkey, coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R'), 0)::BIGINT AS returned FROM lineitem GROUP BY 1
""")
def sum_or_zero(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(
        summary.sum_or_zero(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint"))).alias("returned"))


@query("agg14_row_totals", f"""
SELECT {LINE_SQL}, l_quantity + l_linenumber AS total, l_discount > 0 AS has_discount, l_tax > 0 AS has_tax FROM lineitem
""")
def row_totals(t: Tables):
    return t.lineitem.select(*LINE, (F.col("l_quantity") + F.col("l_linenumber")).alias("total"),
                             (F.col("l_discount") > 0).alias("has_discount"), (F.col("l_tax") > 0).alias("has_tax"))


@query("agg15_top_as_text", f"""
SELECT string_agg('- ' || l_partkey || ': ' || n, chr(10) ORDER BY n DESC, l_partkey) AS text FROM ({TOP_SQL})
""")
def top_as_text(t: Tables):
    top = summary.top_counts(t.lineitem, ["l_partkey"], 5)
    line = F.format_string("- %s: %s", F.col("l_partkey").cast("string"), F.col("n").cast("string"))
    return summary.as_text(top, line, [(-F.col("n")).alias("o"), F.col("l_partkey")])


@query("agg16_child_counts", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE least(o_orderkey % 4, 3) END::INTEGER AS checks FROM orders")
def child_counts(t: Tables):
    return order_records(t).select("id", nested.child_count("checks").alias("checks"))


@query("agg17_assemble", """
SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations WHERE role <> 'system' GROUP BY 1
""")
def assemble(t: Tables):
    """Pieces that are not part of the answer are NULL and skipped."""
    pieces = t.conversations.withColumn("piece", F.when(F.col("role") != "system", F.col("text")))
    return summary.assemble(pieces, "conv_id", "turn", "piece")


@query("agg18_running_total", """
SELECT 1 AS run, count(*) AS total FROM events WHERE ts < '2024-01-10' UNION ALL SELECT 2, count(*) FROM events WHERE ts < '2024-01-20' UNION ALL SELECT 3, count(*) FROM events
""")
def running_total(t: Tables):
    """Three runs; each adds its rows to the total the state holds."""
    cuts = [F.lit(c).cast("timestamp_ntz") for c in ("2024-01-10", "2024-01-20")]
    run = F.when(F.col("ts") < cuts[0], 1).when(F.col("ts") < cuts[1], 2).otherwise(3)
    return summary.running_totals(t.events.withColumn("run", run), "run", [1, 2, 3])


@query("agg18b_totals_in_state", """
SELECT 1 AS run, count(*) AS n, sum(user_id)::BIGINT AS users, max(ts) AS newest FROM events WHERE ts < '2024-01-10'
UNION ALL SELECT 2, count(*), sum(user_id)::BIGINT, max(ts) FROM events WHERE ts < '2024-01-20' UNION ALL SELECT 3, count(*), sum(user_id)::BIGINT, max(ts) FROM events
""")
def totals_in_state(t: Tables):
    """Three commits, each reads its own rows only and merges their totals with those of the state; the second stops once before its publish, the third is sent twice."""
    table, out, stops = KeyedTable(t.spark, work_dir(t.spark, "totals"), ["event_id"]), [], [2]

    def stop():
        if run in stops:
            stops.remove(run)
            raise RuntimeError("lost")

    for run, (low, high) in enumerate((("2000-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2100-01-01")), 1):
        rows = interval_scan(t.events, "ts", low, high, ["event_id", "user_id", "ts"])
        part = summary.partial_totals(rows, ["user_id"], ["ts"], "user_id")
        for _ in range(2 if run > 1 else 1):
            try:
                summary.commit_with_totals(table, C.upserts(rows, run), part, ("runs", run), before_publish=stop)
            except RuntimeError:
                continue
        got = summary.totals_of_text(table.state()["totals"], part)
        out.append(got.select(F.lit(run).alias("run"), "n", F.col("sum_user_id").alias("users"), F.col("max_ts").alias("newest")))
    return out[0].unionByName(out[1]).unionByName(out[2])


# -- order-dependent operators ---------------------------------------------------------


@query("win01_keep_first", "SELECT event_id, ts, event_type, 1::INTEGER AS arrival FROM events")
def keep_first(t: Tables):
    e = t.events.select("event_id", "ts", "event_type")
    doubled = e.withColumn("arrival", F.lit(1)).unionByName(e.select("event_id", "ts", F.lit("copy").alias("event_type"), F.lit(2).alias("arrival")))
    return windows.keep_first(doubled, ["event_id"], ["ts", "arrival"]).orderBy("ts")


@query("win02_last_write", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders
""")
def last_write(t: Tables):
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    later = [o.withColumn("seq", F.lit(1)),
             o.filter(k % 2 == 0).select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderstatus"), F.lit(2).alias("seq")),
             o.filter(k % 3 == 0).select("o_orderkey", F.lit(None).cast("double").alias("o_totalprice"), F.lit("Z").alias("o_orderstatus"), F.lit(3).alias("seq"))]
    return windows.last_write(compare.append_batches(*later), ["o_orderkey"], ["seq"], ["o_totalprice", "o_orderstatus"])


CHUNKS_SQL = """
WITH RECURSIVE r AS ({rows}),
v AS (SELECT v, sum(count(*)) OVER (ORDER BY v)::BIGINT AS c FROM r GROUP BY v),
t AS (SELECT max(c) AS total FROM v),
chain AS (
  SELECT 0::BIGINT AS start, (SELECT coalesce(min(c), (SELECT total FROM t)) FROM v WHERE c >= {n})::BIGINT AS stop
  UNION ALL
  SELECT stop, (SELECT coalesce(min(c), (SELECT total FROM t)) FROM v WHERE c >= chain.stop + {n})::BIGINT FROM chain WHERE stop < (SELECT total FROM t))
SELECT l.v AS lower, u.v AS upper, stop - start AS rows FROM chain JOIN v u ON u.c = stop LEFT JOIN v l ON l.c = start
"""


@query("win03_chunk_bounds", CHUNKS_SQL.format(rows="SELECT o_orderdate AS v FROM orders", n=100))
def chunk_bounds(t: Tables):
    return windows.chunk_bounds(t.orders, "o_orderdate", 100)


@query("win03b_hot_value", CHUNKS_SQL.format(rows="SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS v FROM orders", n=25))
def chunk_bounds_hot(t: Tables):
    """A third of the rows share one value, and the chain runs over many blocks."""
    rows = t.orders.select(F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("v"))
    return windows.chunk_bounds(rows, "v", 25, span=500)


@query("win04_pages", """
SELECT c_custkey, ((row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) // 40)::BIGINT AS page, ((row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) % 40)::BIGINT AS page_index FROM customer
""")
def pages(t: Tables):
    return windows.pages(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 40).drop("c_acctbal")


@query("win05_at_newest", "SELECT o_orderdate, o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def at_newest(t: Tables):
    return windows.at_newest(t.orders, "o_orderdate", ["o_orderkey"])


@query("win06_versions", """
SELECT o_custkey, o_orderdate, o_orderkey, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
FROM (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2)
""")
def versions(t: Tables):
    rows = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderkey").alias("o_orderkey"))
    return windows.with_valid_to(rows, ["o_custkey"], "o_orderdate")


@query("win07_success_prefix", """
SELECT event_id, event_type FROM events WHERE event_id < (SELECT min(event_id) FROM events WHERE event_type = 'error' AND value > 150)
""")
def success_prefix(t: Tables):
    failed = (F.col("event_type") == "error") & (F.col("value") > 150)
    return windows.success_prefix(t.events, "event_id", failed).select("event_id", "event_type")


# -- sorts and limits --------------------------------------------------------------------


@query("srt01_by_cursor", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def by_cursor(t: Tables):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@query("srt02_limit_offset", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 60")
def limit_offset(t: Tables):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").offset(60).limit(50)


@query("srt03_budget", "SELECT doc_id, lang FROM documents WHERE lang <> 'en' ORDER BY doc_id LIMIT 20")
def budget(t: Tables):
    calls, calls_per_row = 60, 3
    return windows.first_rows(t.documents.filter(F.col("lang") != "en").select("doc_id", "lang"), ["doc_id"], calls // calls_per_row, heap=True)


@query("srt03b_budget_as_share", """
SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (ORDER BY lang, doc_id) <= (SELECT count(*) // 4 FROM documents)
""")
def budget_as_share(t: Tables):
    """A budget of a quarter of the table, in an order with a text in front."""
    rows = t.documents.select("doc_id", "lang")
    return windows.first_rows(rows, ["lang", "doc_id"], rows.count() // 4)


@query("srt04_stop_at_known", "SELECT event_id, event_type FROM events WHERE event_id > 400")
def stop_at_known(t: Tables):
    return t.events.filter(F.col("event_id") > 400).select("event_id", "event_type")


@query("srt04b_stop_at_known_ids", "SELECT event_id, ts, event_type FROM events WHERE (ts, event_id) > (SELECT (max(ts), arg_max(event_id, (ts, event_id))) FROM events WHERE ts < '2024-01-22')")
def stop_at_known_ids(t: Tables):
    """The ids of the last run come from its table: what is newer than the newest of them is read."""
    events = t.events.select("event_id", "ts", "event_type")
    table = KeyedTable(t.spark, work_dir(t.spark, "lastrun"), ["event_id"])
    table.load(interval_scan(events, "ts", "2024-01-15", "2024-01-22", ["event_id"]))
    return until_known(events, ["ts", "event_id"], table.read(), ["event_id"])


# -- set operations ------------------------------------------------------------------------


@query("set01_append", f"SELECT {LINE_SQL}, l_quantity, CASE WHEN l_linestatus <> 'O' THEN l_tax END AS l_tax FROM lineitem")
def append(t: Tables):
    l = t.lineitem.select(*LINE, "l_quantity", "l_tax", "l_linestatus")
    return compare.append_batches(l.filter(F.col("l_linestatus") == "O").drop("l_tax", "l_linestatus"),
                                  l.filter(F.col("l_linestatus") != "O").drop("l_linestatus"))


@query("set02_deleted_keys", "SELECT c_custkey FROM customer EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def deleted_keys(t: Tables):
    keys = t.customer.select("c_custkey")
    return keys.exceptAll(t.customer.filter(F.col("c_acctbal") > 0).select("c_custkey"))


@query("set03_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t: Tables):
    return compare.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("set04_distinct", "SELECT DISTINCT event_type, user_id FROM events")
def distinct(t: Tables):
    return t.events.select("event_type", "user_id").distinct()


@query("set05_intersection", "SELECT p_brand FROM part WHERE p_size > 25 INTERSECT SELECT p_brand FROM part WHERE p_type = 'ECONOMY'")
def intersection(t: Tables):
    return t.part.filter(F.col("p_size") > 25).select("p_brand").intersect(t.part.filter(F.col("p_type") == "ECONOMY").select("p_brand"))
