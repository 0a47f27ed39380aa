"""Nested records built from single rows of the tables, so no list grows with a hot key."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import values as N
from tidemark.operators import nested as S
from tidemark.queries.registry import Tables, query


def order_records(t: Tables):
    """Orders with up to three checks, each with up to two selections; no list at all on every ninth order."""
    k = F.col("o_orderkey")

    def some(n, limit, make):
        return F.transform(F.filter(F.array(*[F.lit(i) for i in range(limit)]), lambda i: i < n), make)

    def check(i):
        selections = some((k + i) % 3, 2, lambda j: F.struct(
            (k * 100 + i * 10 + j).alias("id"), F.concat(F.lit("item-"), j.cast("string")).alias("name"),
            F.struct((F.col("o_custkey") + j).alias("id")).alias("tax")))
        return F.struct((k * 10 + i).alias("id"), (F.col("o_custkey") + i).alias("amount"), selections.alias("selections"))

    checks = F.when(k % 9 != 0, some(k % 4, 3, check))
    return t.orders.select(
        k.alias("id"), F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderpriority").alias("level"),
                                                          F.year("o_orderdate").alias("year")).alias("rank")).alias("customer"),
        F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("o_orderstatus", "o_orderpriority")).alias("tags"),
        checks.alias("checks"))


# SQL of the same records, one row per check and one per selection
CHECKS = """
checks AS (SELECT o_orderkey AS order_id, o_orderkey * 10 + i AS id, o_custkey + i AS amount, i, o_custkey, o_orderstatus, o_orderpriority, o_orderdate
  FROM (SELECT *, unnest(range(o_orderkey % 4)) AS i FROM orders WHERE o_orderkey % 9 <> 0)),
selections AS (SELECT id AS check_id, order_id, order_id * 100 + i * 10 + j AS id, 'item-' || j AS name, o_custkey + j AS tax_id, i, j
  FROM (SELECT *, unnest(range((order_id + i) % 3)) AS j FROM checks))
"""

CHECKS_JSON = """
sel_json AS (SELECT check_id, '[' || string_agg('{"id":' || id || ',"name":"' || name || '","tax":{"id":' || tax_id || '}}', ',' ORDER BY j) || ']' AS js FROM selections GROUP BY 1),
check_json AS (SELECT order_id, '[' || string_agg('{"id":' || c.id || ',"amount":' || amount || ',"selections":' || coalesce(js, '[]') || '}', ',' ORDER BY i) || ']' AS js
  FROM checks c LEFT JOIN sel_json s ON s.check_id = c.id GROUP BY 1)
"""

FLAT = """SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer_id, o_orderpriority AS customer_rank_level, year(o_orderdate)::INTEGER AS customer_rank_year"""
TAGS = """'["' || o_orderstatus || '","' || o_orderpriority || '"]'"""


@query("nst01_flatten", f"""
WITH {CHECKS}, {CHECKS_JSON}
{FLAT}, CASE WHEN o_orderkey % 5 <> 0 THEN {TAGS} END AS tags, js AS checks
FROM orders LEFT JOIN check_json ON order_id = o_orderkey
""")
def flatten(t: Tables):
    return S.flatten(order_records(t))


@query("nst02a_empty_list_kept", f"""
WITH {CHECKS}, {CHECKS_JSON}
{FLAT}, CASE WHEN o_orderkey % 5 <> 0 THEN {TAGS} ELSE '[]' END AS tags, coalesce(js, '[]') AS checks
FROM orders LEFT JOIN check_json ON order_id = o_orderkey
""")
def flatten_empty_kept(t: Tables):
    return S.flatten(order_records(t), empty_list="[]")


@query("nst02b_text_list_joined", f"""
{FLAT}, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus || ',' || o_orderpriority END AS tags FROM orders
""")
def flatten_joined(t: Tables):
    return S.flatten(order_records(t), lists="comma", exclude=["checks"])


@query("nst02c_empty_struct_null", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN '{"a":' || o_custkey || ',"b":' || CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}' END AS info FROM orders
""")
def flatten_empty_struct(t: Tables):
    k = F.col("o_orderkey")
    rows = t.orders.select(k.alias("id"), F.struct(
        F.when(k % 3 != 0, F.col("o_custkey")).alias("a"),
        F.when((k % 3 != 0) & (k % 2 != 0), F.col("o_orderstatus")).alias("b")).alias("info"))
    return S.flatten(rows, structs="json", empty_struct_null=True)


@query("nst02d_depth_cap", """
SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer_id,
  '{"level":"' || o_orderpriority || '","year":' || year(o_orderdate) || '}' AS customer_rank FROM orders
""")
def flatten_depth(t: Tables):
    return S.flatten(order_records(t), max_depth=1, lists="drop")


@query("nst02e_excluded_fields", f"{FLAT} FROM orders")
def flatten_excluded(t: Tables):
    return S.flatten(order_records(t), exclude=["tags", "checks"])


@query("nst02f_nested_dropped", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def flatten_dropped(t: Tables):
    return S.flatten(order_records(t), structs="drop", lists="drop")


@query("nst02g_no_prefix", """
SELECT o_custkey AS id, o_orderstatus AS status, o_orderpriority AS level, year(o_orderdate)::INTEGER AS year FROM orders
""")
def flatten_no_prefix(t: Tables):
    """Child names without the parent's; a child overwrites a parent column of the same name."""
    return S.flatten(order_records(t), prefix=False, overwrite=True, lists="drop")


@query("nst02h_normal_names", """
SELECT o_orderkey AS order_id, o_orderstatus AS the_status_code, o_custkey AS who_cust_key FROM orders
""")
def flatten_names(t: Tables):
    import re

    rows = t.orders.select(F.col("o_orderkey").alias("Order ID"), F.col("o_orderstatus").alias("The-Status.Code"),
                           F.struct(F.col("o_custkey").alias("Cust Key")).alias("WHO"))
    return S.flatten(rows, name=lambda n: re.sub(r"\W", "_", n).lower())


@query("nst02i_indexed_lists", f"""
WITH {CHECKS}
SELECT o_orderkey AS id, max(c.id) FILTER (i = 0) AS checks_0_id, max(amount) FILTER (i = 0) AS checks_0_amount,
  max(c.id) FILTER (i = 1) AS checks_1_id, max(amount) FILTER (i = 1) AS checks_1_amount,
  max(c.id) FILTER (i = 2) AS checks_2_id, max(amount) FILTER (i = 2) AS checks_2_amount
FROM orders o LEFT JOIN checks c ON c.order_id = o.o_orderkey GROUP BY 1
""")
def flatten_indexed(t: Tables):
    rows = order_records(t).select("id", F.transform("checks", lambda c: F.struct(c["id"].alias("id"), c["amount"].alias("amount"))).alias("checks"))
    return S.flatten(rows, index_lists={"checks": 3})


@query("nst02j_semicolon_lists", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus || '; ' || o_orderpriority ELSE '' END AS tags FROM orders
""")
def flatten_semicolon(t: Tables):
    return S.flatten(order_records(t).select("id", "tags"), lists="semicolon", empty_list="[]")


@query("nst02k_named_fields_only", """
SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderpriority AS customer_level, '{"status":"' || o_orderstatus || '"}' AS other FROM orders
""")
def flatten_named(t: Tables):
    rows = t.orders.select(F.col("o_orderkey").alias("id"),
                           F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("level")).alias("customer"),
                           F.struct(F.col("o_orderstatus").alias("status")).alias("other"))
    return S.flatten(rows, only=["customer"])


@query("nst03_repeat_parent", f"""
WITH {CHECKS} SELECT order_id, o_orderstatus AS status, id AS check_id, amount FROM checks
""")
def repeat_parent(t: Tables):
    rows = order_records(t).select(F.col("id").alias("order_id"), "status", F.transform(
        "checks", lambda c: F.struct(c["id"].alias("check_id"), c["amount"].alias("amount"))).alias("checks"))
    return S.repeat_parent(rows, "checks", ["order_id", "status"])


@query("nst04_parent_and_child", f"""
WITH {CHECKS} SELECT 'parent' AS part, o_orderkey AS order_id, NULL::BIGINT AS id, o_orderstatus AS status, NULL::BIGINT AS amount FROM orders
UNION ALL SELECT 'child', order_id, id, NULL, amount FROM checks
""")
def parent_and_child(t: Tables):
    rows = order_records(t).withColumnRenamed("id", "order_id")
    parts = S.tree_rows(rows.select("order_id", "status", "checks"), "parent", {"parent": [("checks", "child")]}, key="order_id", name="part")
    return parts.select("part", F.coalesce("parent.order_id", "child.parent_order_id").alias("order_id"), "child.id", "parent.status", "child.amount")


@query("nst05_json_blob", f"""
WITH {CHECKS}, {CHECKS_JSON}
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 <> 0 THEN coalesce(js, '[]') END AS checks FROM orders LEFT JOIN check_json ON order_id = o_orderkey
""")
def json_blob(t: Tables):
    return S.json_columns(order_records(t).select("id", "checks"), ["checks"])


@query("nst06_child_with_position", f"""
WITH {CHECKS} SELECT order_id, i::INTEGER AS check_index, id, amount FROM checks
""")
def child_position(t: Tables):
    rows = order_records(t).withColumnRenamed("id", "order_id")
    return S.child_table(rows, ["order_id"], "checks", position="check_index").drop("selections")


@query("nst07_child_tree", f"""
WITH {CHECKS}
SELECT 'orders' AS tbl, o_orderkey AS id, NULL::BIGINT AS parent_id, o_orderstatus AS info, o_custkey AS extra FROM orders
UNION ALL SELECT 'orders_check', id, order_id, NULL, amount FROM checks
UNION ALL SELECT 'orders_check_selection', id, check_id, name, tax_id FROM selections
""")
def child_tree(t: Tables):
    tree = {"orders": [("checks", "orders_check")], "orders_check": [("selections", "orders_check_selection")]}
    rows = S.tree_rows(order_records(t), "orders", tree, flat={"orders": ["customer"], "orders_check_selection": ["tax"]})
    order, check, selection = (lambda c, x=x: F.col(f"{x}.{c}") for x in ("orders", "orders_check", "orders_check_selection"))
    return rows.select("tbl", F.coalesce(order("id"), check("id"), selection("id")).alias("id"),
                       F.coalesce(check("orders_id"), selection("orders_check_id")).alias("parent_id"),
                       F.coalesce(order("status"), selection("name")).alias("info"),
                       F.coalesce(order("customer_id"), check("amount"), selection("tax_id")).alias("extra"))


@query("nst08_expand", f"""
WITH {CHECKS} SELECT order_id AS id, o_orderstatus AS status, amount, 'orders.checks' AS tbl FROM checks
""")
def expand(t: Tables):
    name, rows = S.expand(order_records(t), "orders", "checks")
    return rows.drop("selections").withColumn("tbl", F.lit(name))


@query("nst09_two_level", """
SELECT p_partkey, 'size' AS variant, 's' || (p_size + j) AS option FROM part, (SELECT unnest(range(2)) AS j)
UNION ALL SELECT p_partkey, 'colour', p_name FROM part WHERE p_partkey % 2 = 0
""")
def two_level(t: Tables):
    size = F.col("p_size")
    variants = F.array(
        F.struct(F.lit("size").alias("variant"), F.array(*[F.concat(F.lit("s"), (size + j).cast("string")) for j in range(2)]).alias("options")),
        F.struct(F.lit("colour").alias("variant"), F.when(F.col("p_partkey") % 2 == 0, F.array("p_name")).alias("options")))
    rows = t.part.select("p_partkey", F.inline(variants))
    return rows.select("p_partkey", "variant", F.explode("options").alias("option"))


@query("nst10_map_rows", """
SELECT event_id, 'type' AS attribute_key, event_type AS attribute_value FROM events
UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events
UNION ALL SELECT event_id, 'k', 'u' || user_id FROM events
""")
def map_rows(t: Tables):
    attributes = F.create_map(F.lit("type"), F.array("event_type"), F.lit("k"),
                              F.array(F.get_json_object("props", "$.k"), F.concat(F.lit("u"), F.col("user_id").cast("string"))))
    return S.map_rows(t.events.select("event_id", attributes.alias("a")), ["event_id"], "a", "attribute_key", "attribute_value")


@query("nst11_named_values", """
SELECT p_partkey, p_brand AS brand, CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS kind, p_size::VARCHAR AS size FROM part
""")
def named_values(t: Tables):
    def pair(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    items = F.filter(F.array(pair("Size", F.col("p_size").cast("string")), pair("BRAND", F.col("p_brand")),
                             F.when(F.col("p_partkey") % 4 != 0, pair("kind", F.col("p_type")))), lambda e: e.isNotNull())
    return t.part.select("p_partkey", items.alias("items")).select("p_partkey", *S.named_values(F.col("items"), ["brand", "kind", "size"]))


@query("nst12_wide_to_long", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_quantity' AS keyword, l_quantity AS interest FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_tax', l_tax FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_discount', l_discount FROM lineitem
""")
def wide_to_long(t: Tables):
    rows = t.lineitem.withColumn("l_tax", F.when(F.col("l_returnflag") != "R", F.col("l_tax")))
    return S.wide_to_long(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                          ["l_quantity", "l_tax", "l_discount", "no_such_column"], "keyword", "interest")


@query("nst13_series_rows", """
SELECT event_id, event_type, make_timestamp(CAST(epoch_us(ts) // 1000000 * 1000000 AS BIGINT)) AS ts, value FROM events
UNION ALL SELECT event_id, event_type, make_timestamp(CAST((epoch_us(ts) // 1000000 + 15) * 1000000 AS BIGINT)), CASE WHEN user_id % 2 = 0 THEN user_id::DOUBLE END FROM events
""")
def series_rows(t: Tables):
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    points = F.array(
        F.struct(F.timestamp_seconds(second).cast("timestamp_ntz").alias("t"), F.col("value").cast("string").alias("v")),
        F.struct(F.timestamp_seconds(second + 15).cast("timestamp_ntz").alias("t"),
                 F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).otherwise("?").alias("v")))
    return S.series_rows(t.events.select("event_id", "event_type", points.alias("points")), ["event_id", "event_type"], "points")


@query("nst14_first_or_default", """
SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 4 = 0 THEN '' ELSE string_split(text, chr(10))[1] END, ''), '') AS first_line FROM documents
""")
def first_or_default(t: Tables):
    lines = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.split("text", "\n"))
    return t.documents.select("doc_id", N.first_or(lines, "").alias("first_line"))


@query("nst15_first_with_prefix", """
SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 'CWE-' || p_size END AS cwe FROM part
""")
def first_with_prefix(t: Tables):
    size = F.col("p_size").cast("string")
    lists = F.array(F.array(F.lit("other"), F.col("p_type")),
                    F.array(F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("CWE-"), size)).otherwise(size)),
                    F.array(F.when(F.col("p_partkey") % 3 != 0, F.lit("CWE-0")).otherwise("none")))
    return t.part.select("p_partkey", N.first_with_prefix(lists, "CWE-").alias("cwe"))


@query("nst16_first_item_object", """
SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS base_score, CASE WHEN p_partkey % 4 = 0 THEN 'UNKNOWN' ELSE p_type END AS severity FROM part
""")
def first_item_object(t: Tables):
    item = F.struct(F.col("p_size").alias("baseScore"), F.col("p_type").alias("baseSeverity"))
    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, F.array(item, item)).alias("metrics"))
    metrics = F.col("metrics")
    return rows.select("p_partkey", N.first_member(metrics, "baseScore").alias("base_score"),
                       N.first_member(metrics, "baseSeverity", "UNKNOWN").alias("severity"))


@query("nst17_pick_subfield", "SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer_id FROM orders")
def pick_subfield(t: Tables):
    rows = order_records(t).drop("tags", "checks")
    return rows.withColumn("customer_id", F.col("customer.id")).drop("customer")


@query("nst18_json_cells", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '{broken}' WHEN event_id % 7 = 0 THEN event_type ELSE props END AS raw,
  CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE replace(props, ' ', '') END AS parsed FROM events
""")
def json_cells(t: Tables):
    raw = F.when(F.col("event_id") % 5 == 0, "{broken}").when(F.col("event_id") % 7 == 0, F.col("event_type")).otherwise(F.col("props"))
    return t.events.select("event_id", raw.alias("raw")).withColumn("parsed", N.json_cell(F.col("raw")))


@query("nst19_json_in_text", """
SELECT conv_id, turn, CASE WHEN turn % 3 <> 2 THEN '{"n":{"turn":' || turn || '},"role":"' || role || '"}' END AS found FROM conversations
""")
def json_in_text(t: Tables):
    good = F.concat(F.translate("text", "{}", ""), F.lit("\n```json\n{\"role\": \""), "role", F.lit("\",\n \"n\": {\"turn\": "),
                    F.col("turn").cast("string"), F.lit("}}\n```\n"), F.translate("text", "{}", ""))
    bad = F.concat("text", F.lit(" {oops "), "text", F.lit(" }"))
    rows = t.conversations.select("conv_id", "turn", F.when(F.col("turn") % 3 != 2, good).otherwise(bad).alias("text"))
    return rows.select("conv_id", "turn", N.json_inside(F.col("text")).alias("found"))


@query("nst20_vector_text", """
SELECT vec_id, CASE vec_id % 5 WHEN 3 THEN 0 WHEN 4 THEN NULL ELSE len(embedding) END::INTEGER AS dims,
  CASE WHEN vec_id % 5 < 3 THEN CAST(embedding[1]::VARCHAR AS DOUBLE) END AS first_value,
  CASE WHEN vec_id % 5 < 3 THEN CAST(embedding[len(embedding)]::VARCHAR AS DOUBLE) END AS last_value FROM embeddings
""")
def vector_text(t: Tables):
    k, texts = F.col("vec_id"), F.transform("embedding", lambda x: x.cast("string"))
    text = (F.when(k % 5 == 0, F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))
            .when(k % 5 == 1, F.array_join(texts, ", "))
            .when(k % 5 == 2, F.concat(F.lit('["'), F.array_join(texts, '","'), F.lit('"]')))
            .when(k % 5 == 3, "[ ]").otherwise(F.concat(F.lit("["), F.array_join(texts, ","), F.lit(",x]"))))
    v = N.vector(F.col("t"))
    return t.embeddings.select("vec_id", text.alias("t")).select(
        "vec_id", F.size(v).alias("dims"), F.get(v, F.lit(0)).alias("first_value"),
        F.when(F.size(v) > 0, F.element_at(v, -1)).alias("last_value"))


@query("nst21_measures", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS temperature, l_tax AS longitude, CASE WHEN l_linestatus = 'O' THEN l_discount END AS latitude FROM lineitem
""")
def measures(t: Tables):
    """``{value: x}`` wrappers and coordinate lists to columns."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.struct(
        F.struct(F.col("l_quantity").alias("value"), F.lit("unit").alias("unitCode")).alias("temperature"),
        F.struct(F.when(F.col("l_linestatus") == "O", F.array("l_tax", "l_discount")).otherwise(F.array("l_tax")).alias("coordinates")).alias("geometry")).alias("p"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("p.temperature.value").alias("temperature"),
                       F.get("p.geometry.coordinates", F.lit(0)).alias("longitude"), F.get("p.geometry.coordinates", F.lit(1)).alias("latitude"))


@query("nst22_mixed_children", f"""
WITH {CHECKS}
SELECT o_orderkey AS id, 'tags' AS tbl, pos::INTEGER AS pos, CASE pos WHEN 0 THEN o_orderstatus ELSE o_orderpriority END AS value, NULL::BIGINT AS amount
FROM orders, (SELECT unnest(range(2)) AS pos) WHERE o_orderkey % 5 <> 0
UNION ALL SELECT order_id, 'checks', i::INTEGER, NULL, amount FROM checks
""")
def mixed_children(t: Tables):
    """Lists of objects are spread, lists of scalars come under ``value``."""
    rows = S.element_rows(order_records(t), ["id"], ["tags", "checks"])
    return rows.select("id", "tbl", "pos", F.col("tags").alias("value"), "checks.amount")


@query("nst23_payload", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN replace(props, ' ', '') WHEN 1 THEN '{"raw_data":"' || event_type || '"}'
  ELSE '{"raw_data_base64":"' || base64('\\xFF'::BLOB || encode(event_type)) || '"}' END AS data FROM events
""")
def payload(t: Tables):
    k, text = F.col("event_id"), F.encode("event_type", "UTF-8")
    body = F.when(k % 3 == 0, F.encode("props", "UTF-8")).when(k % 3 == 1, text).otherwise(F.concat(F.unhex(F.lit("FF")), text))
    return t.events.select("event_id", N.payload(body).alias("data"))
