"""Catalogue rows, types and schemas of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.operators import schema as S
from tidemark.operators.cursors import infer_cursor
from tidemark.plans.run import TableSpec, plan_tables, run_specs
from tidemark.plans.merge_table import MergeTable
from tidemark.plans.store import KeyedTable
from tidemark.queries.registry import Tables, query
from tidemark.session import path_bytes, work_dir
from tidemark.sources import catalogue as K

# columns of the tables used here, as the SQL side must name them
COLUMNS = {
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")],
}
KEYS = {"part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"]}
DECLARED = {"bigint": "LONG", "string": "STRING", "int": "INT", "double": "DOUBLE", "timestamp_ntz": "NAIVE_DATETIME"}


def frames(t: Tables):
    return {n: getattr(t, n) for n in COLUMNS}


def catalogue_sql(extra=lambda table, name, kind: "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, {i}::INTEGER AS ordinal, '{kind}' AS data_type{extra(table, name, kind)} FROM {table}"
        for table, columns in COLUMNS.items() for i, (name, kind) in enumerate(columns, 1))


COUNTS = ", count(*) AS row_count, count({n}) AS filled"


@query("src13_catalogue", catalogue_sql(lambda table, n, kind: COUNTS.format(n=n)))
def catalogue(t: Tables):
    """Columns, types and positions, with how far each column is filled."""
    return K.columns_of(t.spark, frames(t)).join(K.filled_counts(frames(t)), ["table_name", "column_name"])


@query("jon08_catalogue_keys", catalogue_sql(lambda table, n, kind: f", {int(n in KEYS[table])}::INTEGER AS is_key" + COUNTS.format(n=n)))
def catalogue_keys(t: Tables):
    flagged = K.with_key_flag(K.columns_of(t.spark, frames(t)), K.keys_of(t.spark, KEYS))
    return flagged.join(K.filled_counts(frames(t)), ["table_name", "column_name"])


@query("sch01_declared_types", """
SELECT l_orderkey, l_linenumber::SMALLINT AS l_linenumber, l_partkey::INTEGER AS l_partkey, CAST(l_extendedprice AS DECIMAL(15,2))::VARCHAR AS price, l_discount, l_returnflag = 'R' AS returned,
  l_shipdate::DATE AS ship_day, l_shipdate AS shipped, encode(l_linestatus) AS raw, '{"flag":"' || l_returnflag || '","n":null}' AS info FROM lineitem
""")
def declared_types(t: Tables):
    """Text columns of lineitem under declared types, one column per kind."""
    text = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"), F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.col("l_partkey").cast("string").alias("l_partkey"), F.col("l_extendedprice").cast("decimal(15,2)").cast("string").alias("price"),
        F.col("l_discount").cast("string").alias("l_discount"), (F.col("l_returnflag") == "R").cast("string").alias("returned"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"), F.col("l_shipdate").cast("string").alias("shipped"),
        F.col("l_linestatus").alias("raw"), F.struct(F.col("l_returnflag").alias("flag"), F.lit(None).cast("int").alias("n")).alias("info"))
    typed = S.with_declared_types(text, {
        "l_orderkey": "LONG", "l_linenumber": "SHORT", "l_partkey": "INT", "price": {"type": "DECIMAL", "precision": 15, "scale": 2},
        "l_discount": "DOUBLE", "returned": "BOOLEAN", "ship_day": "NAIVE_DATE", "shipped": "NAIVE_DATETIME", "raw": "BINARY", "info": "JSON"})
    return typed.withColumn("price", F.col("price").cast("string"))


@query("sch02_inferred_types", r"""
SELECT c AS column_name, CASE max(CASE WHEN regexp_full_match(v, '[+-]?\d+') THEN CASE WHEN abs(v::HUGEINT) <= 2147483647 THEN 0 ELSE 1 END WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 2 ELSE 3 END)
  WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN 'double' ELSE 'string' END AS type_name
FROM (SELECT 'event_id' AS c, event_id::VARCHAR AS v FROM events UNION ALL SELECT 'large', (event_id + 3000000000)::VARCHAR FROM events UNION ALL SELECT 'value', value::VARCHAR FROM events
  UNION ALL SELECT 'event_type', event_type FROM events UNION ALL SELECT 'k', json_extract_string(props, '$.k') FROM events) GROUP BY 1
""")
def inferred_types(t: Tables):
    rows = t.events.select(F.col("event_id").cast("string").alias("event_id"), (F.col("event_id") + 3_000_000_000).cast("string").alias("large"),
                           F.col("value").cast("string").alias("value"), "event_type", F.get_json_object("props", "$.k").alias("k"))
    return S.inferred_types(rows, rows.columns)


@query("sch02b_inferred_json", "SELECT count(*) AS rows, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total, 'OBJECT<k: BIGINT>' AS json_schema FROM events")
def inferred_json(t: Tables):
    """Schema of all JSON texts of a column, then the column read under it."""
    found = S.infer_json(t.events, "props")
    ddl = "struct<" + found.removeprefix("OBJECT<").removesuffix(">") + ">"
    rows = t.events.select(F.from_json("props", ddl).alias("p"))
    return rows.agg(F.count("*").alias("rows"), F.sum("p.k").alias("total")).withColumn("json_schema", F.lit(found))


@query("sch02c_nested_json", """
SELECT event_id, event_type AS name, CAST(event_id + 3000000000 AS BIGINT) AS big, user_id AS first FROM events
""")
def nested_json(t: Tables):
    """Objects in objects and lists in objects, read under the inferred DDL."""
    text = F.to_json(F.struct(F.struct(F.col("event_type").alias("name"), F.struct((F.col("event_id") + 3_000_000_000).alias("big")).alias("deep")).alias("outer"),
                              F.array(F.struct(F.col("user_id").alias("u"))).alias("list")))
    rows = t.events.select("event_id", text.alias("j"))
    parsed = rows.select("event_id", F.from_json("j", S.json_ddl(rows, "j")).alias("p"))
    return parsed.select("event_id", F.col("p.outer.name").alias("name"), F.col("p.outer.deep.big").alias("big"), F.get("p.list", F.lit(0))["u"].alias("first"))


@query("sch03c_widening_without_loss", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '0.5' ELSE (9007199254740993 + 2 * o_orderkey)::VARCHAR END AS large,
  CASE WHEN o_orderkey % 5 = 0 THEN 0.5::DOUBLE ELSE (o_custkey)::DOUBLE END AS small, false AS _deleted FROM orders
""")
def widening_without_loss(t: Tables):
    """Whole numbers meet fractions: as double where every number stays, as text where digits would go."""
    table = KeyedTable(t.spark, work_dir(t.spark, "exact"), ["o_orderkey"], buckets=4)
    table.load(t.orders.select("o_orderkey", (F.lit(9007199254740993) + 2 * F.col("o_orderkey")).alias("large"), F.col("o_custkey").cast("bigint").alias("small")))
    table.commit(C.upserts(t.orders.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit(0.5).alias("large"), F.lit(0.5).alias("small")), 1))
    return table.read()


@query("sch06b_mapped_read", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price, '[' || o_custkey || ',' || o_orderkey || ']' AS pair, o_orderdate FROM orders
""")
def mapped_read(t: Tables):
    """The mapped types drive the read: decimals keep precision and scale, nested values become JSON."""
    source = t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"), F.array("o_custkey", "o_orderkey").alias("pair"), "o_orderdate")
    mapped = S.map_source_types(K.columns_of(t.spark, {"orders": source}), "spark")
    declared = {r["column_name"]: r["declared_type"] for r in mapped.collect()}  # one row for each column
    if declared["price"] != "DECIMAL(15,2)":
        raise AssertionError(declared)
    typed = S.with_declared_types(source, declared)
    return typed.withColumn("price", F.col("price").cast("string"))


@query("sch03_widening", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'about ' || p_size WHEN p_partkey % 3 = 0 THEN (p_size + 0.5)::DOUBLE::VARCHAR ELSE p_size::DOUBLE::VARCHAR END AS size, false AS _deleted FROM part
""")
def widening(t: Tables):
    """A column goes from int to double to text over three commits; rows not touched are cast as well."""
    k, size = F.col("p_partkey"), F.col("p_size")
    table = KeyedTable(t.spark, work_dir(t.spark, "widen"), ["p_partkey"], buckets=4)
    table.commit(C.upserts(t.part.select("p_partkey", size.alias("size")), 1))
    table.commit(C.upserts(t.part.filter(k % 3 == 0).select("p_partkey", (size + F.lit(0.5)).alias("size")), 1))
    table.commit(C.upserts(t.part.filter(k % 5 == 0).select("p_partkey", F.concat(F.lit("about "), size.cast("string")).alias("size")), 1))
    return table.read()


@query("sch03b_inexact_rows", """
SELECT 'event_id' AS column_name, 0::BIGINT AS inexact UNION ALL SELECT 'large', count(*) FILTER (event_id + 9007199254740900 > 9007199254740992) FROM events
""")
def inexact_rows(t: Tables):
    """Rows that would lose digits if their whole-number column became double."""
    return S.inexact_as_double(t.events.select("event_id", (F.col("event_id") + 9_007_199_254_740_900).alias("large")), ["event_id", "large"])


@query("sch03d_widened_on_read", """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN c_acctbal ELSE c_nationkey::DOUBLE END AS measure, CASE WHEN c_custkey % 9 = 0 THEN c_mktsegment END AS extra, false AS _deleted FROM customer
""")
def widened_on_read(t: Tables):
    """Whole numbers become doubles and a column is added by a commit of a ninth of the rows; the stored rows are cast when they are read."""
    c = t.customer
    table = MergeTable(t.spark, path := work_dir(t.spark, "widened"), ["c_custkey"])
    table.commit(C.upserts(c.select("c_custkey", F.col("c_nationkey").alias("measure")), 0))
    table.compact()
    base = path_bytes(t.spark, f"{path}/base")
    table.commit(C.upserts(c.filter(F.col("c_custkey") % 9 == 0).select("c_custkey", F.col("c_acctbal").alias("measure"), F.col("c_mktsegment").alias("extra")), 0))
    if path_bytes(t.spark, f"{path}/base") != base:
        raise AssertionError("a widened column rewrote rows")
    return table.read()


@query("sch04_new_columns", """
SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS p_brand, false AS _deleted FROM part
""")
def new_columns(t: Tables):
    """The second batch brings a column the table does not have."""
    table = KeyedTable(t.spark, work_dir(t.spark, "grow"), ["p_partkey"], buckets=4)
    table.commit(C.upserts(t.part.select("p_partkey", "p_name"), 1))
    table.commit(C.upserts(t.part.filter(F.col("p_partkey") % 2 == 0).select("p_partkey", "p_brand"), 1, ["p_brand"]))
    return table.read()


@query("sch05_all_null_columns", "SELECT c_custkey, c_name, NULL::VARCHAR AS kept FROM customer")
def all_null(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", F.lit(None).cast("string").alias("kept"), F.lit(None).cast("int").alias("gone"))
    return S.drop_undeclared_nulls(rows, declared=["c_custkey", "kept"])


def typed_catalogue(t: Tables):
    flagged = K.with_key_flag(K.columns_of(t.spark, frames(t)), K.keys_of(t.spark, KEYS))
    return S.map_source_types(flagged, "spark")


@query("sch06_type_mapping", catalogue_sql(lambda table, n, kind: f", {int(n in KEYS[table])}::INTEGER AS is_key, '{DECLARED[kind]}' AS declared_type, count(*) AS row_count"))
def type_mapping(t: Tables):
    return typed_catalogue(t).join(K.row_counts(frames(t)), "table_name")


def schema_sql(extra: str = "") -> str:
    return " UNION ALL ".join(
        "SELECT '{}' AS table_name, '{}' AS columns, '{}' AS primary_key{} FROM {}".format(
            table, ", ".join(f"{n} {DECLARED[k]}" for n, k in columns), KEYS[table][0], extra, table)
        for table, columns in COLUMNS.items())


@query("sch07_schema_from_catalogue", schema_sql(", count(*) AS row_count"))
def schema_from_catalogue(t: Tables):
    return K.table_schema(typed_catalogue(t)).join(K.row_counts(frames(t)), "table_name")


def specs(t: Tables):
    return [TableSpec("part", t.part, ["p_partkey"], exclude=["P_NAME"]), TableSpec("orders", t.orders, ["o_orderkey"], strategy="incremental"),
            TableSpec("events", t.events, ["event_id"], include=["event_id", "ts", "event_type"], strategy="FULL", cursor="ts")]


@query("sch08_table_plans", """
SELECT 'part' AS table_name, 'p_partkey LONG, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE' AS columns, 'p_partkey' AS primary_key, 'FULL' AS strategy, NULL::VARCHAR AS replication_key, count(*) AS row_count FROM part
UNION ALL SELECT 'orders', 'o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate NAIVE_DATETIME, o_orderpriority STRING', 'o_orderkey', 'INCREMENTAL', 'o_orderdate', count(*) FROM orders
UNION ALL SELECT 'events', 'event_id LONG, ts NAIVE_DATETIME, event_type STRING', 'event_id', 'FULL', NULL, count(*) FROM events
""")
def table_plans(t: Tables):
    return plan_tables(t.spark, specs(t)).join(K.row_counts(frames(t)), "table_name")


@query("inc14_inferred_cursor", """
SELECT 'part' AS table_name, 'p_partkey' AS replication_key, 'INCREMENTAL' AS strategy, max(p_partkey)::VARCHAR AS mark FROM part
UNION ALL SELECT 'orders', 'o_orderdate', 'INCREMENTAL', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders
UNION ALL SELECT 'events', 'updated_at', 'INCREMENTAL', strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') FROM events
UNION ALL SELECT 'labels', NULL, 'FULL', count(*)::VARCHAR FROM labels
""")
def inferred_cursor(t: Tables):
    """Preferred name, else first time column, else the key, else a full load; with the mark each would store."""
    tables = {"part": t.part, "orders": t.orders, "labels": t.labels,
              "events": t.events.withColumn("updated_at", F.date_trunc("second", "ts").cast("timestamp_ntz"))}
    flagged = K.with_key_flag(K.columns_of(t.spark, tables), K.keys_of(t.spark, KEYS))
    found = infer_cursor(flagged)
    marks = None
    for name, column in (("part", "p_partkey"), ("orders", "o_orderdate"), ("events", "updated_at"), ("labels", None)):
        mark = F.max(column).cast("string") if column else F.count("*").cast("string")
        one = tables[name].agg(mark.alias("mark")).select(F.lit(name).alias("table_name"), "mark")
        marks = one if marks is None else marks.unionByName(one)
    return found.join(marks, "table_name")


@query("udf07b_text_and_decimal_cursors", """
SELECT 'text' AS kind, o_custkey, max_by(o_orderkey, (strftime(o_orderdate, '%Y%m%d') || lpad(o_orderkey::VARCHAR, 12, '0'))) AS o_orderkey FROM orders GROUP BY 2
UNION ALL SELECT 'decimal', o_custkey, max_by(o_orderkey, (o_totalprice, o_orderkey)) FROM orders GROUP BY 2
""")
def other_cursors(t: Tables):
    """Many rows a key in one run: the greatest cursor wins, whatever its type."""
    text = t.orders.select("o_custkey", "o_orderkey", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("cursor"))
    exact = F.col("o_totalprice").cast("decimal(20,2)") + F.col("o_orderkey").cast("decimal(20,0)") / F.lit(10 ** 12).cast("decimal(14,0)")
    number = t.orders.select("o_custkey", "o_orderkey", exact.cast("decimal(38,12)").alias("cursor"))
    given = [TableSpec(n, rows, ["o_custkey"], strategy="incremental", cursor="cursor") for n, rows in (("text", text), ("decimal", number))]
    tables = run_specs(t.spark, given, work_dir(t.spark, "cursors"))
    one, two = (tables[n].read().select(F.lit(n).alias("kind"), "o_custkey", "o_orderkey") for n in ("text", "decimal"))
    return one.unionByName(two)


@query("udf07_spec_run", """
SELECT 'part' AS table_name, p_partkey AS key, p_brand AS info, false AS _deleted FROM part
UNION ALL SELECT 'orders', o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN lower(o_orderstatus) ELSE o_orderstatus END, false FROM orders
UNION ALL SELECT 'events', event_id, event_type, false FROM events
""")
def spec_run(t: Tables):
    """Three specs, two runs; the second run reads orders beyond the mark of the first and transforms them."""
    root = work_dir(t.spark, "specs")
    part, orders, events = specs(t)
    early = orders.source.filter(F.col("o_orderdate") <= F.lit("1998-01-01").cast("timestamp_ntz"))
    run_specs(t.spark, [part, TableSpec("orders", early, orders.keys, strategy="incremental"), events], root)
    lower = TableSpec("orders", orders.source, orders.keys, strategy="incremental",
                      transform=lambda df: df.withColumn("o_orderstatus", F.lower("o_orderstatus")))
    tables = run_specs(t.spark, [part, lower, events], root)
    out = None
    for name, key, info in (("part", "p_partkey", "p_brand"), ("orders", "o_orderkey", "o_orderstatus"), ("events", "event_id", "event_type")):
        one = tables[name].read().select(F.lit(name).alias("table_name"), F.col(key).alias("key"), F.col(info).alias("info"), "_deleted")
        out = one if out is None else out.unionByName(one)
    return out
