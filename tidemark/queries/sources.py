"""Sources and sinks; files are written from the given tables by the query itself."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import values as N
from tidemark.operators import changes as C
from tidemark.operators import summary
from tidemark.plans.merge_table import MergeTable
from tidemark.plans.store import KeyedTable
from tidemark.queries.registry import Tables, query
from tidemark.sources import catalogue, files, graph, tables
from tidemark.session import path_bytes, work_dir

CSV = {"header": "true", "quote": '"', "escape": '"'}


@query("src01_delimited", """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, 'a "quoted", ' || o_orderpriority AS note FROM orders
""")
def delimited(t: Tables):
    path = work_dir(t.spark, "csv")
    t.orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                    F.concat(F.lit('a "quoted", '), "o_orderpriority").alias("note")).write.options(**CSV).csv(path)
    return files.read_delimited(t.spark, path)


@query("src01b_quoted_line_breaks", """
SELECT p_partkey::VARCHAR AS p_partkey, p_name || chr(10) || 'second "line", of ' || p_brand AS note FROM part WHERE p_size % 5 <> 0
""")
def quoted_line_breaks(t: Tables):
    """Cells with line breaks stay whole; lines with a surplus cell go to the rejects."""
    path = work_dir(t.spark, "csv")
    cell = F.concat(F.lit('"'), "p_name", F.lit('\nsecond ""line"", of '), "p_brand", F.lit('"'))
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(","), cell, F.when(F.col("p_size") % 5 == 0, ",one too many").otherwise(""))
    header = F.concat(F.lit("p_partkey,note\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n"))
    # one small file for each brand and size, each with its header
    t.part.groupBy("p_brand", "p_size").agg(header.alias("value")).select("value").repartition(4, "value").write.option("lineSep", "\n").text(path)
    good, rejects = files.read_delimited_checked(t.spark, path)
    return good.where("p_partkey <> 'p_partkey'")


@query("src01c_tab_file", "SELECT c_custkey::VARCHAR AS c_custkey, c_name || ', ' || c_mktsegment AS label, 'é' AS accent FROM customer")
def tab_file(t: Tables):
    path = work_dir(t.spark, "tab")
    t.customer.select("c_custkey", F.concat("c_name", F.lit(", "), "c_mktsegment").alias("label"), F.lit("é").alias("accent")).write.options(
        **CSV, sep="\t", encoding="ISO-8859-1").csv(path)
    return files.read_delimited(t.spark, path, delimiter="\t", encoding="ISO-8859-1")


@query("src02_typed_pruned", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem")
def typed_pruned(t: Tables):
    path = work_dir(t.spark, "csv")
    t.lineitem.write.options(**CSV).csv(path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.lineitem.schema)
    return files.read_typed(t.spark, path, schema, ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"])


@query("src03_folder", """
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier
""")
def folder(t: Tables):
    root = work_dir(t.spark, "folder")
    for name in ("customer", "part", "supplier"):
        getattr(t, name).write.options(**CSV).csv(f"{root}/{name}.csv")
    return catalogue.row_counts(files.read_folder(t.spark, root))


@query("src04_archives", "SELECT p_partkey, 'rows.csv' AS member, p_name, p_size FROM part")
def archives(t: Tables):
    """ZIP archives packed from the rows by the tasks, one per batch, then opened again."""

    def pack(batches):
        for batch in batches:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as archive:
                archive.writestr("rows.csv", batch.to_csv(index=False))
                archive.writestr("readme.txt", "not a table")
            yield pd.DataFrame({"path": [f"export-{batch.iloc[0, 0]}.zip"], "content": [out.getvalue()]})

    named = t.part.select(F.col("p_partkey").alias(" Part Key"), F.col("p_name").alias("NAME "), F.col("p_size").alias("size"))
    rows = files.unzip_members(named.mapInPandas(pack, "path string, content binary"))
    return rows.select(F.col("fields")["part_key"].cast("bigint").alias("p_partkey"), "member", F.col("fields")["name"].alias("p_name"),
                       F.col("fields")["size"].cast("int").alias("p_size"))


@query("src05_parquet_export", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS l_shipdate, l_returnflag AS flag FROM lineitem
""")
def parquet_export(t: Tables):
    path = work_dir(t.spark, "export")
    t.lineitem.withColumn("flag", F.encode("l_returnflag", "UTF-8")).write.parquet(path)
    return files.read_export(t.spark, path, ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "flag"])


@query("src06_page_documents", "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey FROM customer")
def page_documents(t: Tables):
    """Pages of 50 customers by key range (the key is unique, so a page holds 50 rows at most)."""
    path = work_dir(t.spark, "pages")
    row = F.struct("c_custkey", "c_name", "c_nationkey")
    (t.customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(F.collect_list(row).alias("data"))
     .write.json(path))
    return files.read_pages(t.spark, path, rows="data")


@query("src06b_mixed_pages", "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey FROM customer")
def mixed_pages(t: Tables):
    """Pages of one folder hold their records under different names; each page chooses its own list."""
    path = work_dir(t.spark, "pages")
    row, third = F.struct("c_custkey", "c_name", "c_nationkey"), F.floor(F.col("c_custkey") / 50) % 3
    page = t.customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(F.collect_list(row).alias("rows"), F.max(third).alias("k"))
    page.select("page", *[F.when(F.col("k") == i, F.col("rows")).alias(n) for i, n in enumerate(("data", "results", "entries"))],
                F.array(F.struct(F.lit("late").alias("problem"))).alias("warnings")).write.json(path)
    return files.read_pages(t.spark, path).where("c_custkey is not null").select("c_custkey", "c_name", "c_nationkey")


@query("src06c_empty_first_list", """
SELECT c_custkey, c_name, CASE WHEN c_custkey // 50 % 2 = 1 THEN 'results' ELSE 'data' END AS taken_from FROM customer
""")
def empty_first_list(t: Tables):
    """Every second page has an empty preferred list beside a filled one: its records come from the filled one."""
    path = work_dir(t.spark, "pages")
    odd = F.floor(F.col("c_custkey") / 50) % 2 == 1
    row = lambda name: F.struct("c_custkey", "c_name", F.lit(name).alias("taken_from"))
    page = t.customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(
        F.collect_list(F.when(~odd, row("data"))).alias("data"), F.collect_list(F.when(odd, row("results"))).alias("results"))
    page.write.json(path)
    return files.read_pages(t.spark, path)


@query("src07_xml", "SELECT p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN p_size END AS p_size FROM part")
def xml(t: Tables):
    path = work_dir(t.spark, "xml")
    size = F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("n/a")
    t.part.select("p_partkey", "p_name", size.alias("p_size")).write.format("xml").options(rootTag="parts", rowTag="part").save(path)
    rows = files.read_xml(t.spark, path, "part", "p_partkey bigint, p_name string, p_size string")
    return rows.withColumn("p_size", F.col("p_size").try_cast("int"))


@query("src08_table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def table_scan(t: Tables):
    return tables.scan(t.orders, ["o_orderkey", "o_totalprice"], F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz"))


@query("src09_segments", """
SELECT o_orderkey, least(3, floor((o_orderkey - lo) / ((hi - lo + 1) / 4.0)))::INTEGER AS segment FROM orders, (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
""")
def segments(t: Tables):
    bounds = t.orders.agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).first()
    out = None
    for number, part in enumerate(tables.read_segments(t.orders.select("o_orderkey"), "o_orderkey", bounds["lo"], bounds["hi"], 4)):
        part = part.withColumn("segment", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out


@query("src09b_quantile_segments", "SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS key, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def quantile_segments(t: Tables):
    """A key of which one value holds a third of the rows, in twelve segments of like size; the fifth fails once and is pulled again alone."""
    rows = t.lineitem.select(F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_orderkey")).alias("key"), "l_partkey", "l_suppkey", "l_linenumber")
    cuts, path, failed = tables.quantile_segments(rows, "key", 12, ["l_partkey", "l_suppkey", "l_linenumber"]), work_dir(t.spark, "segments"), []

    def fail(i):
        if i == 4 and not failed:
            failed.append(i)
            raise RuntimeError("lost")

    try:
        tables.pull_segments(rows, "key", cuts, path, fail)
    except RuntimeError:
        pass
    if tables.pull_segments(rows, "key", cuts, path, fail) != list(range(4, len(cuts))):
        raise AssertionError("finished segments were pulled again")
    sizes = [r["count"] for r in t.spark.read.parquet(f"{path}/rows").groupBy("_segment").count().collect()]
    if max(sizes) > 2 * sum(sizes) / len(cuts):
        raise AssertionError(f"segments of {sizes} rows")
    return tables.pulled(t.spark, path, rows.schema)


@query("src10_interval", """
SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-20'
""")
def interval(t: Tables):
    """A date-partitioned copy; the day filter prunes folders, the time filter prunes row groups."""
    path = work_dir(t.spark, "days")
    t.events.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    days = t.spark.read.parquet(path).filter(F.col("day").between("2024-01-10", "2024-01-19"))
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 12:00:00", "2024-01-20"))
    return files.interval_scan(days, "ts", start, end, ["event_id", "ts", "event_type"])


@query("src11_key_value", """
SELECT 'event:' || event_id AS key, CASE event_id % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'hash' WHEN 2 THEN 'list' WHEN 3 THEN 'set' WHEN 4 THEN 'zset' ELSE 'stream' END AS kind,
  CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN '{"type":"' || event_type || '","user":"' || user_id || '"}' WHEN 2 THEN '["' || event_type || '","' || user_id || '"]'
    WHEN 3 THEN '["' || event_type || '","' || user_id || '"]' WHEN 4 THEN '[["' || event_type || '",' || event_id || '],["' || user_id || '",' || (event_id + 1) || ']]' ELSE 'Unsupported type: stream' END AS value,
  (CASE event_id % 6 WHEN 0 THEN length(event_type) WHEN 5 THEN 0 ELSE 2 END)::INTEGER AS size FROM events
""")
def key_value(t: Tables):
    kinds = F.array(*map(F.lit, ("string", "hash", "list", "set", "zset", "stream")))
    user = F.col("user_id").cast("string")
    items = t.events.select(
        F.concat(F.lit("event:"), F.col("event_id").cast("string")).alias("key"), F.get(kinds, (F.col("event_id") % 6).cast("int")).alias("kind"),
        F.col("event_type").alias("text"), F.create_map(F.lit("type"), "event_type", F.lit("user"), user).alias("fields"),
        F.array("event_type", user).alias("members"), F.array("event_id", F.col("event_id") + 1).alias("scores"))
    shown = N.rendered(F.col("kind"), F.col("text"), F.col("fields"), F.col("members"), F.col("scores"))
    return items.select("key", "kind", *[c.alias(n) for n, c in shown.items()])


def customer_vertices(t: Tables):
    return t.customer.select("c_custkey", F.array("c_name").alias("name"),
                             F.when(F.col("c_nationkey") % 2 == 0, F.array("c_mktsegment", F.lit("KEY"))).otherwise(F.array("c_mktsegment")).alias("segment"))


@query("src12a_vertices", "SELECT c_custkey AS vertex_id, 'customer' AS vertex_label, c_name AS name, c_mktsegment AS segment FROM customer")
def vertices(t: Tables):
    return graph.vertex_table(customer_vertices(t), "c_custkey", F.lit("customer"), ["name", "segment"])


@query("src12b_vertex_properties", """
SELECT c_custkey AS vertex_id, 'segment' AS property_key, i::INTEGER AS property_index, CASE i WHEN 0 THEN c_mktsegment ELSE 'KEY' END AS property_value
FROM customer, (SELECT unnest(range(2)) AS i) WHERE c_nationkey % 2 = 0
""")
def vertex_properties(t: Tables):
    return graph.property_table(customer_vertices(t), "c_custkey", ["name", "segment"])


@query("src12c_edges", """
SELECT 'e' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS edge_id, 'supplies' AS edge_label, l_suppkey AS out_vertex_id, l_partkey AS in_vertex_id, l_quantity FROM lineitem
""")
def edges(t: Tables):
    rows = t.lineitem.withColumn("id", F.concat(F.lit("e"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")))
    return graph.edge_table(rows, "id", F.lit("supplies"), "l_suppkey", "l_partkey", ["l_quantity"])


@query("snk01_keyed_table", """
SELECT l_orderkey, l_linenumber, sum(CAST(l_quantity AS BIGINT))::BIGINT + CASE WHEN max(l_returnflag) = 'R' THEN 1 ELSE 0 END AS quantity, max(l_returnflag) AS flag, false AS _deleted,
  CASE WHEN max(l_returnflag) = 'R' THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS _synced FROM lineitem GROUP BY 1, 2
""")
def keyed_table(t: Tables):
    """A composite key, two commits, the time of the last write per row."""
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.max("l_returnflag").alias("flag"))
    table = KeyedTable(t.spark, work_dir(t.spark, "keyed"), ["l_orderkey", "l_linenumber"])
    table.commit(C.upserts(rows, 1), run_time=F.lit("2024-01-01").cast("timestamp_ntz"))
    changed = rows.filter(F.col("flag") == "R").withColumn("quantity", F.col("quantity") + 1)
    table.commit(C.upserts(changed, 1), run_time=F.lit("2024-01-02").cast("timestamp_ntz"))
    return table.read()


@query("snk01b_reopened_other_buckets", "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, false AS _deleted FROM orders")
def reopened(t: Tables):
    """Loaded with 8 buckets, opened again without a number, written over 3 buckets, and committed to once more."""
    path, rows = work_dir(t.spark, "reopened"), t.orders.select("o_orderkey", "o_totalprice")
    KeyedTable(t.spark, path, ["o_orderkey"], buckets=8).load(rows)
    table = KeyedTable(t.spark, path, ["o_orderkey"])
    table.commit(C.upserts(rows.withColumn("o_totalprice", F.lit(0.0)), 1))
    table.rebucket(3)
    KeyedTable(t.spark, path, ["o_orderkey"]).commit(C.upserts(rows.withColumn("o_totalprice", F.col("o_totalprice") + 1), 1))
    return table.read()


@query("snk01c_small_commits", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 100 < 12 THEN o_totalprice + o_orderkey % 100 + 1 ELSE o_totalprice END AS o_totalprice, o_orderkey % 100 = 50 AS _deleted FROM orders
""")
def small_commits(t: Tables):
    """Merge on read: the orders, then twelve commits of one in a hundred rows each and a delete; compaction in between, and what it left removed at the end."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    table = MergeTable(t.spark, path := work_dir(t.spark, "merged"), ["o_orderkey"])
    table.commit(C.upserts(rows, 0))
    table.compact()
    base = path_bytes(t.spark, f"{path}/base")
    for i in range(12):
        mine = rows.filter(F.col("o_orderkey") % 100 == i)
        table.commit(C.updates(mine.select("o_orderkey", (F.col("o_totalprice") + i + 1).alias("o_totalprice")), ["o_orderkey"], 0), state={"commit": i})
        if i == 6:
            if path_bytes(t.spark, f"{path}/base") != base:
                raise AssertionError("a small commit rewrote rows")
            table.compact()
    table.commit(C.deletes(rows.filter(F.col("o_orderkey") % 100 == 50), ["o_orderkey"], 0))
    table.clean(keep=1, older_than_s=-60)
    return table.read()


@query("snk03_run_summary", """
SELECT TIMESTAMP '2024-02-01 06:00:00' AS sync_start, 3::BIGINT AS table_count, ((SELECT count(*) FROM customer) + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders))::BIGINT AS record_count,
  'customer,lineitem,orders' AS tables
""")
def run_summary(t: Tables):
    counts = catalogue.row_counts({n: getattr(t, n) for n in ("orders", "lineitem", "customer")})
    return summary.run_summary(counts, "2024-02-01 06:00:00")
