"""Conversions, text rules, hashes and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import convert as V
from tidemark.functions import keys as K
from tidemark.functions import text as X
from tidemark.queries.registry import Tables, query

# -- conversions ---------------------------------------------------------------


@query("cnv01_lenient_numbers", """
SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN o_orderkey::INTEGER WHEN 1 THEN o_custkey::INTEGER END AS as_int,
  CASE o_orderkey % 4 WHEN 0 THEN o_orderkey::DOUBLE WHEN 1 THEN o_custkey::DOUBLE WHEN 3 THEN 4.0::DOUBLE END AS as_float
FROM orders
""")
def lenient_numbers(t: Tables):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = (F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.concat(F.lit(" "), c.cast("string"), F.lit(" ")))
            .when(k % 4 == 2, F.concat(k.cast("string"), F.lit("b"))).otherwise("4.0"))
    return t.orders.select("o_orderkey", V.lenient_int(text, "int").alias("as_int"), V.lenient_float(text).alias("as_float"))


@query("cnv01b_large_whole_numbers", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 5 THEN l_orderkey * 3000000000 + l_linenumber END AS as_int FROM lineitem")
def large_whole_numbers(t: Tables):
    """Whole numbers beyond 32 bit, and text that is none."""
    big = F.col("l_orderkey") * F.lit(3_000_000_000) + F.col("l_linenumber")
    text = F.when(F.col("l_linenumber") < 5, F.concat(F.lit(" "), big.cast("string"))).otherwise(F.concat(big.cast("string"), F.lit(".5x")))
    return t.lineitem.select("l_orderkey", "l_linenumber", V.lenient_int(text).alias("as_int"))


@query("cnv02_lenient_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS stamp FROM orders
""")
def lenient_dates(t: Tables):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(k % 3 == 1, F.unix_seconds(d.cast("timestamp")).cast("string")).otherwise("on Tuesday"))
    return t.orders.select("o_orderkey", V.lenient_date(text).alias("stamp"))


@query("cnv03_from_epoch", """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_millis,
  make_timestamp(CAST(trunc((epoch_us(ts) / 1e6) * 1e6) AS BIGINT)) AS from_seconds FROM events
""")
def from_epoch(t: Tables):
    ts = F.col("ts").cast("timestamp")
    return t.events.select("event_id",
                           V.from_epoch_millis(F.unix_millis(ts)).cast("timestamp_ntz").alias("from_millis"),
                           V.from_epoch_seconds(F.unix_micros(ts) / F.lit(1e6)).cast("timestamp_ntz").alias("from_seconds"))


@query("cnv04_to_epoch", """
SELECT event_id, CASE event_id % 3 WHEN 2 THEN epoch_us(ts) // 1000000 - 7200 ELSE epoch_us(ts) // 1000000 END AS seconds,
  CASE event_id % 3 WHEN 2 THEN epoch_us(ts) // 1000 - 7200000 ELSE epoch_us(ts) // 1000 END AS millis FROM events
""")
def to_epoch(t: Tables):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone_suffix())
    return t.events.select("event_id", V.to_epoch_seconds(text).alias("seconds"), V.to_epoch_millis(text).alias("millis"))


def zone_suffix():
    k = F.col("event_id")
    return F.when(k % 3 == 0, "Z").when(k % 3 == 1, "").otherwise("+02:00")


@query("cnv05_zone_normal", """
SELECT event_id, strftime(CASE event_id % 3 WHEN 2 THEN ts - INTERVAL 2 HOUR ELSE ts END, '%Y-%m-%dT%H:%M:%SZ') AS utc FROM events
""")
def zone_normal(t: Tables):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone_suffix())
    return t.events.select("event_id", V.iso_text(V.utc(text)).alias("utc"))


@query("cnv06_state_timestamp", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) ELSE TIMESTAMP '1970-01-01' END AS mark FROM events
""")
def state_timestamp(t: Tables):
    k = F.col("event_id")
    text = F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k % 3 == 1, "yesterday")
    return t.events.select("event_id", V.state_timestamp(text).cast("timestamp_ntz").alias("mark"))


@query("cnv07_named_formats", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS stamp,
  CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE o_orderdate END AS parsed FROM orders
""")
def named_formats(t: Tables):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    formats = ["dd MMM yyyy hh:mm:ss a", "yyyyMMdd", "MM/dd/yyyy"]
    text = (F.when(k % 4 == 0, F.date_format(d, formats[0])).when(k % 4 == 1, F.date_format(d, formats[1]))
            .when(k % 4 == 2, F.date_format(d, formats[2])).otherwise("soon"))
    return t.orders.select("o_orderkey", V.iso_or_text(text, formats).alias("stamp"),
                           V.parse_formats(text, formats).cast("timestamp_ntz").alias("parsed"))


@query("cnv08_date_parts", """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m, (isodow(o_orderdate) - 1)::INTEGER AS weekday
FROM orders
""")
def date_parts(t: Tables):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
                           F.weekday("o_orderdate").alias("weekday"))


@query("cnv09_duration", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN o_orderstatus = 'F' THEN (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 END AS cycle_hours,
  CASE WHEN l_returnflag = 'A' THEN 60.0::DOUBLE ELSE (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1e6 END AS seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def duration(t: Tables):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    closed = F.when(F.col("l_returnflag") != "A", F.col("l_shipdate"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.when(F.col("o_orderstatus") == "F", V.hours_between(F.col("o_orderdate"), F.col("l_shipdate"))).alias("cycle_hours"),
                       V.seconds_between(F.col("o_orderdate"), closed, F.lit(60.0)).alias("seconds"))


def order_bounds(t: Tables):
    return t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))


@query("cnv10_date_windows", """
WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 30 DAY))::DATE AS window_start, hi FROM b)
SELECT window_start, least(window_start + 29, hi) AS window_end FROM s
""")
def date_windows(t: Tables):
    return V.date_windows(order_bounds(t), "lo", "hi", 30).select("window_start", "window_end")


@query("cnv10b_date_windows_year", """
WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 365 DAY))::DATE AS window_start, hi FROM b)
SELECT window_start, least(window_start + 364, hi) AS window_end FROM s
""")
def date_windows_year(t: Tables):
    return V.date_windows(order_bounds(t), "lo", "hi", 365).select("window_start", "window_end")


@query("cnv11_day_list", """
WITH b AS (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events)
SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y%m%d') AS day FROM b
""")
def day_list(t: Tables):
    return V.day_list(t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")), "lo", "hi")


@query("cnv12_number_from_text", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN 1000000 + p_size::DOUBLE / 100
  WHEN 2 THEN -p_retailprice END AS number FROM part
""")
def number_from_text(t: Tables):
    k, price = F.col("p_partkey"), F.col("p_retailprice").cast("string")
    cents = F.lpad(F.col("p_size").cast("string"), 2, "0")
    text = (F.when(k % 4 == 0, F.concat(F.lit("$ "), price)).when(k % 4 == 1, F.concat(F.lit("EUR 1,000,000,"), cents))
            .when(k % 4 == 2, F.concat(F.lit("-"), price, F.lit(" USD"))).otherwise("none"))
    return t.part.select("p_partkey", V.number_from_text(text).alias("number"))


@query("cnv13_flag_from_text", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN false END AS flag,
  CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 4 THEN true END AS answer FROM orders
""")
def flag_from_text(t: Tables):
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, " TRUE ").when(k % 5 == 1, "False").when(k % 5 == 2, "").when(k % 5 == 3, "<SET_ME>").otherwise("Yes")
    return t.orders.select("o_orderkey", V.flag_from_text(text, strict=False).alias("flag"),
                           V.flag_from_text(text, default=None, strict=False, yes_no=True).alias("answer"))


@query("cnv14_decimal", """
SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2))::VARCHAR AS exact, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS as_double
FROM part
""")
def decimal(t: Tables):
    price = F.col("p_retailprice")
    return t.part.select("p_partkey", V.money(price).cast("string").alias("exact"), V.money(price, as_double=True).alias("as_double"))


@query("cnv14b_decimal_places", """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_discount AS DECIMAL(30,4)) AS VARCHAR) AS exact FROM lineitem
""")
def decimal_places(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", V.money(F.col("l_discount"), precision=30, scale=4).cast("string").alias("exact"))


@query("cnv15_typed_cells", """
SELECT p_partkey, 'NAME' AS title, NULL::TIMESTAMP AS stamp_value, NULL::BOOLEAN AS check_value, NULL::DOUBLE AS number_value, p_name AS text_value FROM part
UNION ALL SELECT p_partkey, 'SIZE', NULL, NULL, CASE WHEN p_size % 2 = 0 THEN p_size::DOUBLE END, CASE WHEN p_size % 2 = 1 THEN 'n/a' END FROM part
UNION ALL SELECT p_partkey, 'BIG', NULL, p_size > 25, NULL, NULL FROM part
UNION ALL SELECT p_partkey, 'DAY', TIMESTAMP '2024-01-01' + to_days(p_size), NULL, NULL, NULL FROM part
""")
def typed_cells(t: Tables):
    """Cells (title, declared type, text) spread from each row, converted by the declared type."""
    size = F.col("p_size")
    cells = F.array(*[F.struct(F.lit(title).alias("title"), F.lit(kind).alias("kind"), value.alias("value")) for title, kind, value in (
        ("NAME", "TEXT_NUMBER", F.col("p_name")),
        ("SIZE", "NUMBER", F.when(size % 2 == 0, size.cast("string")).otherwise("n/a")),
        ("BIG", "CHECKBOX", (size > 25).cast("string")),
        ("DAY", "DATE", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), size), "yyyy-MM-dd")))])
    long = t.part.select("p_partkey", F.inline(cells))
    typed = V.typed_cell(F.col("value"), F.col("kind"))
    typed["number_value"] = typed["number_value"].cast("double")
    return long.select("p_partkey", "title", *[c.alias(n) for n, c in typed.items()])


@query("cnv16_scalar_only", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS at, '{"status":"' || o_orderstatus || '","cust":' || o_custkey || ',"gap":null}' AS info,
  '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS codes, o_orderpriority AS raw FROM orders
""")
def scalar_only(t: Tables):
    return V.scalar_only(t.orders.select(
        "o_orderkey", F.col("o_orderdate").alias("at"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"), F.lit(None).cast("int").alias("gap")).alias("info"),
        F.array("o_orderstatus", "o_orderpriority").alias("codes"), F.encode("o_orderpriority", "UTF-8").alias("raw")))


# -- text ----------------------------------------------------------------------


@query("txt01_trim_lower", "SELECT c_custkey AS c_custkey, trim(c_name) AS c_name, lower(c_mktsegment) AS segment FROM customer")
def trim_lower(t: Tables):
    wide = t.customer.select(F.col("c_custkey").alias("C_CUSTKEY"), F.concat(F.lit("  "), "c_name", F.lit(" \n")).alias("C_Name"),
                             F.concat(F.lit("\t"), F.upper("c_mktsegment")).alias("SEGMENT"))
    low = wide.toDF(*[c.lower() for c in wide.columns])
    return low.select("c_custkey", V.strip(F.col("c_name")).alias("c_name"), F.lower(V.strip(F.col("segment"))).alias("segment"))


@query("txt02_first_match", r"""
SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), ''), nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '')) AS heading,
  nullif(trim(regexp_extract(html, 'utm_source=(\w+)', 1)), '') AS campaign FROM pages
""")
def first_match(t: Tables):
    html = F.col("html")
    return t.pages.select("page_id", X.first_match(html, ["<h1>([^<]*)</h1>", "<title>([^<]*)</title>"]).alias("heading"),
                          X.first_match(html, [r"utm_source=(\w+)"]).alias("campaign"))


@query("txt03_first_line", r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
m AS (SELECT doc_id, pos, nullif(trim(regexp_extract(line, '([A-Za-z0-9._]+@[A-Za-z0-9.]+)', 1)), '') AS mail,
  nullif(trim(regexp_extract(line, '([0-9]+)', 1)), '') AS number FROM l)
SELECT doc_id, arg_min(mail, pos) FILTER (mail IS NOT NULL) AS mail, arg_min(number, pos) FILTER (number IS NOT NULL) AS number FROM m GROUP BY doc_id
""")
def first_line(t: Tables):
    text = F.col("text")
    return t.documents.select("doc_id", X.first_line_match(text, r"([A-Za-z0-9._]+@[A-Za-z0-9.]+)").alias("mail"),
                              X.first_line_match(text, r"([0-9]+)").alias("number"))


@query("txt04_fixed_version", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '1.' || p_size WHEN 1 THEN '2.' || p_size || ' or 3.0' END AS fix FROM part
""")
def fixed_version(t: Tables):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = (F.when(k % 3 == 0, F.concat("p_name", F.lit(" Fixed in version 1."), size, F.lit(" of it")))
            .when(k % 3 == 1, F.concat(F.lit("was FIXED IN 2."), size, F.lit(" or 3.0, "), "p_name")).otherwise(F.col("p_name")))
    return t.part.select("p_partkey", X.fixed_version(text).alias("fix"))


@query("txt05_identifier_parts", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'python' ELSE 'java' END AS lang,
  CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE 'java_' || p_size END AS product,
  p_size || '-' || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE (p_size + 1)::VARCHAR END AS versions
FROM part WHERE p_partkey % 3 <> 0
""")
def identifier_parts(t: Tables):
    k, size = F.col("p_partkey"), F.col("p_size")
    criteria = F.concat(F.lit("cpe:2.3:"), F.when(k % 3 == 0, "o").otherwise("a"), F.lit(":"),
                        F.when(k % 2 == 0, F.concat(F.lit("Python_org:"), F.lower("p_type")))
                        .otherwise(F.concat(F.lit("acme:java_"), size.cast("string"))))
    hit = X.affected_products(criteria, size.cast("string"), F.when(k % 5 != 0, (size + 1).cast("string")))
    return t.part.select("p_partkey", hit.alias("hit")).filter(F.col("hit").isNotNull()).select("p_partkey", "hit.*")


@query("txt06_join_parts", """
SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment) AS full_name, concat_ws(', ', n_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END) AS place,
  c_custkey || ',' || c_nationkey AS codes
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def join_parts(t: Tables):
    both = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return both.select("c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("full_name"),
                       F.concat_ws(", ", "n_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))).alias("place"),
                       F.array_join(F.array(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")), ",").alias("codes"))


@query("txt07_mapping_text", """
SELECT s_suppkey, 'Z' || s_nationkey AS zip, 'F' || s_suppkey || '|G1' AS farms FROM supplier
UNION ALL SELECT s_suppkey, 'Y', 'H' || s_nationkey FROM supplier
""")
def mapping_text(t: Tables):
    k, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    text = F.concat(F.lit("Z"), n, F.lit(":F"), k, F.lit(", G1|broken|Y:old|Y: H"), n)
    rows = X.mapping_rows(t.supplier.select("s_suppkey", text.alias("mapping")), "mapping", "zip", "farms")
    return rows.select("s_suppkey", "zip", F.array_join("farms", "|").alias("farms"))


@query("txt08_base64", "SELECT c_custkey, base64(encode(c_name)) AS encoded, c_name AS decoded FROM customer")
def base64(t: Tables):
    c = t.customer.select("c_custkey", X.encode_base64(F.col("c_name")).alias("encoded"))
    return c.withColumn("decoded", X.decode_base64(F.col("encoded")))


@query("txt09_padded_code", """
SELECT c_custkey, lpad(c_custkey::VARCHAR, 10, '0') AS code, c_custkey || '0000000000' AS long_code FROM customer
""")
def padded_code(t: Tables):
    k = F.col("c_custkey").cast("string")
    return t.customer.select("c_custkey", X.padded_code(F.concat(F.lit(" "), k)).alias("code"),
                             X.padded_code(F.concat(k, F.lit("0000000000"))).alias("long_code"))


@query("txt10_sections", r"""
SELECT doc_id,
  CASE WHEN length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 10 THEN substring(regexp_replace(text, '^\s+|\s+$', '', 'g'), 1, 1000) ELSE 'no note' END AS note,
  CASE WHEN doc_id % 2 = 0 THEN 'SITE-' || lpad((doc_id % 7)::VARCHAR, 6, '0') || CASE WHEN doc_id % 7 = 3 THEN '' ELSE '' END ELSE '' END AS sites,
  'valley=HIGH;ridge=' || source AS levels, 'nothing kept' AS history
FROM documents
""")
def sections(t: Tables):
    """A report text with headings around the whole document text."""
    k = F.col("doc_id")
    site = F.concat(F.lit("SITE-"), F.lpad((k % 7).cast("string"), 6, "0"))
    report = F.concat(F.lit("Weather note: "), "text", F.lit("\nSTATIONS: "),
                      F.when(k % 2 == 0, F.concat(site, F.lit(" and "), site)).otherwise("none"),
                      F.lit("\nlevels by place:\n- valley: HIGH now\n* ridge: "), "source", F.lit("\nnothing here\nADVICE: wait"))
    d = t.documents.select("doc_id", report.alias("report"))
    text = F.col("report")
    sites = X.section(text, "STATIONS", "LEVELS BY PLACE", F.lit(""), 200, 1000)
    levels = X.section(text, "LEVELS BY PLACE", "ADVICE", F.lit(""), 300, 1000)
    return d.select(
        "doc_id",
        X.section(text, "WEATHER NOTE", "STATIONS", F.lit("no note"), 500, 1000, 10).alias("note"),
        F.array_join(X.distinct_ids(sites, r"SITE-\d{6}"), ",").alias("sites"),
        F.array_join(F.transform(X.line_map(levels), lambda p: F.concat(p["name"], F.lit("="), p["value"])), ";").alias("levels"),
        X.section(text, "PAST YEARS", None, F.lit("nothing kept"), 800, 1000, 10).alias("history"))


@query("txt10b_whole_sections", r"""
SELECT doc_id, coalesce(nullif(regexp_replace(text, '^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$', '', 'g'), ''), 'none') AS body, source AS origin FROM documents WHERE text IS NOT NULL
""")
def whole_sections(t: Tables):
    """Sections of any length between headings, the last one open."""
    report = F.concat(F.lit("Summary of all: first\nWHOLE BODY: "), "text", F.lit("\nOrigin:  "), "source", F.lit("  "))
    d = t.documents.where("text is not null").select("doc_id", report.alias("report"))
    return d.select("doc_id", X.section(F.col("report"), "Whole body", "\norigin", F.lit("none")).alias("body"),
                    X.section(F.col("report"), "Origin", None, F.lit("none")).alias("origin"))


@query("txt11b_clean_whole", "SELECT doc_id, nullif(text, '') AS body FROM documents")
def clean_whole(t: Tables):
    return t.documents.select("doc_id", X.clean_cut(F.col("text")).alias("body"))


@query("txt11_clean_cut", """
SELECT doc_id, nullif(substring(text, 1, 2000), '') AS body, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS origin,
  'v1_' || doc_id AS clean_id FROM documents
""")
def clean_cut(t: Tables):
    k = F.col("doc_id")
    return t.documents.select("doc_id", X.clean_cut(F.col("text"), 2000).alias("body"),
                              X.clean_cut(F.when(k % 5 == 0, "").otherwise(F.col("source")), 1000).alias("origin"),
                              X.clean_id(F.concat(F.lit("urn:oid:v1."), k.cast("string")), "urn:oid:").alias("clean_id"))


# -- hashes and keys -------------------------------------------------------------


@query("hsh01_row_hash", r"""
SELECT c_custkey, sha1('{"c_acctbal": ' || c_acctbal::VARCHAR || ', "c_custkey": ' || c_custkey || ', "c_mktsegment": ' ||
  CASE WHEN c_custkey % 4 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || ', "c_name": "' || c_name || '"' ||
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ', "c_nationkey": ' || c_nationkey END || '}') AS row_hash FROM customer
""")
def row_hash(t: Tables):
    """NULL is part of the hashed text, an absent key is not."""
    c = t.customer.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")))
    return c.select("c_custkey", K.row_hash(c, present={"c_nationkey": F.col("c_custkey") % 3 != 0}).alias("row_hash"))


@query("hsh02_row_id", r"""
SELECT event_id, sha1('{"event_id": ' || event_id || ', "event_type": "' || event_type || '", "props": "' || replace(props, '"', '\"') ||
  '", "ts": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '", "user_id": ' || user_id || ', "value": ' || value::VARCHAR || '}') AS _row_id
FROM events
""")
def row_id(t: Tables):
    return K.with_row_id(t.events).select("event_id", "_row_id")


@query("hsh02b_row_id_lineitem", """
SELECT l_orderkey, l_linenumber, sha1('{"l_discount": ' || l_discount::VARCHAR || ', "l_extendedprice": ' || l_extendedprice::VARCHAR || ', "l_linenumber": ' || l_linenumber ||
  ', "l_linestatus": "' || l_linestatus || '", "l_orderkey": ' || l_orderkey || ', "l_partkey": ' || l_partkey || ', "l_quantity": ' || l_quantity::VARCHAR ||
  ', "l_returnflag": "' || l_returnflag || '", "l_shipdate": "' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '", "l_suppkey": ' || l_suppkey ||
  ', "l_tax": ' || l_tax::VARCHAR || '}') AS _row_id FROM lineitem
""")
def row_id_lineitem(t: Tables):
    """lineitem has no unique key, so its rows get an id from all their values."""
    return K.with_row_id(t.lineitem).select("l_orderkey", "l_linenumber", "_row_id")


@query("hsh03_id_fallback", r"""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' || doc_id WHEN doc_id % 3 = 1 THEN 'b' || doc_id
  ELSE sha256('{"_id": null, "id": null, "lang": "' || lang || '", "n_chars": ' || n_chars || ', "source": "' || source || '"}') END AS document_id
FROM documents
""")
def id_fallback(t: Tables):
    k = F.col("doc_id")
    d = t.documents.select("doc_id", F.when(k % 3 == 0, F.concat(F.lit("a"), k.cast("string"))).alias("id"),
                           F.when(k % 3 == 1, F.concat(F.lit("b"), k.cast("string"))).alias("_id"), "lang", "n_chars", "source")
    return d.select("doc_id", K.document_id(d.drop("doc_id"), ["id", "_id"]).alias("document_id"))


@query("hsh04_series_id", """
SELECT event_id, md5('metric_' || event_type || '{k=' || json_extract_string(props, '$.k') || ',user=' || user_id || '}') AS series_id FROM events
""")
def series_id(t: Tables):
    labels = F.map_concat(F.create_map(F.lit("user"), F.col("user_id").cast("string")), F.from_json("props", "map<string,string>"))
    return t.events.select("event_id", K.series_id(F.concat(F.lit("metric_"), "event_type"), labels).alias("series_id"))


@query("hsh05_change_hash", "SELECT p_partkey, md5('string:' || p_name) AS digest FROM part")
def change_hash(t: Tables):
    return t.part.select("p_partkey", K.change_hash(F.lit("string"), F.col("p_name")).alias("digest"))


@query("hsh06_generated_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'N' THEN 'gen-' || md5(l_orderkey || '_' || l_partkey || '__' || l_linenumber) ELSE l_orderkey::VARCHAR END AS guid,
  substring(md5(l_orderkey::VARCHAR), 1, 8) AS short_id,
  'q_' || l_linenumber || '_' || substring(sha256('q:' || l_linenumber || ':' || l_linestatus), 1, 16) AS message_id
FROM lineitem
""")
def generated_key(t: Tables):
    order = F.col("l_orderkey").cast("string")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        K.generated_key(F.when(F.col("l_returnflag") != "N", order),
                        [F.col("l_orderkey"), F.col("l_partkey"), F.lit(None).cast("string"), F.col("l_linenumber")]).alias("guid"),
        K.short_digest(order).alias("short_id"),
        K.message_key(F.lit("q"), F.col("l_linenumber"), F.col("l_linestatus")).alias("message_id"))


@query("hsh07_positional_key", """
SELECT doc_id, pos::INTEGER AS pos, doc_id || '_' || pos AS line_id FROM (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
""")
def positional_key(t: Tables):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", "pos", K.positional_key(F.col("doc_id"), F.col("pos")).alias("line_id"))
