"""Row validation, rejects and their counts."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.queries.registry import Tables, query
from tidemark.session import work_dir
from tidemark.sources import checked_sink as B


def text_rows(t: Tables):
    """Customers as text columns with seven kinds of planted errors."""
    k = F.col("c_custkey")
    key = k.cast("string")

    def spoiled(n, bad, good):
        return F.when(k % 20 == n, bad).otherwise(good)

    return t.customer.select(
        "c_custkey", spoiled(1, F.concat(key, F.lit("b")), key).alias("int_column"),
        spoiled(2, F.lit("  "), F.col("c_name")).alias("string_column"),
        spoiled(3, F.lit("12 thousand"), F.concat(key, F.lit("0000000"))).alias("long_column"),
        spoiled(4, F.lit('{"open": ['), F.concat(F.lit('{"segment": "'), "c_mktsegment", F.lit('"}'))).alias("json_column"),
        spoiled(5, F.lit("maybe"), F.when(k % 2 == 0, "TRUE").otherwise("false")).alias("bool_column"),
        spoiled(6, F.lit("2003-02-3?"), F.lit("2003-02-28")).alias("date_column"),
        spoiled(7, F.lit("2003-02-28 noon"), F.lit("2003-02-28 7:05:30")).alias("stamp_column"))



def rules():
    c = F.col
    return [Q.Rule("int", Q.whole_number(c("int_column"))), Q.Rule("long", Q.whole_number(c("long_column"))),
            Q.Rule("bool", Q.flag_word(c("bool_column"))), Q.Rule("string", Q.not_blank(c("string_column"))),
            Q.Rule("json", Q.json_text(c("json_column"))), Q.Rule("date", Q.date_text(c("date_column"))),
            Q.Rule("datetime", Q.stamp_text(c("stamp_column")))]


REASON_SQL = """CASE c_custkey % 20 WHEN 1 THEN 'int' WHEN 2 THEN 'string' WHEN 3 THEN 'long' WHEN 4 THEN 'json' WHEN 5 THEN 'bool' WHEN 6 THEN 'date' WHEN 7 THEN 'datetime' END"""


@query("dq01_typed_rows", f"""
SELECT c_custkey, c_custkey::INTEGER AS int_value, c_custkey * 10000000 AS long_value, c_custkey % 2 = 0 AS bool_value, c_name AS string_value,
  DATE '2003-02-28' AS date_value, TIMESTAMP '2003-02-28 07:05:30' AS stamp_value FROM customer WHERE {REASON_SQL} IS NULL
""")
def typed_rows(t: Tables):
    good = Q.accepted(Q.with_reason(text_rows(t), rules()))
    return good.select("c_custkey", F.col("int_column").cast("int").alias("int_value"), F.col("long_column").cast("bigint").alias("long_value"),
                       (F.lower("bool_column") == "true").alias("bool_value"), F.col("string_column").alias("string_value"),
                       F.to_date("date_column").alias("date_value"),
                       F.try_to_timestamp("stamp_column", F.lit("yyyy-M-d H:m:s")).cast("timestamp_ntz").alias("stamp_value"))


@query("snk02_rejects", f"SELECT c_custkey, {REASON_SQL} AS reject_reason FROM customer WHERE {REASON_SQL} IS NOT NULL")
def rejects(t: Tables):
    bad = Q.rejected(Q.with_reason(text_rows(t), rules()))
    return bad.select(F.get_json_object("row", "$.c_custkey").cast("bigint").alias("c_custkey"), Q.REASON)


@query("snk02b_both_in_one_commit", f"SELECT c_custkey, {REASON_SQL} AS reason FROM customer")
def both_in_one_commit(t: Tables):
    """Accepted and rejected rows through a sink that lists both in one commit of the driver; a first run, whose tasks fail late, leaves nothing to be seen."""
    path = work_dir(t.spark, "checked")
    checked = Q.with_reason(text_rows(t), rules())
    rows = checked.drop(Q.REASON)
    last = t.customer.agg(F.max("c_custkey")).first()[0]
    fails = F.when(F.col("c_custkey") == last, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.lit(None))
    try:
        B.write_checked(rows, path, fails)
        raise AssertionError("the first run did not fail")
    except PySparkException:
        if B.commits(path):
            raise AssertionError("a failed run can be seen") from None
    B.write_checked(checked.withColumnRenamed(Q.REASON, "why").select(*rows.columns, "why"), path, F.col("why"))
    good, bad = B.read_checked(t.spark, path, "accepted"), B.read_checked(t.spark, path, "rejected")
    return good.select("c_custkey", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("c_custkey", F.col(B.REASON).alias("reason")))


@query("agg13_reject_counts", f"SELECT coalesce({REASON_SQL}, 'ok') AS reason, count(*) AS n FROM customer GROUP BY 1")
def reject_counts(t: Tables):
    return Q.reject_counts(Q.with_reason(text_rows(t), rules()))


@query("dq02_required", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'missing id' WHEN o_orderkey % 4 = 0 THEN 'missing updated_at' END AS reject_reason FROM orders
""")
def required(t: Tables):
    k = F.col("o_orderkey")
    rows = t.orders.select("o_orderkey", F.when(k % 6 != 0, k).alias("id"), F.when(k % 4 != 0, F.col("o_orderdate")).alias("updated_at"))
    return Q.with_reason(rows, Q.required("id", "updated_at")).select("o_orderkey", Q.REASON)


@query("dq03_identifier", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'bad name' END AS reject_reason FROM part
""")
def identifier(t: Tables):
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("; drop"))).otherwise(F.concat(F.lit("t_"), F.col("p_size").cast("string")))
    return Q.with_reason(t.part.select("p_partkey", name.alias("name")), [Q.Rule("bad name", Q.identifier(F.col("name")))]).drop("name")


@query("dq04_domain", """
SELECT p_partkey, CASE WHEN NOT (p_size BETWEEN 1 AND 40) THEN 'size' WHEN p_type NOT IN ('ECONOMY', 'PROMO') THEN 'type' END AS reject_reason FROM part
""")
def domain(t: Tables):
    found = Q.with_reason(t.part, [Q.Rule("size", F.col("p_size").between(1, 40)), Q.Rule("type", F.col("p_type").isin("ECONOMY", "PROMO"))])
    return found.select("p_partkey", Q.REASON)


@query("dq06_threshold", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000")
def threshold(t: Tables):
    checked = Q.with_reason(t.orders.select("o_orderkey", "o_totalprice"), [Q.Rule("price", F.col("o_totalprice") > 1000)])
    return Q.stop_above(checked, share=0.5)
