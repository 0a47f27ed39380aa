"""User functions and scoring with small rule-based scorers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import enrich as E
from tidemark.operators import project, summary
from tidemark.queries.relational import FRONTIER_SQL, REACHED_SQL
from tidemark.queries.registry import Tables, query


def words(texts: pd.Series) -> pd.Series:
    return texts.str.split(" ").str.len()


@query("udf01_record_hook", "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey * 2 AS doubled FROM customer")
def record_hook(t: Tables):
    """A column function, then a Python function on Arrow batches."""

    def double(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(doubled=batch["c_nationkey"] * 2)[["c_custkey", "c_name", "doubled"]]

    upper = E.apply_hook(t.customer.select("c_custkey", "c_name", "c_nationkey"), lambda df: df.withColumn("c_name", F.upper("c_name")))
    return E.apply_batch_hook(upper, double, "c_custkey bigint, c_name string, doubled int")


@query("udf02_budgeted_score", """
SELECT d.doc_id, d.lang, s.words FROM documents d LEFT JOIN (SELECT doc_id, len(string_split(text, ' '))::BIGINT AS words FROM documents WHERE lang <> 'fr' ORDER BY doc_id LIMIT 40) s USING (doc_id)
""")
def budgeted_score(t: Tables):
    score = F.pandas_udf(words, "bigint")
    docs = t.documents.select("doc_id", "lang", F.when(F.col("lang") != "fr", F.col("text")).alias("text"))
    return E.budgeted_score(docs, "doc_id", "text", score, "words", E.row_budget(120, 3), heap=True).drop("text")


@query("udf02b_budget_as_share", """
SELECT d.doc_id, s.words FROM documents d LEFT JOIN (SELECT doc_id, len(string_split(text, ' '))::BIGINT AS words FROM documents WHERE lang <> 'fr'
  QUALIFY row_number() OVER (ORDER BY lang, doc_id) <= (SELECT count(*) // 3 FROM documents)) s USING (doc_id)
""")
def budget_as_share(t: Tables):
    """A third of the table is scored, in an order with a text in front."""
    docs = t.documents.select("doc_id", "lang", F.when(F.col("lang") != "fr", F.col("text")).alias("text"))
    budget = E.row_budget(docs.count(), 3)
    return E.budgeted_score(docs, "doc_id", "text", F.pandas_udf(words, "bigint"), "words", budget, ["lang", "doc_id"]).drop("text", "lang")


VIEWS_SQL = """
SELECT doc_id, CASE WHEN length(text) > 500 THEN 'HIGH' ELSE 'LOW' END AS first, CASE WHEN lang <> 'fr' THEN CASE WHEN length(text) - length(replace(text, chr(10), '')) >= 3 THEN 'HIGH' ELSE 'LOW' END END AS second FROM documents
"""


def views(t: Tables):
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    second = F.when(F.col("lang") != "fr", F.when(breaks >= 3, "HIGH").otherwise("LOW"))
    return t.documents.select("doc_id", F.when(F.length("text") > 500, "HIGH").otherwise("LOW").alias("first"), second.alias("second"))


def judged(first, second):
    return F.when(first == second, first).otherwise("MEDIUM")


@query("udf03_consensus", f"SELECT doc_id, first, second, CASE WHEN first = second THEN first ELSE 'MEDIUM' END AS consensus, first <> second AS disagrees FROM ({VIEWS_SQL}) WHERE second IS NOT NULL")
def consensus(t: Tables):
    return E.consensus(views(t), "first", "second", judged)


@query("udf03b_disagreements", f"SELECT count(*) AS pairs, count(*) FILTER (first <> second) AS disagreements FROM ({VIEWS_SQL}) WHERE second IS NOT NULL")
def disagreements(t: Tables):
    both = E.consensus(views(t), "first", "second", judged)
    return both.agg(F.count("*").alias("pairs"), F.count_if("disagrees").alias("disagreements"))


@query("udf04_seed_and_expand", f"SELECT f.item, f.hop, coalesce(n, 0) AS n FROM ({FRONTIER_SQL}) f LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = f.item")
def seed_and_expand(t: Tables):
    links = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("via"))
    seed = t.part.filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("item"))
    return E.seed_and_expand(t.lineitem, links, seed, "l_partkey", hops=2, step_limit=20)


@query("udf04c_expand_all", f"SELECT f.item, f.hop, coalesce(n, 0) AS n FROM ({REACHED_SQL}) f LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = f.item")
def expand_all(t: Tables):
    """As udf04 without a limit: everything that two hops reach."""
    links = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("via"))
    seed = t.part.filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("item"))
    return E.seed_and_expand(t.lineitem, links, seed, "l_partkey", hops=2)


@query("udf04b_expanded_top", """
SELECT l_suppkey, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand = 'Brand#13' GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 5
""")
def expanded_top(t: Tables):
    seed = t.part.filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("l_partkey"))
    return summary.top_counts(t.lineitem.join(seed, "l_partkey", "left_semi"), ["l_suppkey"], 5)


@query("udf05_assessment_rows", """
SELECT doc_id, 'primary' AS assessment_type, 'HIGH' AS risk_level, len(string_split(text, ' '))::BIGINT AS words FROM documents WHERE length(text) > 200
""")
def assessment_rows(t: Tables):
    from tidemark.operators.nested import flatten

    answer = F.to_json(F.struct(F.struct(F.lit("HIGH").alias("level")).alias("risk"), F.size(F.split("text", " ")).alias("words")))
    answered = t.documents.select("doc_id", F.when(F.length("text") > 200, answer).otherwise("no answer").alias("answer"))
    return flatten(E.assessment_rows(answered, "doc_id", "answer", "risk struct<level: string>, words bigint", "primary"))


@query("udf06_clean_and_enrich", """
SELECT event_id, coalesce(CASE WHEN event_id % 3 <> 0 THEN user_id END, 0) AS number_health_problems, user_id AS number_product_problems, coalesce(CASE WHEN event_id % 4 <> 0 THEN props END, '[]') AS reported_problems,
  coalesce(CASE WHEN event_id % 3 <> 0 THEN user_id END, 0) + user_id AS total_problems, coalesce(CASE WHEN event_id % 3 <> 0 THEN user_id END, 0) > 0 AS has_health_problems, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, (isodow(ts) - 1)::INTEGER AS day_of_week FROM events
""")
def clean_and_enrich(t: Tables):
    k = F.col("event_id")
    rows = t.events.select("event_id", F.when(k % 3 != 0, F.col("user_id")).alias("number_health_problems"), F.col("user_id").alias("number_product_problems"),
                           F.when(k % 4 != 0, F.col("props")).alias("reported_problems"), F.date_format("ts", "yyyyMMdd").alias("submitted"))
    clean = project.fill_by_class(rows)
    day = F.try_to_timestamp("submitted", F.lit("yyyyMMdd"))
    return clean.withColumns({
        "total_problems": F.col("number_health_problems") + F.col("number_product_problems"), "has_health_problems": F.col("number_health_problems") > 0,
        "year": F.year(day), "month": F.month(day), "day_of_week": F.weekday(day)}).drop("submitted")
