"""One query for each operator over its whole table, with SQL where SQL can express it. The queries derive digests; the operators give the real outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, centroids, decontaminate, html_text, infill, packing, pii, quality_classifier, quality_rules, quotations, sharding, simhash,
                          toxicity)
from tidemark.llm.shared import read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside occurrences of benchmark windows, and the items found."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, read(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit("hits")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.is_contaminated(F.col("n_words"), hit).alias("contaminated"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document and the text they decode to, as digests."""
    done = bpe.tokenized(read(spark, sf_dir, "documents"), bpe.default_path(), keep=["doc_id"])
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_text.extracted(read(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, with the nearest examples as evidence."""
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, and its shard if there were one more."""
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document: base spans as counts and digest, all spans as text."""
    found = pii.with_spans(read(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of each document, and whether the rules' posterior keeps it."""
    return quality_rules.judged(read(spark, sf_dir, "documents").select("doc_id", "text"), quality_rules.NAMES, keep=["doc_id"])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document, and the smallest id of its near-duplicates."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document."""
    return quality_classifier.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without quotes, with what they reply to, in reply order of their conversation."""
    return quotations.linked(read(spark, sf_dir, "conversations"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document rearranged for filling in its middle, and the text rebuilt from that, as digests."""
    done = infill.filled_in_middle(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, each filled with the lexical neighbours of its seed."""
    return packing.packed(read(spark, sf_dir, "documents"), packing.default_path())


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each embedding after five rounds of exact k-means."""
    return centroids.clustered(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontaminate, op2_bpe, op3_html_text, op4_toxicity, op5_sharding, op6_pii, op7_quality_rules, op8_simhash, op9_quality_classifier, op10_quotations,
    op11_infill, op12_packing, op13_centroids)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

def _rounds(n: int) -> str:
    """n rounds of assignment and exact means as SQL, from the centroids c0(num, i, y) over the long vectors x(rid, i, v)."""
    steps = []
    for r in range(n + 1):
        steps.append(f"""
d{r} as materialized (select rid, num, sum((v - y) * (v - y)) as dist from x join c{r} using (i) group by rid, num),
a{r} as materialized (select rid, min(dist) as distance, arg_min(num, dist * 64 + num) as num from d{r} group by rid)""")
        if r < n:
            steps.append(f"""
m{r} as (select num, i, sum(v) as total, count(*) as n from a{r} join x using (rid) group by num, i),
c{r + 1} as materialized (select num, i, coalesce((total - ((total % n) + n) % n) // n, y) as y from c{r} left join m{r} using (num, i))""")
    return ",".join(steps)


_INFILL_HASH = lambda i: f"('0x' || substr(h, {8 * i + 1}, 8))::bigint"

ORACLES: dict[str, str] = {
    "op11_infill": f"""
with u as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
                  sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
c as (select *, len(u)::bigint as n, {_INFILL_HASH(0)} % (len(u) + 1) as a, {_INFILL_HASH(1)} % (len(u) + 1) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or {_INFILL_HASH(2)} % 100 >= 90 then 'plain'
                  when {_INFILL_HASH(3)} % 100 < 20 then 'spm' else 'psm' end as form from u),
p as (select *, array_to_string(u[1:least(a, b)], '') as pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as mid,
             array_to_string(u[greatest(a, b) + 1:], '') as suf from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
              else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256, sha256(t) as restored_sha256
from p""",
    "op13_centroids": f"""
with k as materialized (select row_number() over () as rid, vec_id, embedding as e from embeddings
           where len(embedding) = 64 and len(list_filter(embedding, lambda z: z is not null and isfinite(z))) = 64),
x as materialized (select rid, vec_id, unnest(range(1, 65)) as i, unnest(list_transform(e, lambda z: floor(256 * z::double)::bigint)) as v from k),
f as (select rid, row_number() over (order by sha256('2:' || vec_id::varchar)) - 1 as num from k order by num limit 40),
c0 as (select num, i, v as y from f join x using (rid)),{_rounds(5)},
t as (select num, sum(distance) as ci from a5 group by num),
s as (select num, sha256(string_agg(y::bigint::varchar, ',' order by i)) as digest from c5 group by num)
select vec_id, num::int as cluster, distance::bigint as distance, ci::bigint as cluster_inertia, (select sum(ci) from t)::bigint as inertia, digest as centroid_sha256
from a5 join k using (rid) join t using (num) join s using (num)""",
    "op1_decontaminate": f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
items as (select item_id::varchar as item, {_WORDS} as w from benchmark),
windows as (
    select distinct item, least(13, len(w)) as k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as win
    from (select item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from items where len(w) > 0)),
starts as (
    select rid, k, i, array_to_string(w[i:i + k - 1], ' ') as win
    from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from windows) where len(w) >= k)),
hits as (select rid, s.k, i, item from starts s join windows x on s.win = x.win and s.k = x.k),
words as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + k)) as p from hits) group by rid),
found as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct rid, item from hits where item is not null) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (rid) left join found using (rid)""",
}
