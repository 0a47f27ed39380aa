"""Chat formatting: quotation linking.

A message may quote earlier ones in lines marked by ``>`` signs, nested as deep as people reply, under a line such as
"... wrote:". Quote levels are parsed line by line; each run of quoted lines becomes a passage, which is normalised and
hashed. Passages are joined by hash to the messages that said them in their own words: whole messages, paragraphs and
lines all count as sayings. A message replies to the latest earlier message that its shallowest quote comes from, or
else to the one before it in its conversation. Conversations are ordered so that a message follows what it replies to,
and keep own words only; attribution lines go with the quotes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import map_texts, written

MARK = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
ATTRIBUTION = re.compile(r"^\s*(?:on\b.*\bwrote|.{1,80}\b(?:wrote|writes|said|schrieb|a écrit|escribió))\s*:\s*$", re.I)
#: Shorter passages say too little to name a message of another conversation; their hashes begin with ``SHORT``.
LEAST_WORDS, SHORT = 3, "~"


def levels(text: str | None) -> list[tuple[int, str]]:
    """(quote level, line without its marks) of each line; level 0 is the author's own. A null text has no lines."""
    out = []
    for line in (text or "").split("\n"):
        m = MARK.match(line)
        out.append((m.group(1).count(">"), line[m.end():].strip()) if m else (0, line))
    return out if text else []


def normalised(text: str) -> str:
    """Lower-case words with single spaces: wrapped lines and white space do not tell passages apart."""
    return " ".join(re.sub(r"[^\w\s]", " ", text.lower()).split())


def passage_hash(text: str) -> str | None:
    """Hash of a normalised passage, marked for a short one; None without words."""
    t = normalised(text)
    return (SHORT if t.count(" ") < LEAST_WORDS - 1 else "") + hashlib.md5(t.encode()).hexdigest() if t else None


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """(own words, [(level, passage hash)]): quotes and the attribution lines right before them are taken out."""
    own, passages = [], []
    lines = levels(text)
    run: list[str] = []
    for i, (level, line) in enumerate(lines):
        follows = next((lv for lv, ln in lines[i + 1:i + 3] if ln.strip()), 0)
        if level == 0 and not (follows > 0 and ATTRIBUTION.match(line)):
            own.append(line)
        if level > 0 and not ATTRIBUTION.match(line) and line:
            run.append(line)
        if run and (i + 1 == len(lines) or lines[i + 1][0] != level or not line):
            whole = passage_hash(" ".join(run))
            passages += [(level, whole)] if whole else []
            if len(run) > 1:
                passages += [(level, h) for h in map(passage_hash, run) if h and not h.startswith(SHORT)]
            run = []
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(), list(dict.fromkeys(passages))


def sayings(own: str) -> list[str]:
    """Hashes of what a message says itself: all of it, its paragraphs and its lines."""
    parts = [own, *re.split(r"\n\s*\n", own), *own.split("\n")]
    return list(dict.fromkeys(h for h in map(passage_hash, parts) if h))


def carried(rows: DataFrame, group: str, order: list, value: str) -> DataFrame:
    """All columns plus ``n`` (rows before this one in its group) and ``prev`` (the last ``value`` before it that is not null).

    Rows are range-sorted by group and order, so a group with a third of all rows lies in many tasks. Each task numbers
    its own part; a row for each group and task then gives what comes before that part.
    """
    kind = rows.schema[value].dataType.simpleString()
    names = rows.columns
    at, vt = names.index(group), names.index(value)

    def number(batches):
        part, last, count, prev = TaskContext.get().partitionId(), None, 0, None
        for batch in batches:
            n, before, after = [], [], []
            for g, v in zip(batch.column(at).to_pylist(), batch.column(vt).to_pylist()):
                if g != last:
                    last, count, prev = g, 0, None
                n.append(count)
                before.append(prev)
                count += 1
                prev = prev if v is None else v
                after.append(prev)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(before, batch.column(vt).type),
                                              pa.array(after, batch.column(vt).type), pa.array([part] * len(n), pa.int32())],
                                             [*names, "_n", "_prev", "_after", "_part"])

    in_order = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    local = written(in_order.mapInArrow(number, f"{types}, _n bigint, _prev {kind}, _after {kind}, _part int"), "carried")
    parts = local.groupBy(group, "_part").agg(F.count("*").alias("_rows"), F.max_by("_after", "_n").alias("_last"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(group, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"), F.last("_last", True).over(before).alias("_from"))
    return local.join(parts, [group, "_part"]).select(*names, (F.col("_off") + F.col("_n")).alias("n"), F.coalesce("_prev", "_from").alias("prev"))


def id_text(column) -> F.Column:
    """A text for each id, null apart."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own text, n_quotes, reply_conv_id, reply_turn, reply_order of every row.

    A quote is looked for in the same conversation first, in others only if no message there said it; among several
    messages the latest earlier one counts (in another conversation: the first in order of conversation and turn). Short passages are looked for in the same one only.
    reply_order numbers a conversation's messages so that a reply follows its original: they go by turn, and a message
    whose turn is missing goes last. Null texts have no words and no quotes. Rows with the same conversation and turn all
    stay, in order of role and text. A null conversation is one conversation of its own.
    """
    base = messages.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("row"))

    def make():
        def fn(texts):
            got = [parse(t) for t in texts]
            return [[g[0] for g in got], [[{"level": a, "hash": b} for a, b in g[1]] for g in got], [sayings(g[0]) for g in got]]
        return fn

    parsed = written(map_texts(base, make, [("own", "string"), ("quotes", "array<struct<level:int,hash:string>>"), ("said", "array<string>")],
                               ["row", "conv_id", "turn", "role"], ["text"]), "messages")
    quotes = parsed.select("row", "conv_id", "turn", F.explode("quotes").alias("q")).select("row", "conv_id", "turn", "q.level", "q.hash")
    said = parsed.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.explode("said").alias("hash"))
    # only what is quoted at all is looked up
    said = said.join(quotes.select("hash").distinct(), "hash", "left_semi")
    # the latest saying of the same conversation before a quote: both sorted together, sayings after quotes of their turn
    both = quotes.select("row", "conv_id", "turn", "level", "hash", F.lit(None).cast("bigint").alias("t")).unionByName(
        said.select(F.lit(None).cast("bigint").alias("row"), F.col("c").alias("conv_id"), F.col("t").alias("turn"), F.lit(0).alias("level"), "hash", "t"))
    both = both.withColumn("g", F.concat("hash", id_text(F.col("conv_id"))))
    near = carried(both, "g", [F.col("turn").asc_nulls_last(), F.col("row").asc_nulls_last(), "level"], "t").where("row is not null").drop("t")
    # the first sayings of the two least conversations: one of them is not the quoting one
    each = said.where(~F.col("hash").startswith(SHORT) & F.col("t").isNotNull()).groupBy("hash", "c").agg(F.min("t").alias("t"))
    first = each.groupBy("hash").agg(F.min(F.struct("c", "t")).alias("first"))
    second = each.join(first, "hash").where(~F.col("c").eqNullSafe(F.col("first.c"))).groupBy("hash").agg(F.min(F.struct("c", "t")).alias("second"))
    found = near.join(first, "hash", "left").join(second, "hash", "left")
    other = F.when(~F.col("first.c").eqNullSafe(F.col("conv_id")), F.col("first")).otherwise(F.col("second"))
    found = found.select("row", "level", F.col("prev").isNotNull().alias("same"), F.col("hash").startswith(SHORT).alias("short"), F.coalesce("prev", other["t"]).alias("t"),
                         F.when(F.col("prev").isNotNull(), F.col("conv_id")).otherwise(other["c"]).alias("c")).where("t is not null")
    # the shallowest quote, one of the same conversation first, then the latest
    best = found.groupBy("row").agg(F.min_by(F.struct("c", "t"), F.struct("level", ~F.col("same"), "short", -F.col("t"))).alias("to"))
    placed = parsed.select("row", "conv_id", "turn", "role", "own", F.size(F.filter("quotes", lambda q: ~q["hash"].startswith(SHORT))).cast("bigint").alias("n_quotes"), id_text(F.col("conv_id")).alias("g"))
    placed = carried(placed, "g", [F.col("turn").asc_nulls_last(), "role", "own", "row"], "turn")
    return placed.join(best, "row", "left").select(
        "conv_id", "turn", "role", F.col("own").alias("text"), "n_quotes",
        F.coalesce(F.col("to.c"), F.when(F.col("prev").isNotNull(), F.col("conv_id"))).alias("reply_conv_id"),
        F.coalesce(F.col("to.t"), F.col("prev")).alias("reply_turn"), F.col("n").alias("reply_order"))
