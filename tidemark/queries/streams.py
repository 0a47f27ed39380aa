"""Landed event files as streams. The files are cut by time; results are read from the tables the streams fill."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions import values as N
from tidemark.operators import changes as C
from tidemark.plans.store import KeyedTable
from tidemark.queries.registry import Tables, query
from tidemark.sources import topics as K
from tidemark.session import work_dir
from tidemark.streaming import drain as D
from tidemark.streaming import state as S

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props, false AS _deleted FROM events"


def landed(t: Tables, rows, parts: int = 10):
    path = work_dir(t.spark, "landed")
    rows.repartitionByRange(parts, "ts").write.parquet(path)
    return D.file_stream(t.spark, path, t.spark.read.parquet(path).schema, files_per_batch=4)


@query("str01_queue_drain", EVENTS)
def queue_drain(t: Tables):
    table = KeyedTable(t.spark, work_dir(t.spark, "drain"), ["event_id"])
    D.drain(landed(t, t.events), table, work_dir(t.spark, "checkpoint"), "events",
            order=F.unix_micros(F.col("ts").cast("timestamp")))
    return table.read()


@query("src14_topics", "SELECT event_type AS topic, max(event_id) AS position, count(*) AS messages FROM events GROUP BY 1")
def topics(t: Tables):
    """Several topics in one run: the messages of all in one table, and the last position of each in its state."""
    table = KeyedTable(t.spark, work_dir(t.spark, "topics"), ["event_type", "event_id"])
    D.drain(landed(t, t.events.select("event_type", "event_id", "ts")), table, work_dir(t.spark, "checkpoint"), "topics", positions=("event_type", "event_id"))
    state = [(k.removeprefix("position:"), v) for k, v in table.state().items() if k.startswith("position:")]  # one row for each topic
    counts = table.read().groupBy(F.col("event_type").alias("topic")).agg(F.count("*").alias("messages"))
    return counts.join(t.spark.createDataFrame(state, "topic string, position bigint"), "topic")


@query("src14b_bounded_topics", """
WITH m AS (SELECT event_type AS topic, event_id AS position, user_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events WHERE event_type IN (
  SELECT event_type FROM events GROUP BY 1 ORDER BY 1 LIMIT 3))
SELECT topic, position, user_id, false AS _deleted FROM m
""")
def bounded_topics(t: Tables):
    """Three topics through a source of their own, in runs of a third of the longest topic each; the second run stops between write and acknowledgement."""
    path, acks, checkpoint = work_dir(t.spark, "broker"), work_dir(t.spark, "acks"), work_dir(t.spark, "checkpoint")
    names = [r[0] for r in t.events.select("event_type").distinct().orderBy("event_type").limit(3).collect()]
    messages = t.events.filter(F.col("event_type").isin(names))
    most = messages.groupBy("event_type").count().agg(F.max("count")).first()[0]
    K.land(messages.select("event_type", "event_id", "user_id"), path, "event_type", "event_id", per_file=most)
    table, runs = KeyedTable(t.spark, work_dir(t.spark, "topics"), ["topic", "position"]), []

    def stop(batch_id):
        runs.append(batch_id)
        if len(runs) == 2:
            raise RuntimeError("lost between write and acknowledgement")

    at, before = {}, None
    while at != before:
        before = dict(at)
        try:
            at = D.drain_topics(t.spark, path, "user_id bigint", table, checkpoint, "topics", acks, -(-most // 3), stop)
        except StreamingQueryException:
            before = None
        if any(p > at.get(k, -1) for k, p in K.read_acks(acks).items()):
            raise AssertionError("acknowledged before the write")
    if len(runs) < 4 or len(at) != 3:
        raise AssertionError(f"{len(runs)} runs to {at}")
    return table.read()


@query("str01b_late_messages", """
SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max_by(event_type, (ts, event_id)) AS event_type, false AS _deleted FROM events GROUP BY 1
""")
def late_messages(t: Tables):
    """Batches arrive newest first; the order of the messages decides, not the order of the batches."""
    path = work_dir(t.spark, "late")
    late = t.events.select("user_id", "event_id", "event_type", "ts")
    late.repartitionByRange(10, F.col("ts").desc()).write.parquet(path)
    table = KeyedTable(t.spark, work_dir(t.spark, "latest"), ["user_id"])
    stream = D.file_stream(t.spark, path, t.spark.read.parquet(path).schema, files_per_batch=3)
    D.drain(stream, table, work_dir(t.spark, "checkpoint"), "late", order=F.struct("ts", "event_id"))
    return table.read().drop("ts")


@query("str02_write_then_ack", EVENTS)
def write_then_ack(t: Tables):
    """The drain stops between write and acknowledgement of its second batch and is started again."""
    table = KeyedTable(t.spark, work_dir(t.spark, "ack"), ["event_id"])
    stream, checkpoint, seen = landed(t, t.events), work_dir(t.spark, "checkpoint"), []

    def stop():
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("lost before the acknowledgement")

    try:
        D.drain(stream, table, checkpoint, "events", before_publish=stop)
    except StreamingQueryException:
        pass
    if len(seen) != 2:
        raise AssertionError("the stop did not happen")
    D.drain(stream, table, checkpoint, "events")
    return table.read()


@query("str03_old_message_drop", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def old_message_drop(t: Tables):
    out = work_dir(t.spark, "fresh")
    fresh = landed(t, t.events.select("event_id", "ts")).filter(D.not_older(F.col("ts"), F.lit("2024-01-10").cast("timestamp_ntz")))
    D.to_files(fresh, out, work_dir(t.spark, "checkpoint"))
    return t.spark.read.parquet(out)


@query("str04_stream_dedupe", "SELECT event_id, ts, event_type FROM events")
def stream_dedupe(t: Tables):
    """Every message arrives twice, the copy in the same file."""
    e = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    out = work_dir(t.spark, "unique")
    D.to_files(D.first_of_id(landed(t, e.unionByName(e)), ["event_id"], "ts", "60 days"), out, work_dir(t.spark, "checkpoint"))
    return t.spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("str05_last_position", "SELECT user_id, max(ts) AS last_ts, false AS _deleted FROM events GROUP BY 1")
def last_position(t: Tables):
    """Running maximum per key in update mode; each batch upserts the keys it changed."""
    table = KeyedTable(t.spark, work_dir(t.spark, "positions"), ["user_id"])

    def write(batch, batch_id):
        table.commit(C.upserts(batch, batch_id), batch=("positions", batch_id))

    positions = D.last_positions(landed(t, t.events), ["user_id"], "ts")
    positions.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", work_dir(t.spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return table.read()


def landed_in_turn(t: Tables, rows, parts: int = 6):
    """Files that land one after the other, in order of time."""
    path = work_dir(t.spark, "turns")
    spans = rows.select(F.explode(F.percentile_approx("ts", [i / parts for i in range(1, parts)])).alias("b")).collect()
    bounds = [None, *sorted({r["b"] for r in spans}), None]
    for low, high in zip(bounds, bounds[1:]):
        part = rows if low is None else rows.filter(F.col("ts") >= F.lit(low))
        part = part if high is None else part.filter(F.col("ts") < F.lit(high))
        part.repartition(1).write.mode("append").parquet(path)  # one file, but the table is read by many tasks
    return D.file_stream(t.spark, path, rows.schema, files_per_batch=1)


@query("str05b_position_expiry", """
SELECT user_id, max(ts) AS last_ts, arg_max(event_id, (ts, event_id)) AS position,
  date_trunc('millisecond', max(ts)) + INTERVAL 12 HOUR <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 1 HOUR AS _deleted FROM events GROUP BY 1
""")
def position_expiry(t: Tables):
    """Positions in a state of their own with timers: keys silent for half a day are deleted, and come back when they speak again. The stream is stopped before its third batch is done and started again."""
    table = KeyedTable(t.spark, work_dir(t.spark, "expiry"), ["user_id"])
    stream, checkpoint, batches = landed_in_turn(t, t.events.select("user_id", "event_id", "ts")), work_dir(t.spark, "checkpoint"), []
    changes = S.positions_with_expiry(stream, ["user_id"], "ts", "event_id", "1 hour", 12 * 3600 * 1000)

    def stop(batch_id):
        batches.append(batch_id)
        if len(batches) == 3:
            raise RuntimeError("lost before the acknowledgement")

    try:
        S.upsert_positions(changes, table, checkpoint, "expiry", ["user_id"], "last_ts", "position", stop)
    except StreamingQueryException:
        pass
    if batches != [0, 1, 2]:
        raise AssertionError(f"the stop did not happen: {batches}")
    S.upsert_positions(changes, table, checkpoint, "expiry", ["user_id"], "last_ts", "position")
    return table.read()


@query("str06_stepped_series", """
SELECT event_type, time_bucket(INTERVAL 15 SECOND, ts) AS step_start, arg_max(value, (ts, value)) AS value FROM events GROUP BY 1, 2
""")
def stepped_series(t: Tables):
    return D.stepped(t.events, ["event_type"], "ts", "value", "15 seconds")


@query("str07_message_rows", """
SELECT 'm:' || event_id AS message_id, 'events' AS topic, make_timestamp((epoch_us(ts) // 1000) * 1000) AS publish_time,
  CASE WHEN event_id % 4 <> 0 THEN make_timestamp((epoch_us(ts) // 1000) * 1000) END AS event_time, CASE WHEN event_id % 5 <> 0 THEN user_id::VARCHAR END AS message_key,
  CASE event_id % 3 WHEN 0 THEN replace(props, ' ', '') WHEN 1 THEN '{"raw_data":"' || event_type || '"}' ELSE '{"raw_data_base64":"' || base64('\\xFF'::BLOB || encode(event_type)) || '"}' END AS data,
  'p' || (user_id % 3) AS producer_name, event_id AS sequence_id FROM events
""")
def message_rows(t: Tables):
    """Envelopes decoded inside the stream by the same expressions a batch uses."""
    k, text = F.col("event_id"), F.encode("event_type", "UTF-8")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    raw = t.events.select(
        k, "ts", F.when(k % 3 == 0, F.encode("props", "UTF-8")).when(k % 3 == 1, text).otherwise(F.concat(F.unhex(F.lit("FF")), text)).alias("body"),
        millis.alias("publish_ms"), F.when(k % 4 == 0, F.lit(0)).otherwise(millis).alias("event_ms"),
        F.when(k % 5 == 0, "").otherwise(F.col("user_id").cast("string")).alias("key"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("producer"))
    stream = landed(t, raw)
    row = N.message_row(F.lit("events"), F.col("body"), F.col("publish_ms"), F.col("event_ms"), F.col("key"), F.col("producer"), k,
                        F.concat(F.lit("m:"), k.cast("string")))
    out = work_dir(t.spark, "messages")
    D.to_files(stream.select(*[c.alias(n) for n, c in row.items()]), out, work_dir(t.spark, "checkpoint"))
    return t.spark.read.parquet(out)
