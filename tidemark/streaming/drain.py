"""Landed message files as a stream into keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import upserts
from tidemark.plans.store import ORDER, KeyedTable
from tidemark.sources.topics import topic_stream


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """A stream over landed Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def drain(stream: DataFrame, table: KeyedTable, checkpoint: str, name: str, order: Column | None = None,
          to_log: Callable[[DataFrame], DataFrame] | None = None, before_publish=None, positions: tuple[str, str] | None = None,
          before_ack: Callable[[int], None] | None = None) -> None:
    """Write everything that has landed into the table, then stop.

    Each batch is committed to the table under its batch id before the stream marks it done: a batch that is run
    again after a stop is recognised and skipped. The rows are upserts; ``order`` (a message sequence, a time, or a struct of
    several columns) decides between messages of one key, in one batch and across batches: it is stored with each
    row, and a message that comes in a later batch but is older than the row is left out. A NULL order is older than any other. The
    order is that of the last drained message: operations committed by other means, deletes among them, neither have nor change it. Without an order a key may occur once
    in a batch, and later batches win. ``to_log`` turns a batch into any other change log. ``positions`` (topic column, position
    column) keeps the last position of each topic in the table's state, committed with the rows; one row for each topic reaches the driver.
    """

    def in_order(batch: DataFrame) -> DataFrame:
        named = batch.withColumn(ORDER, order)
        if table.head() is None or ORDER not in table.schema().fieldNames():
            return named
        # structs, so that NULL compares as the least order
        stored = table.matching(batch, [ORDER]).select(*table.keys, F.struct(F.col(ORDER).alias("o")).alias("_stored"))
        newer = F.struct(F.col(ORDER).alias("o")) >= F.col("_stored")
        return named.join(stored, table.keys, "left").where(F.col("_stored").isNull() | newer).drop("_stored")

    def write(batch: DataFrame, batch_id: int) -> None:
        if to_log:
            log = to_log(batch)
        elif order is not None:
            log = upserts(in_order(batch), F.col(ORDER))
        else:
            twice = batch.groupBy(*table.keys).count().where("count > 1").select(*table.keys).first()
            if twice is not None:
                raise ValueError(f"key {tuple(twice)} occurs more than once in batch {batch_id}; an order is needed")
            log = upserts(batch, batch_id)
        state = {"batch": batch_id}
        if positions is not None:
            old = table.state()
            for topic, last in batch.groupBy(positions[0]).agg(F.max(positions[1])).collect():
                name_of = f"position:{topic}"
                state[name_of] = max(last, old.get(name_of, last))
        table.commit(log, state=state, batch=(name, batch_id), before_publish=before_publish)
        if before_ack:
            before_ack(batch_id)

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def drain_topics(spark: SparkSession, path: str, columns: str, table: KeyedTable, checkpoint: str, name: str, acks: str, max_per_topic: int = 1000,
                 before_ack: Callable[[int], None] | None = None) -> dict[str, int]:
    """One bounded run over landed topics into a table keyed by topic and position: at most ``max_per_topic`` messages of each.

    The positions are committed with the rows, and the next run goes on from there. Returns them.
    """
    def positions() -> dict[str, int]:
        return {k.removeprefix("position:"): v for k, v in table.state().items() if k.startswith("position:")}

    stream = topic_stream(spark, path, columns, acks, max_per_topic, start=positions())
    drain(stream, table, checkpoint, name, positions=("topic", "position"), before_ack=before_ack)
    return positions()


def to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that has landed to Parquet files (exactly once), then stop."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def not_older(c: Column, mark) -> Column:
    """Messages newer than the last sync time; with no mark all of them."""
    return F.lit(True) if mark is None else c > F.lit(mark)


def first_of_id(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """First message of each id; ids are remembered for the delay, which bounds the state."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def last_positions(df: DataFrame, key: Sequence[str], time: str) -> DataFrame:
    """Last time per key; as a stream it runs in update mode."""
    return df.groupBy(*key).agg(F.max(time).alias("last_ts"))


def stepped(df: DataFrame, key: Sequence[str], time: str, value: str, step: str) -> DataFrame:
    """Last value of each key in each step of time."""
    return (df.groupBy(*key, F.window(F.col(time).cast("timestamp"), step).alias("_w"))
            .agg(F.max(F.struct(time, value)).alias("_l"))
            .select(*key, F.col("_w.start").cast("timestamp_ntz").alias("step_start"), F.col("_l")[value].alias(value)))
