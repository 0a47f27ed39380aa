"""Own state per key: the last position of each key, forgotten when the key falls silent."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.changes import deletes, union_changes, upserts
from tidemark.plans.store import KeyedTable
from tidemark.session import materialise

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timer_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which timers need; those of other streams stay where they are."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


class Positions(StatefulProcessor):
    """Keeps (time in microseconds, position) of each key in a value state, with a timer ``silent_ms`` after the last time."""

    def __init__(self, key: Sequence[str], silent_ms: int):
        self.key, self.silent_ms = list(key), silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint, position bigint, timer bigint")

    def _row(self, key: tuple, at: int, position: int, expired: bool) -> Row:
        return Row(**dict(zip(self.key, key)), at=at, position=position, expired=expired)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        # a running maximum: the rows of a hot key stream through, none is kept
        at, position = max((r["_at"], r["_position"]) for r in rows)
        timer, old = None, self.last.get()  # None for a key without state: asking first would be one more call for every key
        if old is not None:
            timer = old[2]
            if (at, position) <= (old[0], old[1]):
                return iter(())
        due = at // 1000 + self.silent_ms
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.last.update((at, position, due))
        return iter([self._row(key, at, position, False)])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        old = self.last.get()
        if old is None:
            return iter(())
        at, position, _ = old
        self.last.clear()
        return iter([self._row(key, at, position, True)])

    def close(self) -> None:
        pass


def _last_of_batch(key: Sequence[str], most: int = 1 << 18):
    """The last (time, position) of each key of a task's Arrow batches, which are brought together up to ``most`` rows: a key sends its state a row or few a task."""

    def last_of(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by([("_at", "ascending"), ("_position", "ascending")])
        last = rows.group_by(list(key), use_threads=False).aggregate([(c, "last") for c in ("_time", "_at", "_position")])
        last = last.rename_columns([c.removesuffix("_last") if c not in key else c for c in last.column_names])
        return last.select(batches[0].schema.names).cast(batches[0].schema).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= most:
                    held = last_of(held)
                    if 2 * sum(b.num_rows for b in held) >= most:
                        yield from held
                        held = []
        if held:
            yield from last_of(held)

    return run


def positions_with_expiry(stream: DataFrame, key: Sequence[str], time: str, position: str, delay: str, silent_ms: int) -> DataFrame:
    """Changes of the last (time, position) of each key; a key silent for ``silent_ms`` of event time gives a last row with ``expired``.

    ``delay`` is how late rows may come (later ones are left out, as watermarks do); rows without a time or position are not
    positions and pass by. The state holds one row a key that has not fallen silent, so it is bounded by the active keys. A key that speaks again starts
    anew. Start it inside :func:`timer_store`, in update mode.
    """
    rows = stream.where(F.col(time).isNotNull() & F.col(position).isNotNull()).withColumn("_time", F.col(time).cast("timestamp")).select(
        *key, "_time", F.unix_micros("_time").alias("_at"), F.col(position).cast("bigint").alias("_position"))
    out = T.StructType([*[T.StructField(k, stream.schema[k].dataType) for k in key], T.StructField("at", T.LongType()),
                        T.StructField("position", T.LongType()), T.StructField("expired", T.BooleanType())])
    last = rows.mapInArrow(_last_of_batch(key), rows.schema)
    return last.withWatermark("_time", delay).groupBy(*key).transformWithState(Positions(key, silent_ms), out, "update", "eventTime")


def upsert_positions(changes: DataFrame, table: KeyedTable, checkpoint: str, name: str, key: Sequence[str], time: str, position: str, before_ack: Callable[[int], None] | None = None) -> None:
    """Keep the changes of :func:`positions_with_expiry` in a table, where expired keys are deleted, until everything that has landed is in.

    The state of a batch is stored when its rows have been worked out, so they are written once and then committed under the batch id. A batch
    that is in the table already is worked out again after a stop, for its state, and not committed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if table.has_batch(name, batch_id):
            batch.write.format("noop").mode("overwrite").save()
        else:
            rows = materialise(batch, "positions").select(*key, F.timestamp_micros("at").cast("timestamp_ntz").alias(time), F.col("position").alias(position), "expired")
            # a key may end and speak again in one batch: the end comes first
            table.commit(union_changes(deletes(rows.where("expired"), key, 1), upserts(rows.where("not expired").drop("expired"), 2)), batch=(name, batch_id))
        if before_ack:
            before_ack(batch_id)

    with timer_store(changes.sparkSession):
        query = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
