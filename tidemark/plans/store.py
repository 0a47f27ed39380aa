"""Keyed tables on Parquet whose data and resume point become visible together.

Layout below the table path::

    data/_version=<attempt>/_bucket=<b>/*.parquet    rows of one bucket as of one commit
    log/_version=<attempt>/_bucket=<b>/*.parquet     the folded changes of an attempt
    commits/<commit>.json    keys, number of buckets, which attempt holds each bucket, schema, state, batch id

A commit writes only the buckets its changes touch, below a folder name that no
other attempt has, and becomes visible when its JSON file is created; only one
writer can create it. Work that stops before, and the work of a writer that
comes second, leaves unread folders behind and can simply be run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import DELETED, SEQ, SYNCED, apply_folded, fold_changes, with_full_keys
from tidemark.operators.schema import cast_to, loses_as_double, merged_schema
from tidemark.session import broadcast_limit, conf_bytes, hadoop_path, path_bytes

BUCKET, PART = "_bucket", "_part"


# a task with few buckets writes them side by side instead of sorting its rows by bucket first
_WRITE_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.maxConcurrentOutputFileWriters": "4"}
# staged bytes of a task's part of the log up to which the join may hold it in memory
HASH_BYTES = 32 << 20
# stored bytes and rows of a bucket, the log's included, for which one more task works on it: narrow rows are stored in few
# bytes and take many more in memory, so bytes alone do not bound a task
TASK_BYTES, TASK_ROWS = 32 << 20, 500_000
# what a task of a grouping reads of stored files, where rows are grouped before the shuffle too, and of the shuffle: both hold many
# rows in few bytes. The shuffle starts with so many parts, of which the session joins small ones
GROUP_BYTES, GROUP_PARTS = 4 << 20, 2000
# a file is not divided within a row group, so its writer would decide how many rows a task groups or sorts for a shuffle. Rows of
# others are dealt out first, to so many parts that the dealing task streams them to files (Spark's limit for that) and holds none
DEAL_PARTS = 200
# row groups of stored files, for the tasks that read them again
ROW_GROUP_BYTES = 16 << 20
# memory for a stored byte of a log: files are compressed and encoded
IN_MEMORY = 10
# buckets of a table that names none: one for so many rows of its first write, and at least so many
BUCKET_ROWS, LEAST_BUCKETS = 10_000_000, 8
# order of the last write of a row, kept by callers that need it; not part of what read() gives
ORDER = "_order"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside; those before come back."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _bucket_writes(spark: SparkSession):
    """Let the join on (bucket, key) use sides that are partitioned by bucket alone, and write without a sort."""
    return _settings(spark, _WRITE_SETTINGS)


def small_groups(spark: SparkSession):
    """Bound what a task of a grouping holds, whatever the input: without this a task's share grows with it.

    The session's own settings stay where they are tighter.
    """
    sizes = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    initial = int(spark.conf.get(parts, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    return _settings(spark, {**{name: f"{min(GROUP_BYTES, conf_bytes(spark, name, default))}b" for name, default in sizes.items()}, parts: str(max(GROUP_PARTS, initial))})


def dealt(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows in parts of the session's advised size, which adaptive execution joins and divides; without it, as they are.

    Dealt by order and plain columns too, not by the key alone: a hot key of a log is in all parts, and each makes one row of it.
    """
    plain = (T.NumericType, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
    by = [f.name for f in rows.schema.fields if f.name in (*keys, SEQ) or isinstance(f.dataType, plain)]
    return rows.hint("rebalance", DEAL_PARTS, *[F.col(c) for c in by])


def order_literal(value) -> Column | None:
    """An observed order as a column again."""
    if isinstance(value, Row):
        return F.struct(*[(order_literal(v) if v is not None else F.lit(None)).alias(n) for n, v in value.asDict().items()])
    return None if value is None else F.lit(value)


def commit_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commit files of a table."""
    fs, folder = hadoop_path(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file if it is absent: of several writers one succeeds, for the others it is an error."""
    fs, target = hadoop_path(spark, path)
    taken = f"{path} was taken by another writer"
    if fs.exists(target):
        raise RuntimeError(taken)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        raise RuntimeError(taken) from error
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


class KeyedTable:
    """A destination table with a primary key.

    ``buckets`` sets the unit of rewriting and is stored with the table: an existing table keeps its number, whoever
    opens it; :meth:`rebucket` changes it. A large bucket is worked on by several tasks, so the number bounds what a small
    commit rewrites, not how many tasks run. A table that names no number gets one by the rows of its first write.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None = None):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        head = self.head()
        if head and head["keys"] != self.keys:
            raise ValueError(f"table {self.path} has the key {head['keys']}, not {self.keys}")
        if head and buckets is not None and buckets != head["bucket_count"]:
            raise ValueError(f"table {self.path} has {head['bucket_count']} buckets, not {buckets}; see rebucket()")
        self.buckets = head["bucket_count"] if head else buckets

    def _choose_buckets(self, rows: DataFrame) -> None:
        """Fix the number of buckets by the rows of the first write, if the caller has not."""
        if self.buckets is None:
            head = self.head()
            self.buckets = head["bucket_count"] if head else self._buckets_for(self._count(rows))

    def _count(self, rows: DataFrame) -> int:
        with small_groups(self.spark):
            return rows.count()

    @staticmethod
    def _buckets_for(count: int) -> int:
        return max(LEAST_BUCKETS, -(-count // BUCKET_ROWS))

    # -- commit files ------------------------------------------------------

    def head(self) -> dict | None:
        """The newest commit, or None for a table never written. A commit file that is still being written does not count."""
        for version in reversed(commit_versions(self.spark, self.path)):
            text = read_text(self.spark, f"{self.path}/commits/{version:010d}.json")
            if text.endswith("}"):
                return json.loads(text)
        return None

    def _publish(self, commit: dict) -> None:
        """Create the commit file if it is absent: of several writers of one version one succeeds."""
        commit = {"keys": self.keys, "bucket_count": self.buckets, **commit}
        create_once(self.spark, f"{self.path}/commits/{commit['version']:010d}.json", json.dumps(commit, sort_keys=True))

    # -- reading -----------------------------------------------------------

    def schema(self) -> T.StructType | None:
        head = self.head()
        return T.StructType.fromJson(head["schema"]) if head else None

    def state(self) -> dict:
        """The resume point stored with the newest commit; empty before the first."""
        head = self.head()
        return dict(head["state"]) if head else {}

    def has_batch(self, name: str, batch_id: int) -> bool:
        """Whether a batch of a stream is in."""
        head = self.head()
        return bool(head) and head["batch_ids"].get(name, -1) >= batch_id

    def _stored_at(self, head: dict, bucket: str) -> str:
        return f"{self.path}/data/_version={head['buckets'][bucket]}/{BUCKET}={bucket}"

    def _read(self, head: dict, buckets: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(head["schema"])
        paths = [self._stored_at(head, b) for b in buckets if b in head["buckets"]]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]))
        return (self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]))
                .option("basePath", f"{self.path}/data").parquet(*paths).drop("_version"))

    def read(self, with_order: bool = False) -> DataFrame:
        """All rows, with the deleted flag."""
        head = self.head()
        if head is None:
            raise ValueError(f"table {self.path} has no commit")
        rows = self._read(head, sorted(head["buckets"])).drop(BUCKET)
        return rows if with_order else rows.drop(ORDER)

    def matching(self, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Keys and ``columns`` of the stored rows whose key stands in a small frame: only its buckets are read, and the frame, not the table, may be broadcast."""
        head = self.head()
        if head is None:
            raise ValueError(f"table {self.path} has no commit")
        wanted = keys.select(*self.keys).distinct()
        buckets = [str(r[BUCKET]) for r in self._bucketed(wanted).select(BUCKET).distinct().collect()]  # at most one row a bucket
        return self._read(head, sorted(buckets)).select(*self.keys, *columns).join(wanted, self.keys)

    def active(self) -> DataFrame:
        return self.read().filter(~F.col(DELETED)).drop(DELETED)

    # -- writing -----------------------------------------------------------

    def _bucketed(self, df: DataFrame) -> DataFrame:
        # text form of the key: the same bucket for 1 as int and as bigint
        code = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets))
        return df.withColumn(BUCKET, code.cast("int"))

    def _write(self, df: DataFrame, kind: str, attempt: str, shuffled: bool = True) -> str:
        """Write rows by bucket. Where a shuffle places them, they are read in small pieces; else these would make small files."""
        target = f"{self.path}/{kind}/_version={attempt}"
        with _bucket_writes(self.spark), small_groups(self.spark) if shuffled else nullcontext():
            df.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(BUCKET).parquet(target)
        return target

    @staticmethod
    def _attempt(version: int) -> str:
        return f"v{version}-{uuid.uuid4().hex}"

    def _largest(self, folders: Sequence[str]) -> int:
        """Bytes of the largest of some bucket folders."""
        return max([0, *(path_bytes(self.spark, f) for f in folders)])

    def _spread(self, df: DataFrame, buckets: int, splits: int, tasks: int = 0) -> DataFrame:
        """Partitioned by bucket and, within a bucket, by key: ``splits`` tasks share a bucket.

        No more tasks than ``tasks`` and than the session shuffles with: parts of small tables share a task.
        """
        tasks = max(tasks, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        part = F.col(BUCKET) * splits + F.pmod(F.hash(*[F.col(k).cast("string") for k in self.keys]), F.lit(splits))
        return df.withColumn(PART, part).repartition(max(1, min(tasks, 2 * buckets * splits)), PART)

    def _shares(self, sides: Sequence[DataFrame], folders: Sequence[Sequence[str]]) -> tuple[int, int]:
        """(tasks that share the largest bucket, tasks for all of them) by the rows and the stored bytes of some frames; ``folders`` are those of each bucket."""
        marks = reduce(DataFrame.unionAll, [side.select(BUCKET) for side in sides])
        rows = [r["count"] for r in marks.groupBy(BUCKET).count().collect()] or [0]  # counts from footers; one row a bucket
        sizes = [sum(path_bytes(self.spark, f) for f in of_bucket) for of_bucket in folders] or [0]
        splits = max(1, -(-max(sizes) // TASK_BYTES), -(-max(rows) // TASK_ROWS))
        return splits, 2 * max(-(-sum(sizes) // TASK_BYTES), -(-sum(rows) // TASK_ROWS))

    def _written(self, folder: str) -> list[str]:
        """Bucket folders of one commit: at most ``buckets`` names."""
        fs, target = hadoop_path(self.spark, folder)
        if not fs.exists(target):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(target)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{BUCKET}="))

    def load(self, df: DataFrame, state: dict | None = None, run_time: Column | None = None) -> int:
        """First load: every row active."""
        if self.head() is not None:
            raise ValueError(f"table {self.path} already has commits")
        rows = with_full_keys(df, self.keys)
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        if run_time is not None:
            rows = rows.withColumn(SYNCED, run_time)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        attempt = self._attempt(1)
        count = self._count(df)
        if self.buckets is None:
            self.buckets = self._buckets_for(count)
        # as many tasks as the session shuffles with, more for many rows; each writes few buckets
        by_rows = -(-count // TASK_ROWS)
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), by_rows)
        with small_groups(self.spark):
            if 2 * by_rows > DEAL_PARTS:
                rows = dealt(rows, self.keys)
            spread = self._spread(self._bucketed(rows), self.buckets, max(1, -(-tasks // self.buckets)), 2 * max(self.buckets, by_rows)).drop(PART)
            folder = self._write(spread, "data", attempt)
        head = {"version": 1, "buckets": {b: attempt for b in self._written(folder)}, "schema": schema.jsonValue(), "state": state or {}, "batch_ids": {}}
        with small_groups(self.spark):
            twice = self._read(head, sorted(head["buckets"])).groupBy(*self.keys).count().where("count > 1").select(*self.keys).first()
        if twice is not None:
            raise ValueError(f"key {tuple(twice)} occurs more than once")
        self._publish(head)
        return 1

    def rebucket(self, buckets: int) -> int:
        """Write all rows over another number of buckets, as a commit of its own."""
        head = self.head()
        if head is None:
            raise ValueError(f"table {self.path} has no commit")
        stored = self._read(head, sorted(head["buckets"]))
        rows = stored.drop(BUCKET)
        count, size = stored.count(), sum(path_bytes(self.spark, self._stored_at(head, b)) for b in head["buckets"])
        tasks = max(-(-count // TASK_ROWS), -(-size // TASK_BYTES))
        before, self.buckets = self.buckets, buckets
        try:
            version = head["version"] + 1
            attempt = self._attempt(version)
            folder = self._write(self._spread(self._bucketed(rows), buckets, max(1, -(-tasks // buckets)), 2 * max(buckets, tasks)).drop(PART), "data", attempt)
            self._publish({**head, "version": version, "bucket_count": buckets, "buckets": {b: attempt for b in self._written(folder)}})
        except BaseException:
            self.buckets = before
            raise
        return version

    def _check_keys(self, stored: T.StructType, schema: T.StructType) -> None:
        whole = (T.ShortType, T.IntegerType, T.LongType)
        for k in self.keys:
            old = stored[k].dataType if k in stored.fieldNames() else schema[k].dataType
            new = schema[k].dataType
            if old != new and not (isinstance(old, whole) and isinstance(new, whole)):
                raise ValueError(f"key column {k} changes from {old.simpleString()} to {new.simpleString()}")

    def _log_size(self, log_path: str, touched: Sequence[str], splits: int) -> str:
        """How the staged log may take part in the join, by the measured size of all of it or of its largest bucket."""
        if IN_MEMORY * path_bytes(self.spark, log_path) <= broadcast_limit(self.spark):
            return "broadcast"
        largest = self._largest([f"{log_path}/{BUCKET}={b}" for b in touched])
        return "hash" if IN_MEMORY * largest / splits <= HASH_BYTES else "unknown"

    def _applied(self, base: DataFrame | None, folded: DataFrame, cut, run_time, touched: int, splits: int, log_size: str, tasks: int = 0) -> DataFrame:
        """The touched buckets after the log; a bucket's rows are shared by ``splits`` tasks unless the log is broadcast."""
        cut = order_literal(cut)
        keys = [BUCKET, *self.keys]
        if base is not None and log_size != "broadcast":
            base, folded = (self._spread(side, touched, splits, tasks) for side in (base, folded))
            keys = [PART, *keys]
        return apply_folded(base, folded, keys, cut, run_time, log_size)

    def _without_loss(self, schema: T.StructType, stored: T.StructType, incoming: T.StructType, head: dict, staged: DataFrame) -> T.StructType:
        """Whole and decimal numbers that widen to double meet at text instead, if any of their values would lose digits."""
        exact = (T.LongType, T.DecimalType)
        lost = set()
        for names, kinds, rows, at in ((stored.fieldNames(), stored, lambda: self._read(head, sorted(head["buckets"])), "{}"),
                                       (incoming.fieldNames(), incoming, lambda: staged, "_x_{}.v")):
            risky = [n for n in names if n not in self.keys and isinstance(schema[n].dataType, T.DoubleType) and isinstance(kinds[n].dataType, exact)]
            if risky:
                found = rows().agg(*[F.max(loses_as_double(F.col(at.format(n)), kinds[n].dataType)).alias(n) for n in risky]).first()
                lost |= {n for n in risky if found[n]}
        return T.StructType([T.StructField(f.name, T.StringType() if f.name in lost else f.dataType, True) for f in schema.fields])

    def commit(self, changes: DataFrame, state: dict | None = None, batch: tuple[str, int] | None = None,
               run_time: Column | None = None, before_publish=None) -> int:
        """Apply a change log and store the state with it; returns the version.

        ``batch`` = (stream name, batch id): a batch that is already in is skipped.
        """
        head = self.head() or {"version": 0, "buckets": {}, "schema": None, "state": {}, "batch_ids": {}}
        if batch and head["batch_ids"].get(batch[0], -1) >= batch[1]:
            return head["version"]
        version = head["version"] + 1
        self._choose_buckets(changes)
        seen = Observation()
        attempt = self._attempt(version)
        with small_groups(self.spark):
            log = fold_changes(dealt(changes, self.keys), self.keys, truncates=True)
            log_path = self._write(self._bucketed(log.observe(seen, F.max("_last_t").alias("cut"))).repartition(BUCKET), "log", attempt)
        touched = logged = self._written(log_path)
        # measured by the write itself, so the changes are not read again; a log without rows is measured by nobody
        cut = seen.get["cut"] if touched else None
        log_schema = T.StructType([*log.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        staged = self.spark.read.schema(log_schema).parquet(log_path)
        folded = staged.filter(F.col("_last_t").isNull()).drop("_last_t")

        stored = T.StructType.fromJson(head["schema"]) if head["schema"] else T.StructType([])
        incoming = T.StructType([changes.schema[k] for k in self.keys]
                                + [T.StructField(f.name[3:], f.dataType["v"].dataType, True)
                                   for f in log.schema.fields if f.name.startswith("_x_")])
        schema, widened = merged_schema(stored, incoming)
        schema = self._without_loss(schema, stored, incoming, head, staged)
        self._check_keys(stored, schema)
        extra = [T.StructField(DELETED, T.BooleanType())] + ([T.StructField(SYNCED, T.TimestampNTZType())]
                                                            if run_time is not None else [])
        schema = T.StructType([*schema.fields, *[f for f in extra if f.name not in schema.fieldNames()]])
        if cut is not None or widened:
            touched = sorted(set(touched) | set(head["buckets"]))
        buckets = dict(head["buckets"])
        if touched:
            base = cast_to(self._read(head, touched), schema) if head["buckets"] else None
            folded = folded.select(*[F.col(f.name).cast(schema[f.name].dataType).alias(f.name)
                                     if f.name in self.keys else
                                     F.col(f.name).cast(T.StructType([T.StructField("s", f.dataType["s"].dataType),
                                                                      T.StructField("v", schema[f.name[3:]].dataType)]))
                                     .alias(f.name) if f.name.startswith("_x_") else F.col(f.name)
                                     for f in log_schema.fields if f.name != "_last_t"])
            splits, tasks, log_size = 1, 0, self._log_size(log_path, logged, 1)
            shuffled = base is not None and log_size != "broadcast"
            if shuffled:
                stored_at = [[*([f"{log_path}/{BUCKET}={b}"] if b in logged else []), *([self._stored_at(head, b)] if b in head["buckets"] else [])] for b in touched]
                splits, tasks = self._shares([base, staged], stored_at)
                log_size = self._log_size(log_path, logged, splits)
            rows = self._applied(base, folded, cut, run_time, len(touched), splits, log_size, tasks)
            folder = self._write(rows.select(*schema.fieldNames(), BUCKET), "data", attempt, shuffled)
            buckets.update({b: attempt for b in self._written(folder)})
        if before_publish:
            before_publish()
        batch_ids = dict(head["batch_ids"])
        if batch:
            batch_ids[batch[0]] = batch[1]
        self._publish({"version": version, "buckets": buckets, "schema": schema.jsonValue(),
                       "state": {**head["state"], **(state or {})}, "batch_ids": batch_ids})
        return version
