"""Keyed tables that are merged when read: a commit writes its own changes and nothing else.

Layout below the table path::

    base/_attempt=<a>/_bucket=<b>/*.parquet     whole rows of a bucket up to some version
    delta/_attempt=<a>/*.parquet                the changes of one commit, one row per key, sorted by bucket and key, in as few files as they fill
    commits/<version>.json    schema, state, batch ids; the base of each bucket; the deltas since, and the last truncate

* ``commit`` folds a change log and writes it as a delta. Widened types and new columns stand in the commit only: rows are cast
  when they are read. A truncate is a mark in the commit, with no data of its own.
* ``read`` folds the deltas of a key and joins them with its base row; small deltas are broadcast, so the base is not shuffled.
* ``compact`` folds deltas into the base of the buckets where they have grown, as a commit of its own.
* ``clean`` removes what no kept commit names: old bases and deltas, and what stopped writers left.

An operation's place is one number, 4 x version + step, so that logs with orders of different types meet on read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import DELETED, OP, apply_folded, fold_changes, sequence
from tidemark.operators.schema import cast_to, loses_as_double, merged_schema
from tidemark.plans.store import BUCKET, BUCKET_ROWS, IN_MEMORY, LEAST_BUCKETS, TASK_BYTES, commit_versions, create_once, dealt, order_literal, read_text, small_groups
from tidemark.session import broadcast_limit, hadoop_path, path_bytes

# steps inside a version: a truncate, values older than the row's first upsert, upserts, deletes
CUT, EARLY, WRITE, DELETE = 0, 1, 2, 3
STEPS = 4
_BUCKET_FIELD = T.StructField(BUCKET, T.IntegerType())


class MergeTable:
    """A destination table with a primary key whose commits cost what they change.

    The rules for upserts, partial updates, deletes, truncates, widening and batch ids are those of ``KeyedTable``. ``buckets`` is the unit of
    compaction and is stored with the table; without a number it follows the rows of the first commit.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None = None):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        head = self.head()
        if head and head["keys"] != self.keys:
            raise ValueError(f"table {self.path} has the key {head['keys']}, not {self.keys}")
        if head and buckets is not None and buckets != head["bucket_count"]:
            raise ValueError(f"table {self.path} has {head['bucket_count']} buckets, not {buckets}")
        self.buckets = head["bucket_count"] if head else buckets

    # -- commit files ------------------------------------------------------

    def _commit(self, version: int) -> dict | None:
        text = read_text(self.spark, f"{self.path}/commits/{version:010d}.json")
        return json.loads(text) if text.endswith("}") else None  # a file that is still being written does not count

    def head(self) -> dict | None:
        """The newest commit, or None for a table never written."""
        for version in reversed(commit_versions(self.spark, self.path)):
            commit = self._commit(version)
            if commit:
                return commit
        return None

    def state(self) -> dict:
        """The resume point stored with the newest commit; empty before the first."""
        head = self.head()
        return dict(head["state"]) if head else {}

    def schema(self) -> T.StructType | None:
        head = self.head()
        return T.StructType.fromJson(head["schema"]) if head else None

    def _publish(self, commit: dict) -> int:
        commit = {**commit, "keys": self.keys, "bucket_count": self.buckets}
        create_once(self.spark, f"{self.path}/commits/{commit['version']:010d}.json", json.dumps(commit, sort_keys=True))
        return commit["version"]

    # -- files -------------------------------------------------------------

    def _bucketed(self, df: DataFrame) -> DataFrame:
        code = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets))
        return df.withColumn(BUCKET, code.cast("int"))

    def _part(self, parts: int) -> Column:
        """A bucket's share by key: its rows may lie in several tasks, so no bucket bounds the work."""
        return F.col(BUCKET) * parts + F.pmod(F.hash(*[F.col(k).cast("string") for k in self.keys]), F.lit(parts))

    def _write_base(self, rows: DataFrame, tasks: int) -> tuple[str, dict[str, int]]:
        """Write rows by bucket in a folder of their own; its name and the bytes of each bucket."""
        attempt, parts = uuid.uuid4().hex, max(1, -(-tasks // self.buckets))
        spread = rows.withColumn("_part", self._part(parts)).repartition(max(1, min(tasks, self.buckets * parts)), "_part").drop("_part")
        target = f"{self.path}/base/_attempt={attempt}"
        spread.sortWithinPartitions(BUCKET, *self.keys).write.partitionBy(BUCKET).parquet(target)
        fs, folder = hadoop_path(self.spark, target)
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return attempt, {n.split("=", 1)[1]: path_bytes(self.spark, f"{target}/{n}") for n in names if n.startswith(f"{BUCKET}=")}

    def _write_delta(self, placed: DataFrame) -> tuple[str, dict[str, int]]:
        """Write changes in a folder of their own; its name and the rows of each bucket. AQE makes few files of few rows."""
        attempt = uuid.uuid4().hex
        rows = self._bucketed(placed)
        target = f"{self.path}/delta/_attempt={attempt}"
        rows.withColumn("_part", self._part(8)).repartition("_part").drop("_part").sortWithinPartitions(BUCKET, *self.keys).write.parquet(target)
        counts = self.spark.read.schema(rows.schema).parquet(target).groupBy(BUCKET).count().collect()  # one row a bucket
        if not counts:
            fs, folder = hadoop_path(self.spark, target)
            fs.delete(folder, True)
        return attempt, {str(r[BUCKET]): r["count"] for r in counts}

    def _files(self, schema: dict, attempts: Sequence[str]) -> DataFrame:
        read = T.StructType([*T.StructType.fromJson(schema).fields, _BUCKET_FIELD])
        return self.spark.read.schema(read).parquet(*[f"{self.path}/delta/_attempt={a}" for a in attempts])

    # -- reading -----------------------------------------------------------

    def _base(self, head: dict, buckets: Sequence[str], schema: T.StructType) -> DataFrame | None:
        """Base rows under the table's present schema; files of different schemas are cast apart."""
        groups: dict[str, list[tuple[str, str]]] = {}
        for b in buckets:
            if b in head["base"]:
                groups.setdefault(json.dumps(head["base"][b]["schema"], sort_keys=True), []).append((head["base"][b]["attempt"], b))
        frames = []
        for text, folders in groups.items():
            read = T.StructType([*T.StructType.fromJson(json.loads(text)).fields, _BUCKET_FIELD])
            rows = self.spark.read.schema(read).option("basePath", f"{self.path}/base").parquet(*[f"{self.path}/base/_attempt={a}/{BUCKET}={b}" for a, b in folders])
            frames.append(cast_to(rows, schema).select(*schema.fieldNames(), BUCKET))
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _delta(self, head: dict, buckets: Sequence[str], schema: T.StructType) -> tuple[DataFrame | None, int]:
        """Changes not yet in the base as one row per key, and their stored bytes."""
        groups: dict[tuple[str, tuple[str, ...] | None], list[str]] = {}
        size, seen = 0, []
        for d in head["deltas"]:
            waiting = [b for b in buckets if b in d["rows"] and d["version"] > head["base"].get(b, {"upto": 0})["upto"]]
            if waiting:
                part = None if len(waiting) == len(d["rows"]) else tuple(waiting)
                groups.setdefault((json.dumps(d["schema"], sort_keys=True), part), []).append(d["attempt"])
                size += d["bytes"] * sum(d["rows"][b] for b in waiting) // sum(d["rows"].values())
                seen += waiting
        values = [f for f in schema.fields if f.name not in self.keys and f.name != DELETED]
        one = lambda f: T.StructType([T.StructField("s", T.LongType()), T.StructField("v", f.dataType)])
        frames = []
        for (text, part), attempts in groups.items():
            rows = self._files(json.loads(text), attempts)
            rows = rows if part is None else rows.where(F.col(BUCKET).isin([int(b) for b in part]))
            frames.append(rows.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in self.keys], BUCKET, "_first_i", "_last_i", "_last_d", *[
                (F.col(f"_x_{f.name}") if f"_x_{f.name}" in rows.columns else F.lit(None)).cast(one(f)).alias(f"_x_{f.name}") for f in values]))
        if not frames:
            return None, 0
        both = reduce(DataFrame.unionByName, frames)
        if len(seen) == len(set(seen)):
            return both, size  # one delta a bucket: a key stands in it once
        return both.groupBy(BUCKET, *self.keys).agg(
            F.min("_first_i").alias("_first_i"), F.max("_last_i").alias("_last_i"), F.max("_last_d").alias("_last_d"),
            *[F.max(f"_x_{f.name}").alias(f"_x_{f.name}") for f in values]), size

    def _rows(self, head: dict, buckets: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(head["schema"])
        base = self._base(head, buckets, schema)
        delta, size = self._delta(head, buckets, schema)
        # a truncate counts for the buckets whose base is older
        stale = [b for b in buckets if head["cut"] and b in head["base"] and head["base"][b]["upto"] < head["cut"]]
        cut = None
        if head["cut"]:
            place = F.lit(STEPS * head["cut"] + CUT).cast("bigint")
            # a bucket without a base has no older rows but those of deltas, and these compare by place
            young = [int(b) for b in buckets if b in head["base"] and b not in stale]
            cut = F.when(F.col(BUCKET).isin(young), F.lit(None).cast("bigint")).otherwise(place) if young else place
        if delta is None:
            if base is None:
                return self.spark.createDataFrame([], T.StructType([*schema.fields, _BUCKET_FIELD]))
            return base if cut is None else base.withColumn(DELETED, F.col(DELETED) | cut.isNotNull())
        fits = IN_MEMORY * size <= broadcast_limit(self.spark)
        rows = apply_folded(base, delta, [BUCKET, *self.keys], cut, log_size="broadcast" if fits else "unknown")
        return rows.select(*schema.fieldNames(), BUCKET)

    def _all_buckets(self, head: dict) -> list[str]:
        return sorted({*head["base"], *(b for d in head["deltas"] for b in d["rows"])}, key=int)

    def read(self) -> DataFrame:
        """All rows, with the deleted flag."""
        head = self.head()
        if head is None:
            raise ValueError(f"table {self.path} has no commit")
        return self._rows(head, self._all_buckets(head)).drop(BUCKET)

    def active(self) -> DataFrame:
        return self.read().filter(~F.col(DELETED)).drop(DELETED)

    # -- writing -----------------------------------------------------------

    @staticmethod
    def _placed(log: DataFrame, version: int, cut: Column | None) -> DataFrame:
        """A folded log with places of this version instead of its own order; ``cut`` is the last truncate in that order."""
        at = lambda step: F.lit(STEPS * version + step).cast("bigint")
        last = F.col("_last_i")
        out = [c for c in log.columns if c not in ("_first_i", "_last_i", "_last_d") and not c.startswith("_x_")]
        flagged = F.col("_last_d") if cut is None else F.greatest("_last_d", cut)
        values = [F.when(F.col(c).isNotNull(), F.struct(F.when(F.col(c)["s"] < F.col("_first_i"), at(EARLY)).otherwise(at(WRITE)).alias("s"),
                                                        F.col(c)["v"].alias("v"))).alias(c) for c in log.columns if c.startswith("_x_")]
        return log.select(*out, F.when(F.col("_first_i").isNotNull(), at(WRITE)).alias("_first_i"),
                          F.when(last.isNotNull(), at(WRITE)).alias("_last_i"),
                          F.when(F.when(last.isNotNull(), flagged > last).otherwise(F.col("_last_d").isNotNull()), at(DELETE)).alias("_last_d"), *values)

    def _settled(self, head: dict, schema: T.StructType, stored: T.StructType, incoming: T.StructType, log: DataFrame) -> T.StructType:
        """Whole and decimal numbers that widen to double meet at text instead, if any of their values would lose digits."""
        exact, lost = (T.LongType, T.DecimalType), set()
        for kinds, rows, at in ((stored, lambda: self._rows(head, self._all_buckets(head)), "{}"), (incoming, lambda: log, "_x_{}.v")):
            risky = [n for n in kinds.fieldNames() if n not in self.keys and isinstance(schema[n].dataType, T.DoubleType) and isinstance(kinds[n].dataType, exact)]
            if risky:
                found = rows().agg(*[F.max(loses_as_double(F.col(at.format(n)), kinds[n].dataType)).alias(n) for n in risky]).first()
                lost |= {n for n in risky if found[n]}
        return T.StructType([T.StructField(f.name, T.StringType() if f.name in lost else f.dataType, True) for f in schema.fields])

    def _check_keys(self, stored: T.StructType, incoming: T.StructType) -> None:
        whole = (T.ShortType, T.IntegerType, T.LongType)
        for k in self.keys:
            old, new = (stored[k] if k in stored.fieldNames() else incoming[k]).dataType, incoming[k].dataType
            if old != new and not (isinstance(old, whole) and isinstance(new, whole)):
                raise ValueError(f"key column {k} changes from {old.simpleString()} to {new.simpleString()}")

    def commit(self, changes: DataFrame, state: dict | None = None, batch: tuple[str, int] | None = None, before_publish: Callable[[], None] | None = None) -> int:
        """Add a change log and store the state with it; returns the version. ``batch`` = (stream name, batch id): a batch that is in is skipped."""
        head = self.head() or {"version": 0, "schema": {"type": "struct", "fields": []}, "state": {}, "batch_ids": {}, "base": {}, "deltas": [], "cut": 0}
        if batch and head["batch_ids"].get(batch[0], -1) >= batch[1]:
            return head["version"]
        version = head["version"] + 1
        if self.buckets is None:
            self.buckets = max(LEAST_BUCKETS, -(-changes.count() // BUCKET_ROWS))
        log = fold_changes(dealt(changes, self.keys), self.keys)
        # logs built by this package name their operation in the plan: without truncates none of their rows is read for this
        cut = order_literal(changes.where(F.col(OP) == "T").agg(F.max(sequence(changes)).alias("cut")).first()["cut"])
        placed = self._placed(log, version, cut)
        with small_groups(self.spark):
            attempt, rows = self._write_delta(placed)
        delta = placed.schema.jsonValue()
        stored = T.StructType.fromJson(head["schema"])
        incoming = T.StructType([changes.schema[k] for k in self.keys]
                                + [T.StructField(f.name[3:], f.dataType["v"].dataType, True) for f in placed.schema.fields if f.name.startswith("_x_")])
        self._check_keys(stored, incoming)
        schema, _ = merged_schema(stored, incoming)
        if head["version"]:
            schema = self._settled(head, schema, stored, incoming, self._files(delta, [attempt]) if rows else placed.limit(0))
        if DELETED not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType(), True)])
        if before_publish:
            before_publish()
        deltas = [*head["deltas"], *([{"version": version, "attempt": attempt, "schema": delta, "rows": rows, "bytes": path_bytes(self.spark, f"{self.path}/delta/_attempt={attempt}")}] if rows else [])]
        batch_ids = {**head["batch_ids"], **({batch[0]: batch[1]} if batch else {})}
        return self._publish({**head, "version": version, "schema": schema.jsonValue(), "state": {**head["state"], **(state or {})},
                              "batch_ids": batch_ids, "deltas": deltas, "cut": head["cut"] if cut is None else version})

    def compact(self, share: float = 0.0, before_publish: Callable[[], None] | None = None) -> int:
        """Fold deltas into the base of the buckets where they hold more than ``share`` of the base's bytes; returns the version.

        A stop leaves the table as it was. A commit that comes between makes this one fail; run it again.
        """
        head = self.head()
        if head is None:
            raise ValueError(f"table {self.path} has no commit")
        due, total = [], 0
        for b in self._all_buckets(head):
            base = head["base"].get(b, {"upto": 0, "bytes": 0})
            pending = sum(d["bytes"] * d["rows"].get(b, 0) // sum(d["rows"].values()) for d in head["deltas"] if d["version"] > base["upto"])
            if pending > share * base["bytes"] or base["upto"] < head["cut"]:
                due.append(b)
                total += pending + base["bytes"]
        if not due:
            return head["version"]
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 2 * -(-total // TASK_BYTES))
        attempt, sizes = self._write_base(self._rows(head, due), tasks)
        base = {b: v for b, v in head["base"].items() if b not in due}
        base |= {b: {"attempt": attempt, "upto": head["version"], "bytes": sizes[b], "schema": head["schema"]} for b in sizes}
        upto = {b: v["upto"] for b, v in base.items()}
        left = [d for d in head["deltas"] if any(d["version"] > upto.get(b, 0) for b in d["rows"])]
        if before_publish:
            before_publish()
        return self._publish({**head, "version": head["version"] + 1, "base": base, "deltas": left})

    def clean(self, keep: int = 1, older_than_s: float = 24 * 3600.0) -> int:
        """Delete commit files before the last ``keep``, and folders that none of those names; returns the number of deleted paths.

        Folders younger than ``older_than_s`` stay: a writer may still be at work in them, or a reader in what was current then.
        """
        versions = commit_versions(self.spark, self.path)
        kept = [c for c in (self._commit(v) for v in versions[-max(1, keep):]) if c]
        if not kept:
            return 0
        named = {"base": {v["attempt"] for c in kept for v in c["base"].values()}, "delta": {d["attempt"] for c in kept for d in c["deltas"]}}
        before, gone = int((time.time() - older_than_s) * 1000), 0
        for v in versions[:-max(1, keep)]:
            fs, target = hadoop_path(self.spark, f"{self.path}/commits/{v:010d}.json")
            if fs.getFileStatus(target).getModificationTime() < before:
                gone += bool(fs.delete(target, False))
        for kind, attempts in named.items():
            fs, folder = hadoop_path(self.spark, f"{self.path}/{kind}")
            for status in fs.listStatus(folder) if fs.exists(folder) else ():
                if status.getPath().getName().split("=", 1)[1] not in attempts and status.getModificationTime() < before:
                    gone += bool(fs.delete(status.getPath(), True))
        return gone
