"""Choosing the new rows: cursor predicates, windows, marks, capped pulls."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.windows import first_rows, split_at


def newer(c: Column, mark, inclusive: bool = False) -> Column:
    """Newer than the mark; no mark means all rows."""
    if mark is None:
        return F.lit(True)
    return c >= F.lit(mark) if inclusive else c > F.lit(mark)


def newer_with_overlap(c: Column, mark: datetime | None, back: timedelta) -> Column:
    """Newer than the mark minus an overlap; the first run has no mark and takes everything."""
    return F.lit(True) if mark is None else c > F.lit(mark - back)


def after_position(columns: Sequence[str], mark: Sequence | None) -> Column:
    """Beyond a composite mark, spelled out so that scans can use it."""
    if mark is None:
        return F.lit(True)
    out, same = F.lit(False), F.lit(True)
    for name, value in zip(columns, mark, strict=True):
        out = out | (same & (F.col(name) > F.lit(value)))
        same = same & (F.col(name) == F.lit(value))
    # the first column alone bounds the scan
    return (F.col(columns[0]) >= F.lit(mark[0])) & out


def id_steps(df: DataFrame, key: str, start: int, step: int) -> DataFrame:
    """Rows with the number of their id range; read to the maximum, gaps do not end the load."""
    return df.filter(F.col(key) >= start).withColumn("step", F.floor((F.col(key) - start) / step))


def after_offset(df: DataFrame, order: Sequence[str], offset: int) -> DataFrame:
    """Rows beyond a row offset in a total order."""
    return split_at(df, order, offset)[1]


def time_windows(start: datetime, end: datetime, span: timedelta) -> list[tuple[datetime, datetime]]:
    """Consecutive (after, up to) windows of at most ``span``; one entry per batch of the run."""
    out, at = [], start
    while at < end:
        out.append((at, min(at + span, end)))
        at = out[-1][1]
    return out


def window_number(c: Column, start: datetime, span: timedelta) -> Column:
    """Number of the (after, up to] window of a time, for reading all windows in one pass."""
    micros = int(span.total_seconds() * 1_000_000)
    past = F.unix_micros(c.cast("timestamp")) - F.unix_micros(F.lit(start).cast("timestamp_ntz").cast("timestamp"))
    return F.floor((past - 1) / micros)


def in_window(c: Column, after, up_to) -> Column:
    return (c > F.lit(after)) & (c <= F.lit(up_to))


def bootstrap_or_update(state: dict, sequence: str, time: str, back: timedelta) -> Column:
    """First load by sequence number, later runs by update time with an overlap."""
    if state.get("mode", "bootstrap") == "bootstrap":
        return newer(F.col(sequence), state.get("sequence"))
    return newer_with_overlap(F.col(time), state["mark"], back)


def backfill_steps(now: datetime, limit: datetime, step: timedelta, steps: int, state: dict | None = None
                   ) -> tuple[list[tuple[datetime, datetime]], dict]:
    """Windows of one run and the next state: newest first, then back in steps to a limit.

    The forward window runs from the forward mark to now (one step back on the first run); the rest of the steps
    walk back from the backward mark.
    """
    state = state or {}
    forward, backward = state.get("forward"), state.get("backward")
    windows = [(forward or max(limit, now - step), now)]
    at = backward or windows[0][0]
    for _ in range(steps - 1):
        if at <= limit:
            break
        windows.append((max(limit, at - step), at))
        at = windows[-1][0]
    return windows, {"forward": now, "backward": at}


def table_marks(spark: SparkSession, wanted: Sequence[str], state: dict, initial) -> DataFrame:
    """Mark per wanted table: the last one, or the initial one for tables not seen before (driver-sized rows)."""
    known = state.get("tables", {})
    return spark.createDataFrame([(n, known.get(n, initial), n not in known) for n in wanted],
                                 "table_name string, mark timestamp_ntz, is_new boolean")


def coarse_date(df: DataFrame, date: str, key: str, mark, taken: DataFrame) -> DataFrame:
    """After the mark date everything, at it only the ids not taken yet; the ids are a table."""
    candidates = df.filter(F.col(date) >= F.lit(mark))
    at_mark = taken.select(F.col(key), F.lit(mark).cast(df.schema[date].dataType).alias(date))
    return candidates.join(at_mark, [key, date], "left_anti")


def client_filter(df: DataFrame, time: str, mark, missing: str = "keep") -> DataFrame:
    """Rows newer than the mark; rows without a time are kept or dropped."""
    if missing not in ("keep", "drop"):
        raise ValueError("missing must be keep or drop")
    test = newer(F.col(time), mark)
    return df.filter(F.col(time).isNull() | test if missing == "keep" else F.col(time).isNotNull() & test)


def client_filter_counts(df: DataFrame, time: str, mark, missing: str = "keep") -> DataFrame:
    """One row: rows synced and skipped by :func:`client_filter`."""
    test = F.coalesce(newer(F.col(time), mark), F.lit(missing == "keep"))
    return df.agg(F.count_if(test).alias("synced"), F.count_if(~test).alias("skipped"))


def capped(df: DataFrame, order: Sequence[str], mark: Sequence | None, cap: int, heap: bool = False) -> DataFrame:
    """At most ``cap`` rows beyond a composite mark, in order; the cap is the budget of the run, ``heap`` as in first_rows."""
    return first_rows(df.filter(after_position(order, mark)), order, cap, heap)


def position_of(df: DataFrame, order: Sequence[str], previous: Sequence | None = None) -> list | None:
    """Composite mark after a batch: that of its last row, or the previous one for an empty batch."""
    row = df.agg(F.max(F.struct(*order)).alias("m")).first()["m"]
    return list(row) if row is not None else previous


def lagged_window(c: Column, run_at: datetime, first_run: bool, lag: timedelta, first_back: timedelta, back: timedelta) -> Column:
    """From a fixed time back up to a lag before the run."""
    start = run_at - (first_back if first_run else back)
    return (c >= F.lit(start)) & (c < F.lit(run_at - lag))


# Column names preferred as replication key, best first.
PREFERRED_CURSORS = ["updated_at", "last_updated", "last_update", "last_modified", "modified_at", "modified_on",
                     "updated_on", "update_time", "updated"]
TIME_TYPES = ["timestamp", "timestamp_ntz", "date"]


def infer_cursor(catalogue: DataFrame, preferred: Sequence[str] = PREFERRED_CURSORS) -> DataFrame:
    """(table, cursor, strategy) from catalogue rows: preferred names, else the first date or time column,
    else the primary key, else a full load."""
    ranks = F.array_position(F.array(*map(F.lit, preferred)), F.lower("column_name"))
    is_time = F.col("data_type").isin(*TIME_TYPES)
    rank = (F.when(is_time & (ranks > 0), F.struct(F.lit(0).alias("c"), ranks.cast("bigint").alias("r")))
            .when(is_time, F.struct(F.lit(1).alias("c"), F.col("ordinal").cast("bigint").alias("r")))
            .when(F.col("is_key") == 1, F.struct(F.lit(2).alias("c"), F.col("ordinal").cast("bigint").alias("r"))))
    return (catalogue.groupBy("table_name")
            .agg(F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.col("column_name").alias("n")))).alias("_best"))
            .select("table_name", F.col("_best.n").alias("replication_key"),
                    F.when(F.col("_best").isNull(), "FULL").otherwise("INCREMENTAL").alias("strategy")))


def until_known(df: DataFrame, order: Sequence[str], known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows newer than the newest row whose key is known, as a newest-first read finds them that stops there; all rows if none is known.

    ``known`` may hold any part of the earlier keys, such as those of the last run.
    """
    mark = df.join(known.select(*key), list(key), "left_semi").agg(F.max(F.struct(*order)).alias("m")).scalar()
    return df.where(F.coalesce(F.struct(*order) > mark, F.lit(True)))
