"""Order-dependent operators that scale: numbering, chunks, versions, prefixes.

Nothing here runs an unpartitioned window over table rows. Global positions use
two passes: the rows are written out range-partitioned and sorted, each partition
is counted, and the counts before a partition are added to positions inside it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialise


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows, written out range-partitioned and sorted by the order, each with its place ``_id``.

    The place holds the partition number in the upper bits and the position inside the partition below. Writing it
    with the rows fixes it: a task that runs again after a lost executor cannot move rows between partitions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranged")


_POSITION_BITS = 33


def _part() -> Column:
    return F.shiftright("_id", _POSITION_BITS)


def _offsets(stored: DataFrame, weight: Column) -> tuple[DataFrame, int]:
    """Sum of the weights in all partitions before each one (one row per shuffle partition), and the sum of all."""
    sums = stored.groupBy(_part().alias("_part")).agg(F.sum(weight).alias("s")).collect()
    before, rows = 0, []
    for part, total in sorted((r["_part"], r["s"]) for r in sums):
        rows.append((part, before))
        before += total
    return F.broadcast(stored.sparkSession.createDataFrame(rows, "_part bigint, _before bigint")), before


def running_sum(df: DataFrame, order: Sequence[str], weight: Column, name: str = "running") -> DataFrame:
    """Inclusive running sum of a weight in a total order over all rows."""
    stored = _ranged(df.withColumn("_w", weight.cast("bigint")), order).withColumn("_part", _part())
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (stored.withColumn("_inside", F.sum("_w").over(inside)).join(_offsets(stored, F.col("_w"))[0], "_part")
            .withColumn(name, F.col("_inside") + F.col("_before")).drop("_part", "_id", "_inside", "_before", "_w"))


def _numbered(df: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    stored = _ranged(df, order)
    offsets, total = _offsets(stored, F.lit(1))
    place = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (stored.withColumn("_part", _part()).join(offsets, "_part")
            .withColumn(name, place + F.col("_before") + 1).drop("_part", "_id", "_before")), total


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Positions from 1 in a total order; ``order`` must be unique. One shuffle, no window."""
    return _numbered(df, order, name)[0]


def pages(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Page number and position in the page, both from 0."""
    numbered = number_rows(df, order, "_n")
    return (numbered.withColumn("page", F.floor((F.col("_n") - 1) / size))
            .withColumn("page_index", (F.col("_n") - 1) % size).drop("_n"))


def up_to(df: DataFrame, order: Sequence[str], at: Row) -> Column:
    """Whether a row is not after the given order values, nulls first. The leading column alone bounds the scan."""
    def value(name: str) -> Column:
        return F.lit(at[name]).cast(df.schema[name].dataType)

    def before(name: str) -> Column:
        return F.lit(False) if at[name] is None else F.col(name).isNull() | (F.col(name) < value(name))

    def same(name: str) -> Column:
        return F.col(name).isNull() if at[name] is None else F.col(name) == value(name)

    out = F.lit(True)
    for name in reversed(order):
        out = before(name) | (same(name) & out)
    return (before(order[0]) | same(order[0])) & out


def _bound(df: DataFrame, order: Sequence[str], n: int) -> tuple[Row, int, int] | None:
    """(order values of the n-th row, rows equal to it up to the n-th, rows equal to it after), None for fewer rows.

    Only the order columns are sorted, and of those with a number or a time in front only what an estimated quantile
    leaves; one row and the counts of each partition reach the driver.
    """
    keys, lead = df.select(*order), order[0]
    parts = [keys]
    if isinstance(df.schema[lead].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        total = keys.count()
        if total < n:
            return None
        # the quantile of just this share, with its error on top; a cut that is too low falls back to all rows
        cut = keys.agg(F.percentile_approx(lead, min(1.0, n / total + 2e-5), 100_000).alias("q")).first()["q"]
        if cut is not None:
            parts.insert(0, keys.filter(F.col(lead).isNull() | (F.col(lead) <= F.lit(cut))))
    for part in parts:
        stored, before = _ranged(part, order), 0
        counts = stored.groupBy(_part().alias("p")).count().collect()
        for p, count in sorted((r["p"], r["count"]) for r in counts):
            if before + count >= n:
                at = stored.filter(F.col("_id") == (p << _POSITION_BITS) + n - before - 1).select(*order).first()
                equal = F.lit(True)
                for c in order:
                    equal = equal & F.col(c).eqNullSafe(F.lit(at[c]).cast(df.schema[c].dataType))
                place = F.col("_id") < (p << _POSITION_BITS) + n - before
                ties = stored.filter(equal).agg(F.count_if(place).alias("taken"), F.count_if(~place).alias("left")).first()
                return at, ties["taken"], ties["left"]
            before += count
    return None


def split_at(df: DataFrame, order: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows in an order, and the others, as two filters on the order of the n-th row.

    No row is copied or shuffled for it. If the order is not unique, which of the rows equal to the n-th one come first
    is not fixed, but the number of rows is.
    """
    if n <= 0:
        return df.limit(0), df
    found = _bound(df, order, n)
    if found is None:
        return df, df.limit(0)
    at, taken, left = found
    inside = up_to(df, order, at)
    first, rest = df.filter(inside), df.filter(~inside)
    if left:
        equal = F.lit(True)
        for c in order:
            equal = equal & F.col(c).eqNullSafe(F.lit(at[c]).cast(df.schema[c].dataType))
        ties = df.filter(equal)
        first, rest = first.filter(~equal).unionByName(ties.limit(taken)), rest.unionByName(ties.limit(left))
    return first, rest


def first_rows(df: DataFrame, order: Sequence[str], n: int, heap: bool = False) -> DataFrame:
    """The first n rows in an order, nulls first (unique for a fixed result).

    ``heap`` is for callers whose n is small by its meaning (a page, a report, calls of one run): each task keeps its
    n first rows. Otherwise n may be any share of the table, see :func:`split_at`.
    """
    return df.orderBy(*order).limit(n) if heap else split_at(df, order, n)[0]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key: a grouped minimum, so copies of a hot key are merged before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return (df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
            .select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns]))


def last_write(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key and column the last value that is not NULL: one grouped aggregate."""
    marks = [F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v")))).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*marks).select(*keys, *[F.col(c)["_v"].alias(c) for c in columns])


def at_newest(df: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """The rows that share the greatest value."""
    return df.filter(F.col(time) == df.agg(F.max(time)).scalar()).select(time, *columns)


def with_valid_to(df: DataFrame, keys: Sequence[str], time: str, name: str = "valid_to") -> DataFrame:
    """The time of the next version of the same key.

    Rows are cut by (key, time) ranges, so the versions of one key may span tasks; the first row of the following
    range closes a key that runs over a cut.
    """
    stored = _ranged(df, [*keys, time]).withColumn("_part", _part())
    firsts = stored.groupBy("_part").agg(F.min(F.struct(*keys, time)).alias("first"))
    # one row per partition, at most shuffle.partitions of them
    parts = sorted(r["_part"] for r in firsts.select("_part").collect())
    order = df.sparkSession.createDataFrame(list(zip(parts, parts[1:], strict=False)), "_part bigint, _next bigint")
    following = (order.join(firsts.select(F.col("_part").alias("_next"), "first"), "_next")
                 .select("_part", F.col("first").alias("_first")))
    inside = F.lead(time).over(Window.partitionBy("_part", *keys).orderBy(time))
    same = F.struct(*keys) == F.struct(*[F.col("_first")[k].alias(k) for k in keys])
    return (stored.join(F.broadcast(following), "_part", "left")
            .withColumn(name, F.coalesce(inside, F.when(same, F.col("_first")[time]))).drop("_part", "_id", "_first"))


def success_prefix(df: DataFrame, key: str, failed: Column) -> DataFrame:
    """Rows before the first failed key."""
    bound = df.agg(F.min(F.when(failed, F.col(key)))).scalar()
    return df.filter(bound.isNull() | (F.col(key) < bound))


def _leave(rows: pd.DataFrame) -> pd.DataFrame:
    """For each pointer of a block: the first value on its chain that lies outside the block."""
    rows = rows.sort_values("start")
    start, stop = rows["start"].to_numpy(), rows["stop"].to_numpy()
    own = np.arange(len(start))
    at = np.minimum(np.searchsorted(start, stop), len(start) - 1)
    ahead = np.where(start[at] == stop, at, own)  # the last pointer inside the block points to itself
    while not np.array_equal(further := ahead[ahead], ahead):
        ahead = further
    return pd.DataFrame({"start": start, "stop": stop[ahead]})


def _follow(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The pointers of a block that the chain uses from where it enters the block."""
    ahead, used = dict(zip(rows["start"], rows["stop"], strict=True)), []
    for at in entries["start"]:
        while at in ahead:
            used.append((at, ahead[at]))
            at = ahead[at]
    return pd.DataFrame(used, columns=["start", "stop"])


def _next_end(rows: DataFrame) -> DataFrame:
    """``stop`` of each row: the nearest position of a row with ``end`` 1 at or after its own.

    Rows are cut by ranges of position; what lies beyond a range comes from the first end of the ranges after it.
    """
    stored = _ranged(rows, ["pos", "end"]).withColumn("_part", _part())
    is_end = F.when(F.col("end") == 1, F.col("pos"))
    after, beyond = [], None
    # one row for each shuffle partition
    for r in sorted(stored.groupBy("_part").agg(F.min(is_end).alias("first")).collect(), key=lambda r: -r["_part"]):
        after.append((r["_part"], beyond))
        beyond = beyond if r["first"] is None else r["first"]
    later = rows.sparkSession.createDataFrame(after, "_part bigint, _beyond bigint")
    inside = Window.partitionBy("_part").orderBy(F.desc("pos"), F.desc("end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (stored.withColumn("_inside", F.min(is_end).over(inside)).join(F.broadcast(later), "_part")
            .withColumn("stop", F.coalesce("_inside", "_beyond")).drop("_part", "_id", "_inside", "_beyond"))


def chunk_bounds(df: DataFrame, key: str, n: int, span: int = 1_000_000) -> DataFrame:
    """Greedy chunks over a cursor column: (lower exclusive, upper inclusive, rows).

    Each chunk ends at the value of its n-th row and holds all rows of that value. Every distinct value gets a
    pointer to the value that would end a chunk starting after it: the next one in one sorted pass, however many rows
    a value has. The chain of pointers from the start is followed inside blocks of ``span`` row positions (so at most
    that many values are in a group) and from block to block by doubling, which takes log2(blocks) joins; no task sees
    all values.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    values = materialise(running_sum(counted, [key], F.col("_n"), "c").select(F.col(key).alias("v"), "c", "_n"), "chunk-values")
    total = values.agg(F.max("c")).first()[0]
    if total is None:
        return values.select(F.col("v").alias("lower"), F.col("v").alias("upper"), F.col("c").alias("rows"))
    span = max(span, n)

    starts = values.select("c").unionByName(df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("c")))
    targets = starts.select((F.col("c") + n).alias("pos"), F.lit(0).alias("end"), F.col("c").alias("start"))
    ends = values.select(F.col("c").alias("pos"), F.lit(1).alias("end"), F.lit(None).cast("bigint").alias("start"))
    pointer = (_next_end(targets.unionByName(ends)).filter(F.col("end") == 0)
               .select("start", F.coalesce("stop", F.when(F.col("start") < total, F.lit(total))).alias("stop"))
               .filter(F.col("stop").isNotNull()))
    pointer = materialise(pointer.withColumn("block", F.floor(F.col("start") / span)), "chunk-next")

    entries = pointer.filter(F.col("start") == 0).select("start")
    jump = materialise(pointer.groupBy("block").applyInPandas(_leave, "start bigint, stop bigint"), "chunk-leave")
    # only values that some block leaves to can be where the chain enters a block: at most n per block
    doors = entries.unionByName(jump.select(F.col("stop").alias("start"))).distinct()
    jump = jump.join(doors, "start", "left_semi")
    for step in range(max(1, math.ceil(math.log2(total / span + 2)))):
        if step:
            ahead = jump.select(F.col("start").alias("stop"), F.col("stop").alias("after"))
            jump = materialise(jump.join(ahead, "stop").select("start", F.col("after").alias("stop")), "chunk-jump")
        reach = F.explode(F.array("start", "stop")).alias("start")
        entries = entries.join(jump, "start", "left").select(reach).filter(F.col("start").isNotNull())
    entries = entries.distinct().withColumn("block", F.floor(F.col("start") / span))
    pairs = pointer.groupBy("block").cogroup(entries.groupBy("block")).applyInPandas(_follow, "start bigint, stop bigint")
    upper = values.select(F.col("c").alias("stop"), F.col("v").alias("upper"))
    lower = values.select(F.col("c").alias("start"), F.col("v").alias("lower"))
    return (pairs.join(upper, "stop").join(lower, "start", "left")
            .select("lower", "upper", (F.col("stop") - F.col("start")).alias("rows")))
