"""Ordered change logs: build, fold to one row per key, apply to a keyed table.

A change log has the columns

* ``_seq``: order of the operations, of any type that can be ordered (whole numbers become bigint; a struct orders by several
  columns); unique per key, and across the log for truncates; an operation with a NULL order is older than all others,
* ``_op``: ``I`` upsert, ``U`` partial update, ``D`` soft delete, ``T`` truncate,
* ``_supplied``: names of the columns the operation carries; NULL, or no such column at all, for whole rows,
* the key columns and the value columns of the table.

The fold is one grouped aggregate (combined before the shuffle, so a hot key
costs one row per task) and the apply is one join on the key; both sides of the
join hold a key at most once, so no key can skew it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ, OP, SUPPLIED, DELETED, SYNCED = "_seq", "_op", "_supplied", "_deleted", "_synced"
META = (SEQ, OP, SUPPLIED)


def sequence(log: DataFrame) -> Column:
    """The order of a log's operations as aggregates and comparisons take it: where it may be NULL, a struct, which keeps NULL as the least value."""
    return F.struct(F.col(SEQ).alias("o")) if log.schema[SEQ].nullable else F.col(SEQ)


def _as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _log(df: DataFrame, op: str, seq, supplied: Sequence[str] | None = None) -> DataFrame:
    log = df.withColumns({SEQ: _as_col(seq), OP: F.lit(op)})
    if isinstance(log.schema[SEQ].dataType, (T.NumericType, T.NullType)) and not isinstance(log.schema[SEQ].dataType, T.FractionalType):
        log = log.withColumn(SEQ, F.col(SEQ).cast("bigint"))
    # a log without the column carries whole rows only, which folds as one struct instead of one per column
    return log if supplied is None else log.withColumn(SUPPLIED, F.array(*map(F.lit, supplied)).cast("array<string>"))


def upserts(df: DataFrame, seq, supplied: Sequence[str] | None = None) -> DataFrame:
    """Insert or replace by key and clear the deleted flag; only ``supplied`` columns when given."""
    return _log(df, "I", seq, supplied)


def updates(df: DataFrame, keys: Sequence[str], seq) -> DataFrame:
    """Change only the columns the frame carries; NULL in them is a value."""
    require_key_columns(df, keys)
    return _log(df, "U", seq, [c for c in df.columns if c not in keys])


def deletes(df: DataFrame, keys: Sequence[str], seq) -> DataFrame:
    """Set the deleted flag for whole keys; values stay."""
    require_key_columns(df, keys)
    return _log(df.select(*keys), "D", seq)


def truncate(spark, key_schema: T.StructType, seq: int) -> DataFrame:
    """One table-wide row: flags every row whose last touch is earlier."""
    empty = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in key_schema.fields])
    return _log(empty, "T", seq)


def union_changes(*logs: DataFrame) -> DataFrame:
    """Logs with different column sets as one log."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def require_key_columns(df: DataFrame, keys: Sequence[str]) -> None:
    """Updates and deletes need the full key."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"operation lacks key columns {missing}; the full key {list(keys)} is needed")


def with_full_keys(df: DataFrame, keys: Sequence[str], exempt: Column | None = None) -> DataFrame:
    """The rows as they are; a NULL in a key column fails the job.

    The test is a filter, so the key columns stay plain and an existing partitioning by them is still of use.
    """
    for k in keys:
        bad = F.col(k).isNull() if exempt is None else F.col(k).isNull() & ~exempt
        df = df.filter(F.when(bad, F.raise_error(F.lit(f"NULL in key column {k}")).cast("boolean")).otherwise(F.lit(True)))
    return df


def fold_changes(changes: DataFrame, keys: Sequence[str], truncates: bool = False) -> DataFrame:
    """One row per key: ``_first_i``, ``_last_i``, ``_last_d`` and per column the last supplied (seq, value).

    With ``truncates`` the table-wide rows stay in, as one row with NULL keys that holds ``_last_t``.
    """
    require_key_columns(changes, keys)
    values = [c for c in changes.columns if c not in keys and c not in META]
    seq, op = sequence(changes), F.col(OP)
    writes = op.isin("I", "U")
    marks = [
        F.min(F.when(op == "I", seq)).alias("_first_i"),
        F.max(F.when(op == "I", seq)).alias("_last_i"),
        F.max(F.when(op == "D", seq)).alias("_last_d"),
    ]
    if truncates:
        marks.append(F.max(F.when(op == "T", seq)).alias("_last_t"))
        changes = with_full_keys(changes, keys, exempt=op == "T")
    else:
        changes = with_full_keys(changes.filter(op != "T"), keys)
    names = ["_first_i", "_last_i", "_last_d", *(["_last_t"] if truncates else [])]
    if SUPPLIED in changes.columns:
        supplied = [
            F.max(F.when(writes & (F.col(SUPPLIED).isNull() | F.array_contains(SUPPLIED, c)),
                         F.struct(seq.alias("s"), F.col(c).alias("v")))).alias(f"_x_{c}")
            for c in values
        ]
        return changes.groupBy(*keys).agg(*marks, *supplied)
    whole = F.max(F.when(writes, F.struct(seq.alias("s"), *values))).alias("_whole")
    last = F.col("_whole")
    return changes.groupBy(*keys).agg(*marks, whole).select(*keys, *names, *[
        F.when(last.isNotNull(), F.struct(last["s"].alias("s"), last[c].alias("v"))).alias(f"_x_{c}") for c in values
    ])


def last_truncate(changes: DataFrame) -> Column:
    """Sequence of the last truncate as a scalar subquery (one row whatever the log's size)."""
    return changes.filter(F.col(OP) == "T").agg(F.max(sequence(changes))).scalar()


def apply_folded(base: DataFrame | None, folded: DataFrame, keys: Sequence[str], truncated_at: Column | None = None,
                 run_time: Column | None = None, log_size: str = "unknown") -> DataFrame:
    """The table after the folded log.

    ``log_size`` is what the caller has measured of the log. ``broadcast``: it fits the session's broadcast limit, so
    the base is not shuffled. ``hash``: each partition of it fits in memory, so the base is shuffled but not sorted.
    ``unknown``: a full outer sort-merge join, which spills. A table without rows yet (None) needs no join.
    """
    cut = F.lit(None).cast(folded.schema["_last_i"].dataType) if truncated_at is None else truncated_at
    if base is None:
        missing = {DELETED: F.lit(False), "_hit": F.lit(None).cast("boolean")}
        return _after(folded.withColumns(missing), keys, [*keys, *missing], folded, cut, run_time)
    if DELETED not in base.columns:
        base = base.withColumn(DELETED, F.lit(False))
    base = base.withColumn("_hit", F.lit(True))
    if log_size == "broadcast":
        small = F.broadcast(folded)
        hits = base.select(*keys).join(F.broadcast(folded.select(*keys)), list(keys), "left_semi")
        fresh = folded.join(F.broadcast(hits), list(keys), "left_anti")
        joined = base.join(small, list(keys), "left").unionByName(fresh, allowMissingColumns=True)
    else:
        side = folded.hint("shuffle_hash") if log_size == "hash" else folded
        joined = base.join(side, list(keys), "full_outer")
    return _after(joined, keys, base.columns, folded, cut, run_time)


def _after(joined: DataFrame, keys: Sequence[str], base_columns: Sequence[str], folded: DataFrame, cut: Column,
           run_time: Column | None) -> DataFrame:
    """Values and flags of the joined rows; ``_hit`` marks rows the base had."""
    changed = [c[3:] for c in folded.columns if c.startswith("_x_")]
    columns = [c for c in base_columns if c not in keys and c not in (DELETED, SYNCED, "_hit")]
    columns += [c for c in changed if c not in columns]
    joined = joined.filter(F.col("_hit") | F.col("_first_i").isNotNull())

    def value(name: str) -> Column:
        old = F.col(name) if name in base_columns else F.lit(None)
        if name not in changed:
            return old.alias(name)
        new = F.col(f"_x_{name}")
        use = new.isNotNull() & (F.col("_hit") | (new["s"] >= F.col("_first_i")))
        return F.when(use, new["v"]).otherwise(old).alias(name)

    flagged = F.greatest(F.col("_last_d"), cut)
    deleted = (F.when(F.col("_last_i").isNotNull(), F.coalesce(flagged > F.col("_last_i"), F.lit(False)))
               .otherwise(F.coalesce(F.col(DELETED), F.lit(False)) | flagged.isNotNull()))
    out = [*keys, *map(value, columns), deleted.alias(DELETED)]
    if run_time is not None:
        old = F.col(SYNCED) if SYNCED in base_columns else F.lit(None).cast("timestamp_ntz")
        touched = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in ("_last_i", "_last_d")]
                         + [F.col(f"_x_{c}").isNotNull() for c in changed] + [cut.isNotNull()])
        out.append(F.when(touched, run_time).otherwise(old).alias(SYNCED))
    elif SYNCED in base_columns:
        out.append(F.col(SYNCED))
    return joined.select(*out)


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str], truncates: bool = False,
                  run_time: Column | None = None) -> DataFrame:
    """Fold and apply in one lazy plan. ``truncates`` says whether the log may hold ``T`` rows."""
    cut = last_truncate(changes) if truncates else None
    return apply_folded(base, fold_changes(changes, keys), keys, cut, run_time)


def replay_log(base: DataFrame, log: DataFrame, keys: Sequence[str], code: str, position: Sequence[str],
               codes: dict[str, str] | None = None) -> DataFrame:
    """Apply a database change log ordered by a position of several columns.

    Whole rows travel with each entry, so the fold is the last entry per key by
    position. Unknown codes are left out (count them with :func:`unknown_codes`).
    """
    codes = codes or {"I": "I", "U": "I", "D": "D"}
    values = [c for c in log.columns if c not in keys and c != code and c not in position]
    known = log.filter(F.col(code).isin(*codes))
    order = F.struct(*position)
    writing = [k for k, v in codes.items() if v == "I"]
    last = with_full_keys(known, keys).groupBy(*keys).agg(
        F.max_by(F.col(code), order).alias("_code"),
        F.max(F.when(F.col(code).isin(*writing), F.struct(order.alias("p"), F.struct(*values).alias("v")))).alias("_row"))
    both = base.withColumn("_hit", F.lit(True)).join(last, list(keys), "full_outer")
    if DELETED not in base.columns:
        both = both.withColumn(DELETED, F.lit(False))
    both = both.filter(F.col("_hit") | F.col("_row").isNotNull())
    new = F.col("_row")
    return both.select(
        *keys,
        *[F.when(new.isNotNull(), new["v"][c]).otherwise(F.col(c) if c in base.columns else F.lit(None)).alias(c)
          for c in values],
        F.when(F.col("_code").isNull(), F.col(DELETED))
        .otherwise(F.col("_code").isin(*[k for k, v in codes.items() if v == "D"])).alias(DELETED),
    )


def unknown_codes(log: DataFrame, code: str, codes: Sequence[str] = ("I", "U", "D")) -> DataFrame:
    """How often each code appears that the replay leaves out."""
    return log.filter(~F.col(code).isin(*codes) | F.col(code).isNull()).groupBy(code).agg(F.count("*").alias("skipped"))


def flagged_ops(df: DataFrame, flag: Column, seq) -> DataFrame:
    """Each row as an upsert, followed by a delete where the source marks it deleted."""
    steps = F.when(flag, F.array(F.struct(F.lit(0).alias("n"), F.lit("I").alias("o")),
                                 F.struct(F.lit(1).alias("n"), F.lit("D").alias("o")))).otherwise(
        F.array(F.struct(F.lit(0).alias("n"), F.lit("I").alias("o"))))
    out = df.withColumn("_step", F.explode(steps))
    return out.withColumns({SEQ: _as_col(seq).cast("bigint") * 2 + F.col("_step.n"), OP: F.col("_step.o")}).drop("_step")


def incomplete_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows with a NULL in a key column, with the names of those columns."""
    require_key_columns(changes, keys)
    missing = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    return changes.withColumn("missing_key", missing).filter(F.col("missing_key") != "")


def delete_where(table: DataFrame, keys: Sequence[str], predicate: Column, seq) -> DataFrame:
    """Deletes for the keys of the rows that satisfy a predicate."""
    return deletes(table.filter(predicate), keys, seq)


def update_where(table: DataFrame, keys: Sequence[str], predicate: Column, values: dict[str, Column], seq) -> DataFrame:
    """Updates for the keys of the rows that satisfy a predicate."""
    return updates(table.filter(predicate).select(*keys, *[v.alias(n) for n, v in values.items()]), keys, seq)


def empty_like(df: DataFrame) -> DataFrame:
    """A table with the columns of a frame and no row yet."""
    return df.sparkSession.createDataFrame([], df.schema)
