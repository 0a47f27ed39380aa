"""Comparing key sets and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import OP, SEQ


def row_digest(columns: Sequence[str]) -> Column:
    """MD5 of the values as JSON; NULL stays visible in it."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def missing_keys(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen before and not now. ``current`` must be a full key set, not a batch of changes."""
    return previous.select(*keys).join(current.select(*keys), list(keys), "left_anti")


def compare_hashes(previous: DataFrame, current: DataFrame, keys: Sequence[str], digest: str) -> DataFrame:
    """Per key ``I`` new, ``U`` changed, ``D`` gone or ``=`` same, from two (key, digest) frames."""
    left = previous.select(*keys, F.col(digest).alias("_old"), F.lit(True).alias("_was"))
    right = current.select(*keys, F.col(digest).alias("_new"), F.lit(True).alias("_is"))
    verdict = (F.when(F.col("_was").isNull(), "I").when(F.col("_is").isNull(), "D")
               .when(F.col("_old").eqNullSafe(F.col("_new")), "=").otherwise("U"))
    return left.join(right, list(keys), "full_outer").select(*keys, verdict.alias("verdict"))


def snapshot_changes(previous: DataFrame, current: DataFrame, keys: Sequence[str], seq: int = 1) -> DataFrame:
    """Change log that turns the previous snapshot into the current one.

    One full outer join; the previous side carries only its key and digest.
    """
    values = [c for c in current.columns if c not in keys]
    old = previous.select(*keys, row_digest(values).alias("_old"), F.lit(True).alias("_was"))
    new = current.select(*keys, *values, row_digest(values).alias("_new"), F.lit(True).alias("_is"))
    op = (F.when(F.col("_is").isNull(), "D")
          .when(F.col("_was").isNull() | ~F.col("_old").eqNullSafe(F.col("_new")), "I"))
    return (old.join(new, list(keys), "full_outer").withColumn(OP, op).filter(F.col(OP).isNotNull())
            .select(*keys, *values, F.lit(seq).cast("bigint").alias(SEQ), OP))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def append_batches(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Batches one after the other; a column a batch lacks is NULL there."""
    out = first
    for batch in rest:
        out = out.unionByName(batch, allowMissingColumns=True)
    return out
