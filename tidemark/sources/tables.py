"""Table scans by JDBC or files, whole or in disjoint segments."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.store import create_once
from tidemark.session import hadoop_path


def jdbc_options(url: str, table: str, fetch: int = 10_000, user: str | None = None, password: str | None = None,
                 driver: str | None = None, split: tuple[str, object, object, int] | None = None) -> dict[str, str]:
    """Reader options; ``split`` = (column, lower, upper, partitions) reads disjoint ranges in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), "pushDownPredicate": "true",
               "pushDownLimit": "true", "pushDownOffset": "true"}
    options.update({k: v for k, v in (("user", user), ("password", password), ("driver", driver)) if v is not None})
    if split:
        column, lower, upper, parts = split
        options.update(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts))
    return options


def read_jdbc(spark: SparkSession, columns: Sequence[str] | None = None, where: Column | None = None, **settings) -> DataFrame:
    """A database table; column list and predicate are pushed to the source."""
    return scan(spark.read.format("jdbc").options(**jdbc_options(**settings)).load(), columns, where)


def scan(df: DataFrame, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """Column list and predicate on any source."""
    out = df if where is None else df.filter(where)
    return out.select(*columns) if columns else out


def segment_of(key: Column, lower: int, upper: int, segments: int) -> Column:
    """Segment of an integer key between known bounds; keys outside go to the outer segments."""
    width = (upper - lower + 1) / segments
    number = F.floor((key - F.lit(lower)) / F.lit(width))
    return F.greatest(F.lit(0), F.least(F.lit(segments - 1), number)).cast("int")


def segment_predicates(key: str, lower: int, upper: int, segments: int) -> list[str]:
    """Disjoint SQL predicates that cover every key, NULL included, for a reader that takes predicates."""
    cuts = [lower + (upper - lower + 1) * i // segments for i in range(1, segments)]
    out = []
    for i in range(segments):
        low = f"{key} >= {cuts[i - 1]}" if i else None
        high = f"{key} < {cuts[i]}" if i < segments - 1 else None
        test = " AND ".join(p for p in (low, high) if p) or "1 = 1"
        out.append(f"({test}) OR {key} IS NULL" if i == 0 else test)
    return out


def read_segments(df: DataFrame, key: str, lower: int, upper: int, segments: int = 4) -> list[DataFrame]:
    """The table as disjoint frames, one per segment."""
    return [df.filter(F.expr(p)) for p in segment_predicates(key, lower, upper, segments)]


def quantile_segments(df: DataFrame, key: str, segments: int, tie: Sequence[str], share: float = 1.0) -> list[Column]:
    """Disjoint predicates that cover every row with about as many rows each, however the keys are distributed.

    Splitters are quantiles of a numeric key, of a sample of the rows if ``share`` is below 1. A value that holds several of them is a segment
    of its own for each, dealt by a hash of the ``tie`` columns. NULL keys go to the first segment.
    """
    rows = df.select(key) if share >= 1 else df.select(key).sample(share, seed=1)
    cuts = rows.agg(F.percentile_approx(key, [i / segments for i in range(1, segments)] or [0.5], 100 * segments)).first()[0] or []
    at = F.col(key)
    times, out, low = Counter(cuts), [], F.lit(True)
    for value in sorted(times):
        parts = times[value]
        out.append(low & ((at <= F.lit(value)) if parts == 1 else (at < F.lit(value))))
        if parts > 1:
            out += [(at == F.lit(value)) & (F.pmod(F.xxhash64(*tie), F.lit(parts)) == j) for j in range(parts)]
        low = at > F.lit(value)
    out.append(low)
    out[0] = out[0] | at.isNull()
    return out


def pull_segments(df: DataFrame, key: str, segments: Sequence[Column], path: str, before_done: Callable[[int], None] | None = None) -> list[int]:
    """Write each segment that has no cursor yet to a folder of its own, then its cursor (rows and last key). Returns the segments written.

    A run that stops leaves the finished segments; the next run writes the others alone. Give both the same segments.
    """
    written = []
    for i, predicate in enumerate(segments):
        fs, done = hadoop_path(df.sparkSession, f"{path}/cursors/{i}.json")
        if fs.exists(done):
            continue
        target = f"{path}/rows/_segment={i}"
        df.where(predicate).write.mode("overwrite").parquet(target)
        if before_done:
            before_done(i)
        found = df.sparkSession.read.schema(df.schema).parquet(target).agg(F.count("*").alias("n"), F.max(key).cast("string").alias("last")).first()
        create_once(df.sparkSession, f"{path}/cursors/{i}.json", json.dumps({"rows": found["n"], "last": found["last"]}))
        written.append(i)
    return written


def pulled(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of all segments."""
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("_segment")
