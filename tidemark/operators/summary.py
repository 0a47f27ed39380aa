"""Aggregates: marks, counts, top lists, latest facts, texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, time: str, previous=None) -> DataFrame:
    """One row with the greatest value, or the previous mark when nothing newer came."""
    before = F.lit(previous).cast(df.schema[time].dataType)
    return df.agg(F.max(time).alias("_new")).select(F.greatest("_new", before).alias("mark"))


def marks_by(df: DataFrame, entity: Sequence[str], time: str) -> DataFrame:
    return df.groupBy(*entity).agg(F.max(time).alias("mark"))


def composite_mark(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The last row's columns in their order."""
    return df.agg(F.max(F.struct(*columns)).alias("_m")).select("_m.*")


def top_counts(df: DataFrame, keys: Sequence[str], k: int, name: str = "n") -> DataFrame:
    """The k most frequent keys; the key breaks ties."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys).limit(k)


def merge_counts(parts: Sequence[DataFrame], keys: Sequence[str], name: str = "n") -> DataFrame:
    """Counts of several batches added up; each batch is counted before they meet."""
    out = None
    for part in parts:
        counts = part.groupBy(*keys).agg(F.count("*").alias(name))
        out = counts if out is None else out.unionByName(counts)
    return out.groupBy(*keys).agg(F.sum(name).alias(name))


def latest_fact(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key the values of the row that comes last."""
    return (df.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_last"))
            .select(*keys, *[F.col("_last")[c].alias(c) for c in (*order, *values)]))


def first_of_kind(kinds: Column, values: Column, kind: str) -> Column:
    """From parallel lists: the value at the first place of a kind."""
    at = F.array_position(kinds, F.lit(kind))
    return F.when(at > 0, F.get(values, (at - 1).cast("int")))


def first_definitions(df: DataFrame, group: str, member: str, order: Column, values: Sequence[str]) -> DataFrame:
    """Union of the members of each group; the first definition of a member stays, with its order."""
    return (df.groupBy(group, member)
            .agg(F.min(F.struct(order.alias("first_at"), *values)).alias("_d"))
            .select(group, member, "_d.*"))


def as_text(df: DataFrame, line: Column, order: Sequence[Column], name: str = "text") -> DataFrame:
    """The lines of a bounded list (a top-k) as one text."""
    rows = df.select(F.struct(*order, line.alias("line")).alias("r"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias(name))


def assemble(df: DataFrame, key: str, order: str, piece: str, block: int = 256, name: str = "text") -> DataFrame:
    """Text pieces of each key in order as one text.

    Blocks of consecutive pieces are joined first, so a key with many pieces is spread over tasks and only its
    joined blocks meet; the final text is one cell by definition of the result.
    """
    blocks = (df.filter(F.col(piece).isNotNull())
              .groupBy(key, F.floor(F.col(order) / block).alias("_b"))
              .agg(F.expr(f"listagg({piece}, '') WITHIN GROUP (ORDER BY {order})").alias("_t")))
    return blocks.groupBy(key).agg(F.expr("listagg(_t, '') WITHIN GROUP (ORDER BY _b)").alias(name))


def running_total(df: DataFrame, earlier: int, name: str = "total") -> DataFrame:
    """Rows of this run added to the total of the runs before."""
    return df.agg((F.count("*") + F.lit(earlier)).alias(name))


def running_totals(df: DataFrame, run: str, runs: Sequence[int], name: str = "total") -> DataFrame:
    """Total after each run, runs without rows included: one conditional count a run, in one aggregate."""
    up_to = [F.struct(F.lit(r).alias(run), F.count(F.when(F.col(run) <= r, 1)).alias(name)) for r in runs]
    return df.agg(F.array(*up_to).alias("_runs")).select(F.inline("_runs"))


def partial_totals(df: DataFrame, sums: Sequence[str] = (), marks: Sequence[str] = (), distinct: str | None = None) -> DataFrame:
    """One row that can be merged with others: number of rows, sums, least and greatest values, and a sketch of the distinct values of a column.

    Sums are exact for whole and decimal numbers.
    """
    out = [F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}") for c in sums],
           *[f(c).alias(f"{n}_{c}") for c in marks for n, f in (("min", F.min), ("max", F.max))]]
    return df.agg(*out, *([F.hll_sketch_agg(distinct).alias("sketch")] if distinct else []))


def merged_totals(parts: DataFrame) -> DataFrame:
    """Partial totals of several runs as one; :func:`distinct_count` reads the sketch."""
    def merged(name: str) -> Column:
        if name == "sketch":
            return F.hll_union_agg(name).alias(name)
        f = F.min if name.startswith("min_") else F.max if name.startswith("max_") else F.sum
        return f(name).cast(parts.schema[name].dataType).alias(name)

    return parts.agg(*[merged(c) for c in parts.columns])


def distinct_count(sketch: Column | str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def totals_text(totals: DataFrame) -> str:
    """Totals (one row) as text for a state."""
    return totals.select(F.to_json(F.struct(*totals.columns), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})).first()[0]


def totals_of_text(text: str, like: DataFrame) -> DataFrame:
    """Totals from a state's text, typed like other partial totals."""
    rows = like.sparkSession.createDataFrame([(text,)], "t string")
    return rows.select(F.from_json("t", like.schema, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("t")).select("t.*")


def commit_with_totals(table, log: DataFrame, totals: DataFrame, batch: tuple[str, int], name: str = "totals", before_publish=None) -> int:
    """Commit the rows of a run and the totals of all runs together: only this run's rows are read, and a run that is repeated counts once.

    ``totals`` are the run's :func:`partial_totals`; what the state holds is merged with them.
    """
    if table.has_batch(*batch):
        return table.head()["version"]
    earlier = table.state().get(name)
    both = totals if earlier is None else merged_totals(totals.unionByName(totals_of_text(earlier, totals)))
    return table.commit(log, state={name: totals_text(both)}, batch=batch, before_publish=before_publish)


def sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def run_summary(counts: DataFrame, started, name: str = "table_name", rows: str = "row_count") -> DataFrame:
    """One row per run: start time, number of tables, rows and the table names (one line per table of the run)."""
    return counts.agg(
        F.lit(started).cast("timestamp_ntz").alias("sync_start"), F.count("*").alias("table_count"),
        F.sum(rows).alias("record_count"),
        F.array_join(F.array_sort(F.collect_list(name)), ",").alias("tables"))
