"""Table plans and runs over lists of table specs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import upserts
from tidemark.operators.cursors import infer_cursor, newer
from tidemark.operators.project import include_exclude
from tidemark.operators.schema import map_source_types
from tidemark.plans.store import KeyedTable
from tidemark.sources.catalogue import columns_of, keys_of, with_key_flag


@dataclass(frozen=True)
class TableSpec:
    """What to replicate: a source frame, its key, column lists, strategy and an optional transform."""

    name: str
    source: DataFrame
    keys: Sequence[str]
    include: Sequence[str] = ()
    exclude: Sequence[str] = ()
    strategy: str | None = None
    cursor: str | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    buckets: int | None = None


def plan_tables(spark: SparkSession, specs: Sequence[TableSpec]) -> DataFrame:
    """One plan row per spec: columns with declared types, key, strategy and replication key."""
    frames = {s.name: include_exclude(s.source, s.include, s.exclude) for s in specs}
    flagged = with_key_flag(columns_of(spark, frames), keys_of(spark, {s.name: s.keys for s in specs}))
    typed = map_source_types(flagged, "spark")
    text = F.struct("ordinal", F.concat_ws(" ", "column_name", "declared_type").alias("t"))
    columns = typed.groupBy("table_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda r: r["t"]), ", ").alias("columns"))
    settings = spark.createDataFrame(
        [(s.name, ",".join(s.keys), (s.strategy or "").upper(), s.cursor) for s in specs],
        "table_name string, primary_key string, asked string, given string")
    inferred = infer_cursor(flagged.withColumn("is_key", F.lit(0)))
    both = settings.join(columns, "table_name").join(inferred, "table_name", "left")
    cursor = F.when(F.col("asked") != "FULL", F.coalesce("given", "replication_key"))
    return both.select("table_name", "columns", "primary_key",
                       F.when(cursor.isNull(), "FULL").otherwise("INCREMENTAL").alias("strategy"),
                       cursor.alias("replication_key"))


def _sequence(rows: DataFrame, cursor: str | None):
    """Order between rows of one key in one run: by the cursor, whatever its type; a missing cursor comes first."""
    return F.struct(F.col(cursor).alias("at")) if cursor and cursor in rows.columns else 1


def run_specs(spark: SparkSession, specs: Sequence[TableSpec], root: str) -> dict[str, KeyedTable]:
    """Plan, select, transform, apply and store the state, table by table."""
    plans = {r["table_name"]: r for r in plan_tables(spark, specs).collect()}  # one row per spec
    out = {}
    for spec in specs:
        plan = plans[spec.name]
        table = KeyedTable(spark, f"{root}/{spec.name}", spec.keys, spec.buckets)
        state, cursor = table.state(), plan["replication_key"]
        rows = include_exclude(spec.source, spec.include, spec.exclude)
        if cursor and state.get("mark") is not None:
            kind = rows.schema[cursor].dataType
            rows = rows.filter(newer(F.col(cursor), F.lit(state["mark"]).cast(kind)))
        mark = state.get("mark")
        if cursor:
            found = rows.agg(F.max(cursor).cast("string").alias("m")).first()["m"]
            mark = found if found is not None else mark
        if spec.transform:
            rows = spec.transform(rows)
        table.commit(upserts(rows, _sequence(rows, cursor)), state={"mark": mark, "strategy": plan["strategy"]})
        out[spec.name] = table
    return out
