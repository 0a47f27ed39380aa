"""Catalogue rows of tables: columns, types, keys and how far columns are filled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE = "table_name string, column_name string, ordinal int, data_type string"


def columns_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column from the frames' schemas (no data is read)."""
    rows = [(name, f.name, i, f.dataType.simpleString()) for name, df in tables.items()
            for i, f in enumerate(df.schema.fields, 1)]
    return spark.createDataFrame(rows, CATALOGUE)


def keys_of(spark: SparkSession, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Declared primary key columns as rows."""
    rows = [(name, c) for name, columns in keys.items() for c in columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def with_key_flag(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Columns left join key columns: flag 1 or 0."""
    marked = keys.withColumn("_key", F.lit(1))
    return (columns.join(marked, ["table_name", "column_name"], "left")
            .withColumn("is_key", F.when(F.col("_key").isNotNull(), 1).otherwise(0)).drop("_key"))


def filled_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column, rows, filled) from one aggregate per table."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
        each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in df.columns])
        parts.append(counts.select(F.lit(name).alias("table_name"), F.col("_rows").alias("row_count"), F.inline(each)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows): counted from the file footers where the source allows it."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def table_schema(catalogue: DataFrame) -> DataFrame:
    """Per table its ordered columns with declared types and its key columns (sizes are those of a schema)."""
    item = F.struct("ordinal", F.concat_ws(" ", "column_name", "declared_type").alias("text"))
    key = F.when(F.col("is_key") == 1, F.struct("ordinal", F.col("column_name").alias("text")))

    def joined(rows: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["text"]), ", ")

    return catalogue.groupBy("table_name").agg(joined(item).alias("columns"), joined(key).alias("primary_key"))
