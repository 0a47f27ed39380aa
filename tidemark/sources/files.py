"""File sources: delimited text, archives, Parquet exports, page documents, XML."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import scalar_only
from tidemark.session import hadoop_path

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_delimited(spark: SparkSession, path, multi_line: bool = True, delimiter: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a header; every column is text. Only the header is read ahead.

    Quoted line breaks belong to their cell. Where no cell holds one, ``multi_line=False`` lets Spark split large files.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), sep=delimiter, encoding=encoding).csv(path)


def read_delimited_checked(spark: SparkSession, path, multi_line: bool = True, delimiter: str = ",", encoding: str = "UTF-8",
                           corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rows whose cells match the header, and those with more or fewer cells, with their raw text behind.

    Write the rejects out before asking for the raw text alone: the reader does not serve that column by itself.
    """
    plain = read_delimited(spark, path, multi_line, delimiter, encoding)
    schema = T.StructType([*plain.schema.fields, T.StructField(corrupt, T.StringType())])
    rows = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), sep=delimiter, encoding=encoding,
                              columnNameOfCorruptRecord=corrupt).schema(schema).csv(path)
    return rows.where(F.col(corrupt).isNull()).select(*plain.columns), rows.where(F.col(corrupt).isNotNull())


def read_typed(spark: SparkSession, path, schema: str | T.StructType, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of delimited text under a declared schema: no inference pass, unused columns are not parsed."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path).select(*columns)


def list_tables(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, str]:
    """Table name to path for the files (or part folders) with a suffix; the base name is the table name."""
    fs, target = hadoop_path(spark, folder)
    found = {}
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.endswith(suffix):
            found[name[: -len(suffix)]] = status.getPath().toString()
    return dict(sorted(found.items()))


def read_folder(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    """One frame per table file of a folder."""
    return {name: read_delimited(spark, path) for name, path in list_tables(spark, folder, suffix).items()}


def _column_name(text: str) -> str:
    return re.sub(r"\s+", "_", text.strip().lower())


def unzip_members(archives: DataFrame, tag: str = "path", content: str = "content") -> DataFrame:
    """CSV members of ZIP archives as (tag, member, row_no, fields map), header names trimmed and lower-cased.

    Each task opens its own archives and streams the members line by line.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch[tag], batch[content], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as archive:
                    for member in archive.namelist():
                        if not member.lower().endswith(".csv"):
                            continue
                        with archive.open(member) as stream:
                            yield from rows(name, member, stream)

    def rows(name, member, stream, size: int = 5000) -> Iterator[pd.DataFrame]:
        reader = csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""))
        header = [_column_name(c) for c in next(reader, [])]
        chunk = []
        for number, line in enumerate(reader):
            chunk.append((name, member, number, dict(zip(header, line, strict=False))))
            if len(chunk) == size:
                yield pd.DataFrame(chunk, columns=["tag", "member", "row_no", "fields"])
                chunk = []
        if chunk:
            yield pd.DataFrame(chunk, columns=["tag", "member", "row_no", "fields"])

    kind = archives.schema[tag].dataType.simpleString()
    return archives.select(tag, content).mapInPandas(
        members, f"tag {kind}, member string, row_no bigint, fields map<string,string>")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows of all ZIP files below a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return unzip_members(files.select("path", "content"))


def read_export(spark: SparkSession, path, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet export: dates as ISO text, bytes as UTF-8 text, nested values as JSON."""
    df = spark.read.parquet(path)
    return scalar_only(df.select(*columns) if columns else df)


def read_pages(spark: SparkSession, path, rows: str | None = None, multi_line: bool = False) -> DataFrame:
    """Rows of landed page documents."""
    return envelope_rows(spark.read.option("multiLine", str(multi_line).lower()).json(path), rows)


# Fixed value: list names that hold records, the likeliest first.
RECORD_LISTS = ("data", "results", "items", "records", "rows")


def _chosen_list(documents: DataFrame, rows: str | None, prefer: Sequence[str]) -> tuple[list[str], Column]:
    """Names of the lists in order of choice, and the one that each document's records are taken from."""
    lists = [f.name for f in documents.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if rows is not None:
        if rows not in lists:
            raise ValueError(f"the documents have no list {rows}")
        lists = [rows]
    lists = [n for n in prefer if n in lists] + [n for n in lists if n not in prefer]
    filled = [F.when(F.size(n) > 0, F.lit(n)) for n in lists]
    return lists, F.coalesce(*filled, *[F.when(F.col(n).isNotNull(), F.lit(n)) for n in lists], F.lit(None).cast("string"))


def envelope_rows(documents: DataFrame, rows: str | None = None, prefer: Sequence[str] = RECORD_LISTS) -> DataFrame:
    """The records inside page documents; each document chooses its own list.

    With ``rows`` the named list is taken; without it the first list with records, those of ``prefer`` before the others by name.
    A document with several filled lists keeps those it did not choose: see :func:`unchosen_lists`. Records of differently named lists come under the union of their columns. If no document has a list,
    each document is one row; otherwise documents without one are found by :func:`pages_without_rows`.
    """
    lists, chosen = _chosen_list(documents, rows, prefer)
    if not lists:
        return documents
    if len(lists) > 1:  # columns of lists that no document chooses stay out; one row for each list at most
        used = {r["n"] for r in documents.select(chosen.alias("n")).distinct().collect()}
        lists = [n for n in lists if n in used] or lists[:1]
    out = None
    for name in lists:
        element = documents.schema[name].dataType.elementType
        items = documents.where(chosen == name).select(F.explode(name).alias("_item"))
        items = items.select("_item.*") if isinstance(element, T.StructType) else items.select(F.col("_item").alias("value"))
        out = items if out is None else out.unionByName(items, allowMissingColumns=True)
    return out


def pages_without_rows(documents: DataFrame, rows: str | None = None, prefer: Sequence[str] = RECORD_LISTS) -> DataFrame:
    """Documents that :func:`envelope_rows` finds no list in, as they are."""
    lists, chosen = _chosen_list(documents, rows, prefer)
    return documents.where(chosen.isNull()) if lists else documents.limit(0)


def unchosen_lists(documents: DataFrame, prefer: Sequence[str] = RECORD_LISTS) -> DataFrame:
    """(list, documents, records): filled lists that :func:`envelope_rows` passes over because the document has an earlier one."""
    lists, chosen = _chosen_list(documents, None, prefer)
    if not lists:
        return documents.sparkSession.createDataFrame([], "list string, documents bigint, records bigint")
    sizes = documents.select(chosen.alias("_c"), F.explode(F.array(*[F.struct(F.lit(n).alias("list"), F.size(n).alias("n")) for n in lists])).alias("_l"))
    passed = sizes.where((F.col("_l.n") > 0) & (F.col("_l.list") != F.col("_c")))
    return passed.groupBy(F.col("_l.list").alias("list")).agg(F.count("*").alias("documents"), F.sum("_l.n").alias("records"))


def read_xml(spark: SparkSession, path, row_tag: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Repeated elements as rows."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def interval_scan(df: DataFrame, time: str, start, end, columns: Sequence[str] | None = None, limit: int | None = None,
                  order: Sequence[str] = ()) -> DataFrame:
    """Rows of a half-open interval; prunes date partitions and Parquet row groups. A limit needs the order that decides which rows."""
    out = df.filter((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end)))
    out = out.select(*columns) if columns else out
    if limit is None:
        return out
    if not order:
        raise ValueError("a limit needs an order")
    return out.orderBy(*order).limit(limit)
