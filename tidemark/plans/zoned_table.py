"""Appended rows in files sorted by a cursor, with each file's least and greatest cursor and its rows in the commit.

A scan of a range opens only the files whose range meets it, the n-th row in cursor order is found by counts, and only the file that holds
it is sorted. Deletes and updates by a predicate on the cursor rewrite the files that can hold such rows and no others.

Layout below the table path: ``rows/<attempt>/*.parquet`` and ``commits/<version>.json`` (the zones: file, low, high, rows).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.store import commit_versions, create_once, read_text

#: Rows of one file, about.
FILE_ROWS = 1_000_000


class ZonedTable:
    """``cursor`` is a column that can be ordered and written as JSON text (numbers, text, dates, times); rows whose cursor is NULL are an error.

    The zones are as many as the files; the driver holds them while it plans, as it holds the files of any scan.
    """

    def __init__(self, spark: SparkSession, path: str, cursor: str, file_rows: int = FILE_ROWS):
        self.spark, self.path, self.cursor, self.file_rows = spark, path.rstrip("/"), cursor, file_rows

    def head(self) -> dict | None:
        for version in reversed(commit_versions(self.spark, self.path)):
            text = read_text(self.spark, f"{self.path}/commits/{version:010d}.json")
            if text.endswith("}"):
                return json.loads(text)
        return None

    def _schema(self, head: dict) -> T.StructType:
        return T.StructType.fromJson(head["schema"])

    def _frame(self, head: dict, zones: Sequence[dict]) -> DataFrame:
        schema = self._schema(head)
        if not zones:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/rows/{z['file']}" for z in zones])

    def zones(self, low=None, high=None, head: dict | None = None) -> list[dict]:
        """Files that may hold cursors from ``low`` to ``high``, both inclusive, in order of their least cursor."""
        head = head or self.head()
        if head is None:
            raise ValueError(f"table {self.path} has no commit")
        kind = self._schema(head)[self.cursor].dataType
        # bounds are compared by Spark as the cursor's type, in one small job over the zones
        rows = self.spark.createDataFrame([(i, z["low"], z["high"]) for i, z in enumerate(head["zones"])], "i int, low string, high string")
        keep = F.lit(True)
        if low is not None:
            keep = keep & (F.col("high").cast(kind) >= F.lit(low).cast(kind))
        if high is not None:
            keep = keep & (F.col("low").cast(kind) <= F.lit(high).cast(kind))
        found = rows.where(keep).orderBy(F.col("low").cast(kind), F.col("high").cast(kind), "i").collect()
        return [head["zones"][r["i"]] for r in found]

    def _write(self, df: DataFrame) -> list[dict]:
        """Rows sorted by cursor across files; the zones of the files."""
        checked = df.where(F.when(F.col(self.cursor).isNull(), F.raise_error(F.lit("NULL cursor")).cast("boolean")).otherwise(F.lit(True)))
        attempt = uuid.uuid4().hex
        target = f"{self.path}/rows/{attempt}"
        files = max(1, -(-df.count() // self.file_rows))
        checked.repartitionByRange(files, self.cursor, *[c for c in df.columns if c != self.cursor and not isinstance(df.schema[c].dataType, T.MapType)]).sortWithinPartitions(self.cursor).write.parquet(target)
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        found = self.spark.read.schema(df.schema).parquet(target).groupBy(name.alias("file")).agg(
            F.min(self.cursor).cast("string").alias("low"), F.max(self.cursor).cast("string").alias("high"), F.count("*").alias("rows")).collect()  # one row a file
        return [{"file": f"{attempt}/{r['file']}", "low": r["low"], "high": r["high"], "rows": r["rows"]} for r in found]

    def _publish(self, head: dict, zones: list[dict], schema: T.StructType) -> int:
        version = head["version"] + 1
        create_once(self.spark, f"{self.path}/commits/{version:010d}.json", json.dumps({"version": version, "cursor": self.cursor, "zones": zones, "schema": schema.jsonValue()}))
        return version

    def append(self, df: DataFrame) -> int:
        """Add rows, as one commit."""
        head = self.head() or {"version": 0, "zones": [], "schema": None}
        if head["schema"] and self._schema(head).simpleString() != df.schema.simpleString():
            raise ValueError(f"rows of {df.schema.simpleString()} do not fit")
        schema = self._schema(head) if head["schema"] else T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        return self._publish(head, [*head["zones"], *self._write(df)], schema)

    def read(self, low=None, high=None) -> DataFrame:
        """Rows with cursors from ``low`` to ``high``, both inclusive; files that hold none of them are not opened."""
        head = self.head()
        rows = self._frame(head or {}, self.zones(low, high, head))
        for bound, test in ((low, lambda c, b: c >= b), (high, lambda c, b: c <= b)):
            if bound is not None:
                rows = rows.where(test(F.col(self.cursor), F.lit(bound).cast(rows.schema[self.cursor].dataType)))
        return rows

    def newer(self, mark) -> DataFrame:
        """Rows strictly newer than a mark (all rows for None)."""
        rows = self.read(low=mark)
        return rows if mark is None else rows.where(F.col(self.cursor) > F.lit(mark).cast(rows.schema[self.cursor].dataType))

    def cursor_at(self, n: int, after=None):
        """Cursor of the n-th row (from 1) in order, counted behind ``after``; None if there are fewer. As text.

        Counts of files that lie wholly before others are added up; only the files that overlap the place are read.
        """
        head = self.head()
        kind = self._schema(head)[self.cursor].dataType
        zones = self.zones(after, None, head)
        bounds = self.spark.createDataFrame([(z[b],) for z in zones for b in ("low", "high")], "b string").distinct()
        rank = {r["b"]: i for i, r in enumerate(bounds.orderBy(F.col("b").cast(kind)).collect())}
        # files whose ranges overlap or touch form a run; runs follow each other in order
        runs, top = [], -1
        for z in zones:
            if runs and rank[z["low"]] <= top:
                runs[-1].append(z)
            else:
                runs.append([z])
            top = max(top, rank[z["high"]])
        left = n
        for run in runs:
            rows = self._frame(head, run)
            if after is not None:
                rows = rows.where(F.col(self.cursor) > F.lit(after).cast(kind))
            inside = sum(z["rows"] for z in run) if after is None or run is not runs[0] else rows.count()
            if left <= inside:
                row = rows.select(self.cursor).orderBy(self.cursor).offset(left - 1).limit(1).select(F.col(self.cursor).cast("string").alias("c")).first()
                return row["c"] if row else None
            left -= inside
        return None

    def page(self, n: int, after=None) -> tuple[DataFrame, str | None]:
        """Up to n rows behind ``after`` and those that share the last cursor, with the mark for the next page (None: nothing follows)."""
        last = self.cursor_at(n, after)
        rows = self.newer(after)
        return (rows, None) if last is None else (rows.where(F.col(self.cursor) <= F.lit(last).cast(rows.schema[self.cursor].dataType)), last)

    def rewrite_where(self, low, high, change: Callable[[DataFrame, Column], DataFrame]) -> int:
        """Rewrite rows with cursors from ``low`` to ``high``: ``change(rows, inside)`` gets the rows of the files that may hold such, and the test of a row."""
        head = self.head()
        touched = self.zones(low, high, head)
        kind = self._schema(head)[self.cursor].dataType
        inside = (F.col(self.cursor) >= F.lit(low).cast(kind)) & (F.col(self.cursor) <= F.lit(high).cast(kind))
        names = {z["file"] for z in touched}
        rest = [z for z in head["zones"] if z["file"] not in names]
        new = self._write(change(self._frame(head, touched), inside)) if touched else []
        return self._publish(head, [*rest, *new], self._schema(head))

    def delete_where(self, low, high) -> int:
        """Remove the rows of a cursor range."""
        return self.rewrite_where(low, high, lambda rows, inside: rows.where(~inside))

    def update_where(self, low, high, values: dict[str, Column]) -> int:
        """Change columns of the rows of a cursor range."""
        return self.rewrite_where(low, high, lambda rows, inside: rows.withColumns({n: F.when(inside, v).otherwise(F.col(n)).cast(rows.schema[n].dataType) for n, v in values.items()}))
