"""A sink of two outcomes: accepted and rejected rows become visible together, or neither does.

Tasks write files with names of their own, accepted and rejected apart, below the target's hidden ``_attempts`` folder; each reports its
files and counts. The driver's commit creates one file that lists them: what a reader may see. A job that fails or is aborted leaves nothing listed, and
its files are removed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.sources.topics import _file_system

FORMAT = "checked_rows"
REASON = "_reason"
KINDS = ("accepted", "rejected")
#: Rows of one row group; a task holds one for each kind.
GROUP_ROWS = 50_000


@dataclass
class TaskFiles(WriterCommitMessage):
    files: dict[str, str]
    rows: dict[str, int]


class CheckedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema, self.attempt = options["path"].rstrip("/"), schema, uuid.uuid4().hex

    def _schema(self, kind: str) -> pa.Schema:
        whole = to_arrow_schema(self.schema)
        return whole if kind == "rejected" else pa.schema([f for f in whole if f.name != REASON])

    def _stopped(self, root: str) -> str:
        """A file that marks an aborted job, for tasks that still run."""
        return f"{root}/_attempts/.{self.attempt}.aborted"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFiles:
        fs, root = _file_system(self.path)
        folder, name = f"{root}/_attempts/{self.attempt}", uuid.uuid4().hex
        writers: dict[str, pq.ParquetWriter] = {}
        rows = dict.fromkeys(KINDS, 0)
        try:
            for batch in iterator:
                bad = pc.is_valid(batch.column(batch.schema.get_field_index(REASON)))
                for kind, mask in (("accepted", pc.invert(bad)), ("rejected", bad)):
                    part = batch.filter(mask).select(self._schema(kind).names)
                    if part.num_rows:
                        if kind not in writers:
                            fs.create_dir(folder, recursive=True)
                            writers[kind] = pq.ParquetWriter(f"{folder}/{kind}-{name}.parquet", self._schema(kind), filesystem=fs)
                        writers[kind].write_table(pa.Table.from_batches([part]).cast(self._schema(kind)), row_group_size=GROUP_ROWS)
                        rows[kind] += part.num_rows
        finally:
            for writer in writers.values():
                writer.close()
            # a task may end after its job was aborted: then nobody else removes its files
            if fs.get_file_info(self._stopped(root)).type != pf.FileType.NotFound:
                for kind in writers:
                    late = f"{folder}/{kind}-{name}.parquet"
                    if fs.get_file_info(late).type == pf.FileType.File:
                        fs.delete_file(late)
        return TaskFiles({kind: f"_attempts/{self.attempt}/{kind}-{name}.parquet" for kind in writers}, rows)

    def commit(self, messages: list[TaskFiles | None]) -> None:
        fs, root = _file_system(self.path)
        done = [m for m in messages if m is not None]
        listed = {"time": time.time_ns(), "rows": {k: sum(m.rows[k] for m in done) for k in KINDS}, "schemas": {"rejected": self.schema.jsonValue()},
                  "files": {k: sorted(m.files[k] for m in done if k in m.files) for k in KINDS}}
        fs.create_dir(f"{root}/_commits", recursive=True)
        # written under another name first: a list is there as a whole or not at all
        part, final = f"{root}/_commits/.{self.attempt}", f"{root}/_commits/{listed['time']:020d}-{self.attempt}.json"
        with fs.open_output_stream(part) as file:
            file.write(json.dumps(listed).encode())
        fs.move(part, final)

    def abort(self, messages: list[TaskFiles | None]) -> None:
        fs, root = _file_system(self.path)
        folder = f"{root}/_attempts/{self.attempt}"
        fs.create_dir(f"{root}/_attempts", recursive=True)
        with fs.open_output_stream(self._stopped(root)):
            pass
        if fs.get_file_info(folder).type == pf.FileType.Directory:
            fs.delete_dir(folder)


class CheckedSource(DataSource):
    """Option: path."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> CheckedWriter:
        if overwrite:
            raise ValueError("rows are only appended")
        if REASON not in schema.fieldNames():
            raise ValueError(f"rows need the column {REASON}: NULL for accepted ones")
        return CheckedWriter(dict(self.options), schema)


def write_checked(rows: DataFrame, path: str, reason) -> None:
    """Append rows in one commit; ``reason`` (a column) says why a row is rejected and is NULL for the others."""
    rows.sparkSession.dataSource.register(CheckedSource)
    rows.withColumn(REASON, reason).write.format(FORMAT).mode("append").save(path)


def commits(path: str) -> list[dict]:
    """What each commit lists, in order of time."""
    fs, root = _file_system(path)
    names = sorted(i.path for i in fs.get_file_info(pf.FileSelector(f"{root}/_commits", allow_not_found=True)) if i.base_name.endswith(".json"))
    out = []
    for name in names:
        with fs.open_input_stream(name) as file:
            out.append(json.loads(file.read()))
    return out


def read_checked(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of one kind that commits list; rejected ones with their reason."""
    if kind not in KINDS:
        raise ValueError(f"no rows of kind {kind}")
    done = commits(path)
    if not done:
        raise ValueError(f"{path} has no commit")
    schema = StructType.fromJson(done[-1]["schemas"]["rejected"])
    schema = schema if kind == "rejected" else StructType([f for f in schema.fields if f.name != REASON])
    files = [f"{path.rstrip('/')}/{f}" for c in done for f in c["files"][kind]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def reasons(checks: dict[str, F.Column]) -> F.Column:
    """The first failed check's name; a check that is NULL fails."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()], F.lit(None).cast("string"))
