"""Topics of landed messages as a streaming data source of its own: positions per topic, a bound per run, acknowledgement on commit.

A topic is a folder of message files ``<first position>-<last position>.parquet`` with the columns position, and whatever the
messages carry. Offsets are positions per topic, so a run may stop inside a file. A run goes on from the positions that the destination
committed with its rows (``start``). Spark calls ``commit`` when a batch is safely in the sink, at the latest in the next run: only then
are its positions acknowledged, in one small file, and the broker may forget the messages up to there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "landed_topics"
_WIDTH = 20


def land(messages: DataFrame, path: str, topic: str, position: str, per_file: int = 50_000) -> None:
    """Write messages as topic folders (the side of the broker): files of at most ``per_file`` consecutive positions, named by the positions they may hold.

    Messages without a topic or position cannot be addressed: an error.
    """
    wanted = F.col(topic).isNotNull() & F.col(position).isNotNull()
    checked = messages.where(F.when(~wanted, F.raise_error(F.lit("message without topic or position")).cast("boolean")).otherwise(F.lit(True)))
    first = F.floor(F.col(position) / per_file) * per_file
    span = F.concat_ws("-", F.lpad(first.cast("string"), _WIDTH, "0"), F.lpad((first + per_file - 1).cast("string"), _WIDTH, "0"))
    rows = checked.select(F.col(topic).alias("_topic"), span.alias("_span"), F.col(position).cast("bigint").alias("position"), *[c for c in messages.columns if c not in (topic, position)])
    rows.repartition("_topic", "_span").sortWithinPartitions("_topic", "_span", "position").write.mode("append").partitionBy("_topic", "_span").parquet(path)


def _file_system(path: str) -> tuple[pf.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pf.LocalFileSystem(), path) if path.startswith("/") else pf.FileSystem.from_uri(path)


class Span(InputPartition):
    """Positions ``low`` (exclusive) to ``high`` (inclusive) of one topic, inside one folder of files."""

    def __init__(self, topic: str, folder: str, low: int, high: int):
        super().__init__((topic, folder, low, high))
        self.topic, self.folder, self.low, self.high = topic, folder, low, high


class TopicReader(DataSourceStreamReader):
    """Offsets are {topic: last position read}; a batch takes at most ``max_per_topic`` messages of each topic."""

    def __init__(self, options: dict, schema: StructType):
        self.path = options["path"]
        self.schema = schema
        self.limit = int(options.get("max_per_topic", "1000"))
        self.acks = options.get("acks")
        self.topics = [t for t in options.get("topics", "").split(",") if t]
        self.at: dict[str, int] = json.loads(options.get("start", "{}"))

    def _spans(self) -> dict[str, list[tuple[int, int, str]]]:
        """For each topic its (first, last, folder), in order; names only, no file is opened."""
        fs, root = _file_system(self.path)
        found: dict[str, list[tuple[int, int, str]]] = {}
        for info in fs.get_file_info(pf.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith("_topic="):
                topic = info.base_name.split("=", 1)[1]
                if not self.topics or topic in self.topics:
                    for part in fs.get_file_info(pf.FileSelector(info.path)):
                        if part.base_name.startswith("_span="):
                            low, high = part.base_name.split("=", 1)[1].split("-")
                            found.setdefault(topic, []).append((int(low), int(high), part.path))
        return {t: sorted(v) for t, v in sorted(found.items())}

    def _after(self, at: int, spans: Sequence[tuple[int, int, str]]) -> int:
        """The ``limit``-th message position after one, or the last there is. Reads the positions of a file more than these at most."""
        left = self.limit
        for _, high, folder in spans:
            if high > at and left > 0:
                fs, _ = _file_system(self.path)
                found = ds.dataset(folder, filesystem=fs, format="parquet").to_table(columns=["position"], filter=pc.field("position") > at)["position"]
                taken = pc.array_sort_indices(found)[:left]
                if len(taken):
                    at, left = found[taken[-1].as_py()].as_py(), left - len(taken)
        return at

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's names
        return {t: self.at.get(t, -1) for t in self._spans()}

    def latestOffset(self) -> dict:  # noqa: N802
        """At most ``limit`` messages beyond those planned last, for each topic."""
        return self.at | {topic: self._after(self.at.get(topic, -1), spans) for topic, spans in self._spans().items()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = {t: max(p, end.get(t, -1)) for t, p in {**end, **self.at}.items()}
        return [Span(t, folder, max(start.get(t, -1), low - 1), min(end[t], high))
                for t, spans in self._spans().items() for low, high, folder in spans if t in end and high > start.get(t, -1) and low <= end[t]]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        fs, _ = _file_system(self.path)
        want = to_arrow_schema(self.schema)
        data = ds.dataset(partition.folder, filesystem=fs, format="parquet")
        inside = (pc.field("position") > partition.low) & (pc.field("position") <= partition.high)
        for batch in data.to_batches(columns=[n for n in want.names if n != "topic"], filter=inside, batch_size=10_000):
            columns = [pa.array([partition.topic] * batch.num_rows) if n == "topic" else batch.column(n) for n in want.names]
            if batch.num_rows:
                yield pa.Table.from_arrays(columns, want.names).cast(want).to_batches()[0]

    def commit(self, end: dict) -> None:
        """The batch is in the sink: its positions are acknowledged."""
        if self.acks:
            write_acks(self.acks, end)


def read_acks(path: str) -> dict[str, int]:
    """Acknowledged positions by topic."""
    fs, root = _file_system(path)
    names = sorted(i.path for i in fs.get_file_info(pf.FileSelector(root, allow_not_found=True)) if i.base_name.endswith(".json"))
    if not names:
        return {}
    with fs.open_input_stream(names[-1]) as file:
        return json.loads(file.read())


def write_acks(path: str, positions: dict[str, int]) -> None:
    """Acknowledge positions; what was acknowledged further stays."""
    fs, root = _file_system(path)
    fs.create_dir(root, recursive=True)
    done = read_acks(path)
    done |= {t: max(p, done.get(t, -1)) for t, p in positions.items()}
    names = [int(i.base_name[:-5]) for i in fs.get_file_info(pf.FileSelector(root)) if i.base_name.endswith(".json")]
    with fs.open_output_stream(f"{root}/{max(names, default=0) + 1:010d}.json") as file:
        file.write(json.dumps(done, sort_keys=True).encode())


class TopicSource(DataSource):
    """Options: path, topics (comma-joined; all without), max_per_topic, start (JSON of positions to go on from), acks (folder of acknowledged positions)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "topic string, position bigint"

    def streamReader(self, schema: StructType) -> TopicReader:  # noqa: N802
        return TopicReader(dict(self.options), schema)


def topic_stream(spark: SparkSession, path: str, columns: str, acks: str, max_per_topic: int = 1000, topics: Sequence[str] = (),
                 start: dict[str, int] | None = None) -> DataFrame:
    """A stream over landed topics: topic, position and ``columns`` (DDL of the rest)."""
    spark.dataSource.register(TopicSource)
    schema = "topic string, position bigint" + (f", {columns}" if columns else "")
    return (spark.readStream.format(FORMAT).schema(schema).option("max_per_topic", max_per_topic).option("acks", acks)
            .option("topics", ",".join(topics)).option("start", json.dumps(start or {})).load(path))
