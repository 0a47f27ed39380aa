"""Helpers of the operators: Arrow maps over texts, the shared folder, bounded samples, free column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_OWN_ROOT: list[str] = []
#: Rows of one Arrow batch. Texts may be megabytes long, so batches are small.
BATCH_ROWS = 200


def session(spark: SparkSession) -> SparkSession:
    """Pin what results and memory depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table."""
    return session(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a new local one only in local mode without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN_ROOT:
        _OWN_ROOT.append(tempfile.mkdtemp(prefix="llm-"))
    return _OWN_ROOT[0]


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder (``options`` of the writer) and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of the frame has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns(names: Iterable[str]) -> list:
    return [F.col(quoted(n)) for n in names]


def map_texts(df: DataFrame, make: Callable[[], Callable[[Sequence], Sequence[Sequence]]], fields: Sequence[tuple[str, str]],
              keep: Sequence[str], inputs: Sequence[str] = ("text",)) -> DataFrame:
    """``keep`` columns plus new ``fields`` (name, DDL type), computed from the ``inputs`` columns in Arrow batches.

    ``make()`` runs once in a task and returns a function from the batch's input lists to one list per field. A
    task holds one batch at a time. A kept column with the name of a new field (in any case) gives way to it.
    """
    new = {n.lower() for n, _ in fields}
    keep = [c for c in keep if c.lower() not in new]
    out = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    new_types = [to_arrow_type(T._parse_datatype_string(t)) for _, t in fields]
    names = [f.name for f in out.fields]
    n_keep = len(keep)
    # other inputs travel behind the kept columns, under own names
    extra = [c for c in inputs if c not in keep]
    at = [list(keep).index(c) if c in keep else n_keep + extra.index(c) for c in inputs]
    src = df.select(*columns(keep), *[F.col(quoted(c)).alias(f"_in{i}") for i, c in enumerate(extra)])

    def run(batches):
        fn = make()
        for batch in batches:
            got = fn(*[batch.column(i).to_pylist() for i in at])
            arrays = [batch.column(i) for i in range(n_keep)] + [pa.array(v, t) for v, t in zip(got, new_types)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return src.mapInArrow(run, out)


def hash_sample(df: DataFrame, key: str, bound: int, seed: int = 7) -> DataFrame:
    """At most ``bound`` distinct keys with the smallest hashes: the same keys on every run, however large the table is."""
    h = F.xxhash64(F.col(quoted(key)).cast("string"), F.lit(seed))
    return df.where(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key))).distinct().orderBy(h, F.col(quoted(key))).limit(bound)


def is_held_out(key) -> F.Column:
    """Whether crc32 of the key as text is divisible by 5; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def ascii_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII bytes of a text, A-Z lower-cased, as UTF-8."""
    return [] if text is None else text.encode().translate(WORD_TABLE).split()


WORD_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
