"""Session settings, the shared work folder and small file-system helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: list[str] = []


def build_session(app: str = "tidemark", cores: str = "*", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the settings the package is tuned for.

    On a cluster the caller brings its own session; of the settings below only
    the UTC zone matters for results.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, named by the session; a new local one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _LOCAL_ROOT[0]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API for a location."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total length of the files below a path."""
    fs, target = hadoop_path(spark, path)
    return int(fs.getContentSummary(target).getLength())


def conf_bytes(spark: SparkSession, name: str, default: str) -> int:
    """A size among the session's settings, in bytes."""
    text = spark.conf.get(name, default).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
    digits = text.rstrip("bkmgt")
    return int(digits) * units.get(text[len(digits):], 1)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own bound for broadcast sides, in bytes; 0 when broadcasting is off."""
    return max(0, conf_bytes(spark, "spark.sql.autoBroadcastJoinThreshold", "10485760"))
