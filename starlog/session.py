"""Session settings and the shared folder for materialised intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "starlog", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the plans expect; `extra` keys use `__` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` as the cluster names it.

    Only a local session that names none gets a temporary folder, since there driver and
    executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="starlog-", dir="/tmp")
    return _local_folders[app]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/starlog-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds the path, and the path in its form."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application stored in the shared folder; its DataFrames are of no use after."""
    fs, location = file_system(spark, _scratch_root(spark))
    fs.delete(location, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute `df` once, as a table in the shared folder, and cut its lineage.

    Unlike a cached copy the table survives lost executors, and later steps read only the columns
    they use.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_shuffles(spark: SparkSession, path: str, growth: int = 4, partition_bytes: int = 128 << 20) -> int:
    """Raise `spark.sql.shuffle.partitions` to suit the size of the input below `path`.

    Files grow by about `growth` when decoded; adaptive execution merges what turns out too small.
    A larger setting is left alone. Returns the setting in force.
    """
    fs, location = file_system(spark, path)
    needed = fs.getContentSummary(location).getLength() * growth // partition_bytes
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return max(needed, current)
