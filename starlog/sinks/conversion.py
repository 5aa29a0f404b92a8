"""A parquet copy of raw files that converts only what is new.

Files are converted in batches. A batch's rows are written first, with the file each comes from; then
the list of its files (path, size, time), whose completion makes the batch count. A run converts the
files that no finished batch lists as they are now, so an interrupted run is taken up at the batch it
was in, added files are added, and a changed file replaces the rows of its earlier form.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog.operators.joins import join_null_safe
from starlog.session import file_system
from starlog.sinks.files import write_parquet

SOURCE, BATCH = "_source_file", "_batch"
BATCH_NAME = re.compile(rf"{BATCH}=(\d+)")
LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField(BATCH, T.IntegerType()),
    ]
)


class ConvertedCopy:
    """The copy below `path`; a batch holds at most `files_per_batch` files, which bounds the list on the driver."""

    def __init__(self, spark: SparkSession, path: str, files_per_batch: int = 10_000):
        self.spark, self.path, self.files_per_batch = spark, path, files_per_batch

    def batches(self) -> list[int]:
        """The numbers of the finished batches, oldest first."""
        fs, location = file_system(self.spark, f"{self.path}/files")
        if not fs.exists(location):
            return []
        names = [BATCH_NAME.fullmatch(status.getPath().getName()) for status in fs.listStatus(location)]
        numbers = sorted(int(name[1]) for name in names if name)
        return [n for n in numbers if fs.exists(file_system(self.spark, f"{self._place('files', n)}/_SUCCESS")[1])]

    def _place(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/{BATCH}={batch}"

    def _read(self, kind: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.option("basePath", f"{self.path}/{kind}")
        places = [self._place(kind, n) for n in self.batches()]
        if not places:
            return self.spark.createDataFrame([], schema or f"{SOURCE} string, {BATCH} int")
        return (reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)).parquet(*places)

    def files(self) -> DataFrame:
        """(path, modified, size, batch) of every conversion, of a changed file more than one."""
        return self._read("files", LISTING)

    def pending(self, source: str, files: str = "*") -> DataFrame:
        """(path, modified, size) of the files that are not converted as they are now."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", files).load(source)
        found = found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
        return found.join(self.files().drop(BATCH), ["path", "modified", "size"], "left_anti")

    def convert(self, source: str, read: Callable[[list[str]], DataFrame], files: str = "*") -> int:
        """Convert the pending files below `source`, which `read` reads by their paths; returns how many there were."""
        converted = 0
        while chosen := self.pending(source, files).orderBy("path").limit(self.files_per_batch).collect():
            done = self.batches()
            batch = done[-1] + 1 if done else 1
            rows = read([row.path for row in chosen]).withColumn(SOURCE, F.col("_metadata.file_path"))
            write_parquet(rows, self._place("data", batch))
            write_parquet(self.spark.createDataFrame(chosen, LISTING.fieldNames()[:-1]).coalesce(1), self._place("files", batch))
            converted += len(chosen)
        return converted

    def read(self) -> DataFrame:
        """The rows of all files, each in the form it was last converted in."""
        rows = self._read("data")
        latest = self.files().groupBy("path").agg(F.max(BATCH).alias("latest"), F.count("*").alias("times"))
        # changed files alone, and in the form in which rows name their file
        changed = latest.where("times > 1").select(F.col("path").alias(SOURCE), "latest")
        met = join_null_safe(rows, changed, [SOURCE], "left")
        return met.where(F.col("latest").isNull() | (F.col("latest") == F.col(BATCH))).drop("latest", SOURCE, BATCH)
