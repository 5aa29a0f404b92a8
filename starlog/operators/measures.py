"""Quality measures kept per partition of a parquet table, so that a check reads only partitions that changed.

For every partition directory the rows, rows with a NULL in a required column, repeated keys, and each
column's NULLs, least and greatest value are kept beside a fingerprint of its files (names, sizes, times).
All of them add up over partitions. A refresh lists the files, measures the partitions whose fingerprint
is new, and forgets those that are gone; checks and totals are then made of the kept measures alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.operators.quality import _check
from starlog.session import materialise
from starlog.sinks.tables import VersionedTable

PARTITION, FILES, FILE = "_partition", "_files", "_measured_file"


def _partition(path: Column) -> Column:
    """The name=value directories at the end of a file's path."""
    return F.rtrim(F.regexp_extract(path, r"((?:[^/=]+=[^/]*/)*)[^/]*$", 1), F.lit("/"))


class PartitionMeasures:
    """Measures of the table at `path`, kept below `store`.

    `columns` are measured one by one; `required` must hold no NULL; rows of one `key` must lie in one
    partition, as they do where the partition columns are part of it.
    """

    def __init__(
        self, spark: SparkSession, path: str, store: str, columns: list[str], required: list[str] = (), key: list[str] = ()
    ):
        self.spark, self.path = spark, path
        self.columns, self.required, self.key = list(columns), list(required), list(key)
        self.kept = VersionedTable(spark, store)

    def _files(self) -> DataFrame:
        """(partition, fingerprint) of the partitions as they are now; the root is a partition without a name."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        listed = files.load(self.path).select("path", "length", "modificationTime")
        states = F.sort_array(F.collect_list(F.xxhash64("path", "length", "modificationTime")))
        return listed.groupBy(_partition(F.col("path")).alias(PARTITION)).agg(F.xxhash64(states).alias(FILES))

    def _measured(self, changed: DataFrame) -> DataFrame:
        """Measures of the changed partitions, whose names reach the driver for the reader."""
        places = [f"{self.path}/{row[0]}".rstrip("/") for row in changed.select(PARTITION).collect()]
        rows = self.spark.read.option("basePath", self.path).parquet(*places)
        rows = rows.withColumn(FILE, F.col("_metadata.file_path")).drop(PARTITION)
        null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.required], F.lit(False))
        parts = {"rows": (F.count("*"), F.sum), "null_rows": (F.count_if(null), F.sum)}
        for at, c in enumerate(self.columns):
            nulls = F.count_if(F.col(c).isNull())
            parts |= {f"nulls_{at}": (nulls, F.sum), f"low_{at}": (F.min(c), F.min), f"high_{at}": (F.max(c), F.max)}
        # measured by file and stored, so that the partition is cut out of a path once a file and not once a row
        by_file = rows.groupBy(FILE).agg(*[found.alias(name) for name, (found, _) in parts.items()])
        by_file = materialise(by_file.withColumn(PARTITION, _partition(F.col(FILE))))
        measured = by_file.groupBy(PARTITION).agg(*[total(name).alias(name) for name, (_, total) in parts.items()])
        if self.key:
            keyed = rows.join(by_file.select(FILE, PARTITION), FILE)
            again = keyed.groupBy(PARTITION, *self.key).count().where("count > 1").groupBy(PARTITION).agg(F.count("*").alias("repeated"))
            measured = measured.join(again, PARTITION, "left").fillna(0, ["repeated"])
        else:
            measured = measured.withColumn("repeated", F.lit(0).cast("bigint"))
        return measured.join(changed, PARTITION)

    def refresh(self) -> list[str]:
        """Measure what changed and forget what is gone; returns the names of the partitions that were read."""
        now = materialise(self._files())
        if not self.kept.exists():
            if not now.isEmpty():
                self.kept.replace(self._measured(now))
            return sorted(row[0] for row in now.select(PARTITION).collect())
        known = self.kept.read()
        changed = materialise(now.join(known, [PARTITION, FILES], "left_anti"))
        read = sorted(row[0] for row in changed.select(PARTITION).collect())
        same = known.join(now, [PARTITION, FILES], "left_semi")
        fresh = same.unionByName(self._measured(changed)) if read else same
        self.kept.replace(fresh)
        return read

    def totals(self) -> DataFrame:
        """(column, rows, nulls, low, high as text) over all partitions, from the kept measures."""
        kept = self.kept.read()
        parts = [
            F.struct(
                F.lit(c).alias("column"),
                F.sum("rows").alias("rows"),
                F.sum(f"nulls_{at}").alias("nulls"),
                F.min(f"low_{at}").cast("string").alias("low"),
                F.max(f"high_{at}").cast("string").alias("high"),
            )
            for at, c in enumerate(self.columns)
        ]
        return kept.agg(F.array(*parts).alias("found")).select(F.inline("found"))

    def checks(self, name: str) -> DataFrame:
        """The row count, NULL and key checks of the table, as `quality` makes them, from the kept measures."""
        kept = self.kept.read()

        def total(column: str) -> DataFrame:
            return kept.agg(F.coalesce(F.sum(column), F.lit(0)).alias("measured"))

        found = [_check(total("rows"), "row_count", name, ">", 0)]
        if self.required:
            found.append(_check(total("null_rows"), "no_nulls", f"{name}({', '.join(self.required)})", "=", 0))
        if self.key:
            found.append(_check(total("repeated"), "unique_key", f"{name}({', '.join(self.key)})", "=", 0))
        return reduce(DataFrame.unionByName, found)
