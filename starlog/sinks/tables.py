"""Parquet tables that are appended to by key or replaced as a whole."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.operators.dedupe import first_and_last, first_row_per_key
from starlog.operators.filters import without_nulls
from starlog.operators.joins import join_null_safe
from starlog.session import file_system
from starlog.sinks.bucketed import BucketedTable
from starlog.sinks.files import write_parquet


FINISHED = "_FINISHED"
VERSION = re.compile(r"v(\d+)")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = file_system(spark, path)
    return fs.exists(location)


def _held(batch: DataFrame, path: str) -> DataFrame | None:
    """The table in the batch's columns, None when there is no table yet."""
    spark = batch.sparkSession
    if path_exists(spark, path):
        return spark.read.schema(batch.schema).parquet(path)
    return None


class VersionedTable:
    """A parquet table replaced as a whole: each version is a directory, the newest finished one counts.

    A reader keeps the version it started with, and a failed write leaves the table as it was.
    The `keep` newest versions stay on disk for such readers.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark = spark
        self.path = path
        self.keep = keep

    def _version_path(self, number: int) -> str:
        return f"{self.path}/v{number:08d}"

    def versions(self) -> list[int]:
        """Numbers of the finished versions, oldest first."""
        fs, location = file_system(self.spark, self.path)
        if not fs.exists(location):
            return []
        names = [VERSION.fullmatch(status.getPath().getName()) for status in fs.listStatus(location)]
        numbers = sorted(int(name[1]) for name in names if name)
        return [n for n in numbers if path_exists(self.spark, f"{self._version_path(n)}/{FINISHED}")]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self._version_path(self.versions()[-1]))

    def _claim(self, number: int) -> int:
        """The first number from here on that no other writer has taken; a claim is a file that only one can create."""
        while True:
            fs, claim = file_system(self.spark, f"{self.path}/_claim-{number:08d}")
            if not fs.exists(claim):
                try:
                    fs.create(claim, False).close()
                    return number
                except Py4JJavaError:
                    if not fs.exists(claim):
                        raise
            number += 1

    def begin(self) -> int:
        """Claim the number of a new version."""
        done = self.versions()
        return self._claim(done[-1] + 1 if done else 1)

    def finish(self, number: int) -> None:
        """Let the version count from now on, and delete those before the `keep` newest."""
        fs, marker = file_system(self.spark, f"{self._version_path(number)}/{FINISHED}")
        fs.create(marker).close()
        for old in self.versions()[: -self.keep]:
            fs, location = file_system(self.spark, self._version_path(old))
            fs.delete(location, True)

    def replace(self, df: DataFrame) -> None:
        number = self.begin()
        write_parquet(df, self._version_path(number))
        self.finish(number)

    def add(self, df: DataFrame) -> None:
        """Append rows to the newest version."""
        if self.exists():
            write_parquet(df, self._version_path(self.versions()[-1]), mode="append")
        else:
            self.replace(df)


class VersionedTables(VersionedTable):
    """Several tables whose versions change over together: one directory of each below that of the version."""

    def place(self, number: int, name: str) -> str:
        return f"{self._version_path(number)}/{name}"

    def write(self, number: int, name: str, df: DataFrame) -> None:
        """Write a table of a version that is not finished."""
        write_parquet(df, self.place(number, name))

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """A table of the newest or the given version."""
        return self.spark.read.parquet(self.place(self.versions()[-1] if number is None else number, name))


def load_dimension(df: DataFrame, table: VersionedTable, clear: bool = False) -> None:
    """Replace the table's rows or add to them; a failed replacement leaves them as they were."""
    if clear:
        table.replace(df)
    else:
        table.add(df)


def _touched(target: DataFrame, batch: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """The target partitions in the range of the batch's partition values.

    One row of bounds reaches the driver, so that the partitions are pruned when files are listed.
    """
    if not within:
        return target
    bounds = batch.agg(
        *[F.min(c).alias(f"min_{c}") for c in within],
        *[F.max(c).alias(f"max_{c}") for c in within],
    ).first()
    for c in within:
        low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
        target = target.where(F.col(c).between(F.lit(low), F.lit(high)) | F.col(c).isNull())
    return target


def rows_with_new_keys(
    batch: DataFrame, target: DataFrame, keys: list[str], within: tuple[str, ...] = ()
) -> DataFrame:
    """Batch rows whose key the target does not hold (NULL is a key value); repeated keys all stay.

    `within` names partition columns that a key determines; only the target partitions the batch
    touches are then read.
    """
    return join_null_safe(batch, _touched(target, batch, within).select(*keys), keys, "left_anti")


def first_rows_with_new_keys(
    batch: DataFrame, target: DataFrame | None, keys: list[str], order: list[Column], within: tuple[str, ...] = ()
) -> DataFrame:
    """As `rows_with_new_keys`, with one row per key, the first by `order`; NULL keys are dropped."""
    first = first_row_per_key(without_nulls(batch, keys), keys, order)
    if target is None:
        return first
    return first.join(_touched(target, batch, within).select(*keys), keys, "left_anti")


def append_new(batch: DataFrame, path: str, keys: list[str], by: tuple[str, ...] = ()) -> None:
    """Append the rows whose key the table lacks, so a batch that is loaded again adds nothing."""
    held = _held(batch, path)
    fresh = batch if held is None else rows_with_new_keys(batch, held, keys, by)
    write_parquet(fresh, path, by, mode="append")


def insert_if_absent(
    batch: DataFrame, path: str, keys: list[str], order: list[Column], by: tuple[str, ...] = ()
) -> None:
    """Append one row per key the table lacks, the first by `order`."""
    fresh = first_rows_with_new_keys(batch, _held(batch, path), keys, order, by)
    write_parquet(fresh, path, by, mode="append")


def upserted(batch: DataFrame, target: DataFrame | None, key: str, order: list[str], replaced: list[str]) -> DataFrame:
    """Target after the batch: known keys take the batch's last `replaced` values, new keys come whole.

    Of a new key the other columns are the first seen along `order`.
    """
    kept = [c for c in (target if target is not None else batch).columns if c not in [key, *replaced, *order]]
    news = first_and_last(batch, key, order, kept, replaced)
    if target is None:
        return news
    news = news.withColumnsRenamed({c: f"_new_{c}" for c in [*kept, *replaced]}).withColumn("_new", F.lit(True))
    joined = target.withColumn("_old", F.lit(True)).join(news, key, "full_outer")
    return joined.select(
        key,
        *[F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c) for c in kept],
        *[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in replaced],
    )


def upsert(batch: DataFrame, table: BucketedTable, order: list[str], replaced: list[str]) -> list[int]:
    """Apply `upserted` to the buckets of the table that the batch's keys lie in; returns these buckets."""
    return table.apply(batch, lambda rows, held: upserted(rows, held, table.key, order, replaced))
