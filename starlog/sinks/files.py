"""Parquet, CSV and JSON writers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.operators.joins import join_null_safe
from starlog.session import file_system
from starlog.sinks.co_located import SHARE, SHARES, shares_of
from starlog.sinks.directories import writable, write_directories


def write_parquet(df: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write parquet, optionally in one directory per value of the `by` columns.

    Rows are rebalanced on those columns, so a small partition is written as one file while
    adaptive execution splits a large one over several tasks and files.
    """
    if by:
        df.hint("rebalance", *by).write.partitionBy(*by).mode(mode).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_small_directories(df: DataFrame, path: str, by: tuple[str, ...], hot_rows: int = 1_000_000) -> None:
    """Write parquet in one directory per value of the `by` columns, where directories are many and hold few rows.

    The time goes into opening files, which adaptive execution knows nothing of: by their bytes it would merge all into one
    task. So the directories are dealt to `spark.sql.shuffle.partitions` tasks; one of more than `hot_rows` rows to several.
    In a mounted folder the tasks' workers make the files, elsewhere Spark's writer does.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = join_null_safe(df, shares_of(df, list(by), hot_rows), list(by), "left")
    share = F.pmod(F.xxhash64(*df.columns, F.monotonically_increasing_id()), F.coalesce(SHARES, F.lit(1)))
    dealt = shared.withColumn(SHARE, share).drop(SHARES)
    if writable(df.drop(*by), path):
        write_directories(dealt, path, list(by), tasks, [SHARE])
    else:
        dealt.repartition(tasks, *by, SHARE).drop(SHARE).write.partitionBy(*by).mode("overwrite").parquet(path)


def write_sorted(df: DataFrame, path: str, order: list[str]) -> None:
    """Write parquet in the given order over all files, so that a look-up reads few of them.

    Make the order long enough to cut the rows of a hot leading value apart.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_once(df: DataFrame, path: str) -> None:
    """Write parquet unless the path already holds a finished copy; what an interrupted write left is replaced."""
    fs, done = file_system(df.sparkSession, f"{path}/_SUCCESS")
    if not fs.exists(done):
        write_parquet(df, path)


def stage(df: DataFrame, template: str, run_time: datetime, **names: str) -> str:
    """Full refresh of a staged copy; the path template is filled from the run time and names.

    For example "staging/{execution_date:%Y}/{execution_date:%m}/{table}".
    """
    path = template.format(execution_date=run_time, **names)
    write_parquet(df, path)
    return path


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated rows with header, NULL as empty."""
    (
        df.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", "")
        .option("escape", "\\")
        .csv(path)
    )


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """CSV with header, every field quoted and quotes inside a field doubled."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def materialise_as(df: DataFrame, path: str, view: str) -> DataFrame:
    """Write a result, replacing an earlier one, and name it for SQL."""
    write_parquet(df, path)
    spark: SparkSession = df.sparkSession
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(view)
    return table
