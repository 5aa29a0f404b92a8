"""Counts, profiles and summary statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) rarest first; the NULL group counts 0, as count(column) does."""
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(column).alias("count"))
        .orderBy("count", F.col("value").asc_nulls_first())
    )


def profile_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Value counts of every column in one aggregation: (column, value, count)."""
    names = columns or df.columns
    texts = df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names])
    long = texts.unpivot([], names, "column", "value")
    return long.groupBy("column", "value").agg(F.count("value").alias("count"))


def count_nulls(df: DataFrame, columns: list[str], any_name: str = "any_null") -> DataFrame:
    """NULL count per column, and of rows with a NULL in any of them, in one pass."""
    nulls = [F.col(c).isNull() for c in columns]
    return df.agg(
        *[F.count_if(null).alias(f"{c}_nulls") for c, null in zip(columns, nulls)],
        F.count_if(reduce(lambda a, b: a | b, nulls)).alias(any_name),
    )


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, stddev, min and max per column, one row each; min and max as text.

    mean and stddev are NULL where the column does not read as a number.
    """
    parts = []
    for c in columns:
        column = F.col(f"`{c}`")
        number = column.try_cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(column).alias("count"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(column).cast("string").alias("min"),
                F.max(column).cast("string").alias("max"),
            )
        )
    return df.agg(F.array(*parts).alias("_parts")).select(F.inline("_parts"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table, rows)."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def key_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """How often each value occurs; partial counts are combined before the shuffle."""
    return lines.groupBy(column).agg(F.count("*").alias("count"))


def named_table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """One row per catalog table or view, by name: (table, rows)."""
    counts = [
        spark.sql("SELECT :name AS table, count(*) AS rows FROM IDENTIFIER(:name)", args={"name": name}) for name in names
    ]
    return reduce(DataFrame.unionByName, counts)
