"""One row per key, latest rows and distinct rows.

`row_number() = 1` and `rank() = 1` are planned with a per-task group limit before the shuffle,
so a hot key sends at most one row (or its ties) per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; all columns break ties after `order`."""
    ties = [F.col(f"`{name}`").asc_nulls_last() for name in df.columns if name not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def latest_rows(df: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """Distinct (key, columns) found at the key's greatest `at`, ties kept; NULL keys dropped.

    Equal rows collapse to their greatest `at` before the ranking, so the shuffle carries one row
    per distinct profile.
    """
    profiles = df.where(F.col(key).isNotNull()).groupBy(key, *columns).agg(F.max(at).alias("_at"))
    newest = Window.partitionBy(key).orderBy(F.col("_at").desc_nulls_last())
    return (
        profiles.withColumn("_rank", F.rank().over(newest))
        .where((F.col("_rank") == 1) & F.col("_at").isNotNull())
        .select(key, *columns)
    )


def first_and_last(
    df: DataFrame, key: str, order: list[str], first: list[str], last: list[str]
) -> DataFrame:
    """Per key the `first` columns as first seen and the `last` columns as last seen along `order`.

    Equal rows collapse to their first and last place before the per-key step.
    """
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    profiles = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, *first, *last)
        .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    )
    opening = F.min_by(F.struct(*first, *last), F.struct("_first", *first, *last))
    closing = F.max_by(F.struct(*first, *last), F.struct("_last", *first, *last))
    picked = profiles.groupBy(key).agg(opening.alias("_opening"), closing.alias("_closing"))
    return picked.select(
        key, *[F.col(f"_opening.{c}").alias(c) for c in first], *[F.col(f"_closing.{c}").alias(c) for c in last]
    )
