"""Two tables stored in the same buckets of a key, so that they join without moving a row.

Both are written as catalog tables bucketed and sorted by the key and a share number. A key with more
than `hot_rows` rows of the left table is cut into shares: its left rows are dealt to them, and the right rows of
that key stand in each. All other keys have one share. The shares are worked out once, when the tables are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.operators.joins import join_null_safe
from starlog.session import materialise

SHARE, SHARES = "_share", "_shares"


def shares_of(left: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """(keys, shares) of the keys with more than `hot_rows` rows: no more than the rows divided by that."""
    counts = left.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    return materialise(counts.select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias(SHARES)))


def _write(df: DataFrame, name: str, path: str, by: list[str], buckets: int) -> None:
    # one task writes one bucket, so that a bucket is one file
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).mode("overwrite").option("path", path).saveAsTable(name)


def write_co_located(
    left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str], path: str, buckets: int = 64, hot_rows: int = 1_000_000
) -> None:
    """Store both tables below `path` under the catalog `names`, in buckets of the keys and their shares."""
    hot = shares_of(left, keys, hot_rows)
    one = F.coalesce(SHARES, F.lit(1))
    dealt = F.pmod(F.xxhash64(*left.columns, F.monotonically_increasing_id()), one).cast("int")
    left = join_null_safe(left, hot, keys, "left").withColumn(SHARE, dealt).drop(SHARES)
    every = F.explode(F.sequence(F.lit(0), one - 1))
    right = join_null_safe(right, hot, keys, "left").withColumn(SHARE, every).drop(SHARES)
    for df, name in zip((left, right), names):
        _write(df, name, f"{path}/{name}", [*keys, SHARE], buckets)


def join_co_located(spark: SparkSession, names: tuple[str, str], keys: list[str], how: str = "left") -> DataFrame:
    """The stored tables joined on the keys (NULL matches nothing), bucket by bucket; a left or inner join."""
    if how not in ("left", "inner"):
        raise ValueError("rows of the right table stand in several shares, so only left and inner joins are right")
    left, right = (spark.table(name) for name in names)
    return left.join(right, [*keys, SHARE], how).drop(SHARE)
