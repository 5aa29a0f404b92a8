"""Layouts of stored tables: shared buckets, one copy for three questions, measures per partition."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from starlog.operators import measures, quality
from starlog.operators.measures import PartitionMeasures
from starlog.plans import events
from starlog.sinks.co_located import SHARE, join_co_located, write_co_located
from starlog.sinks.files import write_parquet, write_small_directories
from test_skew import settings

KEYS = ["port", "day"]


@pytest.fixture
def co_located(spark, path):
    n = F.col("id")
    left = spark.range(6000).select(
        F.when(n % 2 == 0, "hot").when(n % 41 == 0, None).otherwise(F.concat(F.lit("p"), n % 37)).alias("port"),
        F.when(n % 2 == 0, 1).otherwise(n % 5).cast("int").alias("day"),
        n.alias("arrival"),
    )
    right = spark.createDataFrame(
        [("hot", 1, 1.5), ("hot", 1, 2.5), ("p1", 1, 3.5), ("p3", 0, 4.5), (None, 1, 5.5), ("none", 1, 6.5)], "port string, day int, t double"
    )
    names = ("layout_left", "layout_right")
    write_co_located(left, right, KEYS, names, path, buckets=8, hot_rows=200)
    yield left, right, names
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shared_buckets_join_without_an_exchange(spark, co_located, how):
    left, right, names = co_located
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        joined = join_co_located(spark, names, KEYS, how)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(map(str, rows)) == sorted(map(str, left.join(right, KEYS, how).collect()))


def test_a_hot_key_is_cut_over_buckets(spark, co_located, path):
    _, _, names = co_located
    hot = spark.table(names[0]).where("port = 'hot'")
    shares = {r[SHARE]: r["count"] for r in hot.groupBy(SHARE).count().collect()}
    assert len(shares) == 15 and max(shares.values()) < 2 * 200
    assert hot.select(F.col("_metadata.file_name")).distinct().count() > 4
    assert spark.table(names[1]).where("port = 'hot'").count() == 30 and spark.table(names[1]).where("port = 'p1'").count() == 1
    with pytest.raises(ValueError):
        join_co_located(spark, names, KEYS, "full")


def scans(plan):
    """The file scans of an executed plan."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(plan.plan())
    children = plan.children()
    below = [scan for at in range(children.size()) for scan in scans(children.apply(at))]
    return below + [plan] * (name == "FileSourceScanExec")


def rows_read(df):
    """Rows that the scan of an executed plan put out, before its filter."""
    df.collect()
    [scan] = scans(df._jdf.queryExecution().executedPlan())
    return scan.metrics().get("numOutputRows").get().value()


def test_one_copy_serves_three_questions(spark, path):
    n = F.col("id")
    frame = spark.range(60_000).select(
        F.sha2(n.cast("string"), 256).alias("artist"),
        F.concat(F.lit("Song "), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("song"),
        F.sha2((n % 7919).cast("string"), 256).alias("userId"),
        (n % 7919).cast("int").alias("sessionId"),
        (n % 11).cast("int").alias("itemInSession"),
        F.lit("x").alias("firstName"), F.lit("y").alias("lastName"), F.lit(1.0).alias("length"),
    )
    events.write_access_table(frame, path, group_bytes=64 << 10, values=1000)
    table = spark.read.parquet(path)
    asked = {
        "session": (events.session_item(table, 801, 3), events.session_item(frame, 801, 3)),
        "song": (events.song_listeners(table, "Song 77"), events.song_listeners(frame, "Song 77")),
        "user": (table.where(F.col("userId") == F.sha2(F.lit("801"), 256)), frame.where(F.col("userId") == F.sha2(F.lit("801"), 256))),
    }
    for question, (stored, want) in asked.items():
        assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect())), question
        assert 0 < rows_read(stored) < 60_000 / 3, question


def orders(spark, low, high):
    n = F.col("id")
    return spark.range(low, high).select(
        n.alias("k"), F.when(n % 10 == 3, None).otherwise(n * 2).alias("v"), F.concat(F.lit("t"), n % 4).alias("t"), (n % 5).cast("int").alias("p")
    )


def totals(df):
    return {r.column: (r.rows, r.nulls, r.low, r.high) for r in df.collect()}


def test_only_changed_partitions_are_measured(spark, path):
    table = f"{path}/t"
    write_parquet(orders(spark, 0, 100), table, by=("p",))
    kept = PartitionMeasures(spark, table, f"{path}/m", ["k", "v", "t"], ["k", "v"], ["p", "k"])
    assert kept.refresh() == [f"p={i}" for i in range(5)] and kept.refresh() == []
    assert totals(kept.totals()) == {"k": (100, 0, "0", "99"), "v": (100, 10, "0", "198"), "t": (100, 0, "t0", "t3")}
    write_parquet(orders(spark, 0, 1000).where("p = 2 AND k >= 900"), table, by=("p",), mode="append")
    assert kept.refresh() == ["p=2"]
    assert totals(kept.totals())["k"] == (120, 0, "0", "997")
    write_parquet(orders(spark, 97, 98), table, by=("p",), mode="append")  # a repeated key, and another partition's rows go
    shutil.rmtree(f"{table}/p=3")
    assert kept.refresh() == ["p=2"]
    stored = spark.read.parquet(table)
    assert totals(kept.totals())["k"] == (stored.count(), 0, "0", "997")
    want = [
        quality.row_count("t", stored), quality.no_nulls("t", stored, ["k", "v"]), quality.unique_key("t", stored, ["p", "k"]),
    ]
    assert sorted(map(tuple, kept.checks("t").collect())) == sorted(map(tuple, quality.run_checks(want).collect()))
    assert [r.passed for r in kept.checks("t").collect()] == [True, True, False]


def test_partitions_are_told_once_a_file(spark, path, monkeypatch):
    told = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def directory(file):
        told.add(1)
        return file.split("/")[-2]

    write_parquet(orders(spark, 0, 1000), f"{path}/t", by=("p",))
    kept = PartitionMeasures(spark, f"{path}/t", f"{path}/m", ["k"], [], ["p", "k"])
    monkeypatch.setattr(measures, "_partition", directory)
    assert kept.refresh() == [f"p={i}" for i in range(5)]
    assert totals(kept.totals()) == {"k": (1000, 0, "0", "999")}
    assert told.value < 100  # and not for each of the rows


def test_measures_of_a_table_without_partitions(spark, path):
    orders(spark, 0, 10).coalesce(1).write.parquet(f"{path}/t")
    kept = PartitionMeasures(spark, f"{path}/t", f"{path}/m", ["k"])
    assert kept.refresh() == [""] and kept.refresh() == []
    orders(spark, 10, 30).write.mode("append").parquet(f"{path}/t")
    assert kept.refresh() == [""] and totals(kept.totals()) == {"k": (30, 0, "0", "29")}
    assert os.path.isdir(f"{path}/m")


def test_small_directories_are_dealt_to_many_tasks(spark, path):
    n = F.col("id")
    songs = spark.range(120).select(n, (n % 6).cast("int").alias("year"), F.when(n % 40 > 0, n % 40).alias("artist"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="true"):
        write_small_directories(songs, f"{path}/all", ("year", "artist"))
    assert len({name[:10] for _, _, names in os.walk(f"{path}/all") for name in names if name.startswith("part-")}) > 4
    assert sorted(map(str, spark.read.parquet(f"{path}/all").collect())) == sorted(map(str, songs.collect()))
    write_small_directories(songs, f"{path}/hot", ("year",), hot_rows=5)
    assert len([name for name in os.listdir(f"{path}/hot/year=3") if name.startswith("part-")]) > 1
    assert spark.read.parquet(f"{path}/hot").count() == 120
