"""A key that holds most rows is cut over several tasks, and results stay whole."""

import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from starlog.operators import windows as win
from starlog.operators.dedupe import first_row_per_key, latest_rows
from starlog.operators.joins import keep_listed, lookup_at_most_one
from starlog.plans import star
from starlog.sinks.files import write_parquet


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "32k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 plays of which half are one user's and hear one song, from eight tasks."""
    n = F.col("id")
    return (
        spark.range(20_000, numPartitions=8)
        .select(
            n.alias("event"),
            F.when(n % 2 == 0, "hot").otherwise((n % 997).cast("string")).alias("userId"),
            F.when(n % 2 == 0, "Hit").otherwise(F.concat(F.lit("Song "), n % 997)).alias("song"),
            F.lit("NextSong").alias("page"),
            (1541103205811 + n * 1000).alias("ts"),
        )
        .cache()
    )


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_a_hot_group_are_even(hot):
    sizes = [r.n for r in win.ordered_blocks(hot, ["userId"], ["event"]).groupBy("_block").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8


def test_hot_user_keeps_whole_running_totals(hot):
    out = win.running_rows(hot, ["userId"], ["event"], "event").where("userId = 'hot'")
    assert out.agg(F.max("rows"), F.max("total")).first() == (10_000, sum(range(0, 20_000, 2)))


def test_first_and_latest_rows_shrink_before_the_shuffle(hot):
    first = executed(first_row_per_key(hot, ["userId"], [F.col("ts").asc()]))
    assert "row_number(), 1, Partial" in first
    newest = latest_rows(hot, "userId", "ts", ["song"])
    assert "rank(_at" in executed(newest) and newest.where("userId = 'hot'").count() == 1


def wide(hot):
    return hot.withColumn("pad", F.sha2(F.col("event").cast("string"), 512))


def test_skewed_lookup_is_split(spark, hot):
    songs = spark.range(997).select(F.concat(F.lit("Song "), "id").alias("song"), F.col("id").cast("string").alias("song_id"))
    songs = songs.unionByName(spark.createDataFrame([("Hit", "H2"), ("Hit", "H1")], songs.schema))
    with settings(spark, **SMALL):
        out = lookup_at_most_one(wide(hot), songs, ["song"], [F.col("song_id").asc()], ["song_id"])
        assert "skew=true" in executed(out)
        assert out.count() == 20_000 and out.where("song_id = 'H1'").count() == 10_000


def test_joins_back_to_rows_are_split(spark, hot):
    with settings(spark, **SMALL):
        by_song = wide(hot).withColumn("n", F.when(F.col("song") == "Hit", 0).otherwise(F.col("event")))
        assert "skew=true" in executed(win.group_totals(by_song, ["userId"], "event"))
        assert "skew=true" in executed(win.running_range_stats(by_song, ["page"], "n", "event"))
        assert "skew=true" in executed(win.ranks(by_song, ["page"], "n"))


def test_semi_join_and_song_lookup_are_split(spark, hot):
    with settings(spark, **SMALL):
        codes = hot.select(F.col("userId").alias("code"))
        assert "skew=true" in executed(keep_listed(wide(hot), codes.distinct(), "userId"))
        songs = wide(hot).select(
            F.col("event").alias("song_id"), F.col("pad").alias("title"), F.lit(1.0).alias("duration"),
            F.col("userId").alias("artist_id"), F.lit("n").alias("artist_name"),
        )
        one = first_row_per_key(songs.select("artist_id", "artist_name"), ["artist_id"], [])
        assert "skew=true" in executed(star.song_lookup(songs, one))


def test_hot_partition_is_written_by_several_tasks(spark, hot, path):
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k"):
        padded = hot.withColumn("pad", F.sha2(F.col("event").cast("string"), 512))
        write_parquet(padded.select("event", "pad", F.col("userId").isin("hot").alias("p")), path, by=("p",))
    files = [f for f in os.listdir(f"{path}/p=true") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(path).count() == 20_000


def test_plays_of_a_hot_artist_stay_whole(spark, hot):
    log = hot.select(
        "page", "ts", "userId", F.col("song").alias("artist"), F.lit("free").alias("level"), F.lit(1).alias("sessionId"),
        F.lit("x").alias("location"), F.lit("y").alias("userAgent"),
    )
    songs = spark.createDataFrame([("S1", "A1", "Hit"), ("S2", "A1", "Hit"), ("S3", "A2", "Song 1")], "song_id string, artist_id string, artist_name string")
    with settings(spark, **SMALL):
        assert star.plays_by_artist(log, songs).groupBy("artist_id").count().where("artist_id = 'A1'").first()["count"] == 20_000


def test_pieces_of_a_hot_list_are_spread(spark, hot):
    rows, pieces = win.factorised_lists(hot, ["userId"], ["event"], "event", piece_rows=500)
    of_hot = pieces.where("userId = 'hot'")
    assert of_hot.count() == 20 and of_hot.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    lists = win.expand_lists(rows.where("userId = 'hot' AND event % 1000 = 0"), pieces, ["userId"], piece_rows=500)
    sizes = {r.event: r.n for r in lists.groupBy("event").agg(F.sum(F.size("list")).alias("n")).collect()}
    assert sizes == {e: e // 2 + 1 for e in range(0, 20_000, 1000)}
