"""Many small directories: written and read by the tasks' workers as Spark's writer and reader do it."""

import datetime
import os
import time
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starlog.plans import lake
from starlog.sinks import directories
from starlog.sinks.files import write_small_directories
from starlog.sources import files

ODD = [None, "", "plain", "with space", "a/b", "a=b", "50%", "%41", "[x]", "{y}", "a:b", 'say "no"', "it's", "back\\slash", "q?", "x^y", "#1", "*", "007", "1.0", "a\tb", "."]


def names(path):
    """The directories that hold a data file, relative to the path."""
    return sorted(os.path.relpath(at, path) for at, _, found in os.walk(path) if any(name.startswith("part-") for name in found))


def same_rows(one, other):
    return sorted(map(str, one.collect())) == sorted(map(str, other.select(*one.columns).collect()))


@pytest.fixture
def odd(spark):
    day, at = datetime.date(1999, 2, 28), datetime.datetime(1999, 2, 28, 23, 59, 59, 123456)
    rows = [(name, n % 3 if n % 4 else None, f"title {n}" if n % 5 else None, 0.1 * n, Decimal(n) / 4, n % 2 == 0, day, at, at, bytes([n]), n, n)
            for n, name in enumerate(ODD * 3)]
    return spark.createDataFrame(
        rows, "artist string, year int, title string, length double, price decimal(9,2), good boolean, day date, at timestamp, "
        "local timestamp_ntz, raw binary, small tinyint, big bigint")


def test_directories_and_rows_are_those_of_sparks_writer(spark, odd, path):
    by = ("year", "artist")
    write_small_directories(odd, f"{path}/own", by)
    odd.write.partitionBy(*by).parquet(f"{path}/spark")
    assert names(f"{path}/own") == names(f"{path}/spark") and os.path.exists(f"{path}/own/_SUCCESS")
    told = odd.withColumn("artist", F.nullif("artist", F.lit("")))
    own = files.read_small_directories(spark, f"{path}/own", odd.schema, by)
    assert own.dtypes == odd.dtypes and same_rows(told, own)
    by_spark = spark.read.parquet(f"{path}/own")
    assert by_spark.dtypes == spark.read.parquet(f"{path}/spark").dtypes
    assert same_rows(spark.read.parquet(f"{path}/spark"), by_spark)


def test_elsewhere_spark_writes_and_reads(spark, odd, path, monkeypatch):
    for module in (directories, files):
        monkeypatch.setattr(module, "mounted", lambda spark, path: None)
    by = ("year", "artist")
    write_small_directories(odd, path, by)
    assert any(name.endswith(".crc") for _, _, found in os.walk(f"{path}/year=1") for name in found)
    read = files.read_small_directories(spark, path, odd.schema, by)
    assert read.dtypes == odd.dtypes and same_rows(odd.withColumn("artist", F.nullif("artist", F.lit(""))), read)


def test_types_that_are_not_written_alike_are_left_to_spark(spark, path):
    listed = spark.range(6).select((F.col("id") % 2).alias("year"), F.array("id").alias("ids"))
    write_small_directories(listed, path, ("year",))
    assert same_rows(listed.withColumn("year", F.col("year").cast("int")), spark.read.parquet(path))


def test_no_process_is_started_for_each_directory(spark, path):
    n = F.col("id")
    songs = spark.range(1200).select(n, (n % 7).cast("int").alias("year"), F.concat(F.lit("AR"), n).alias("artist"))
    write_small_directories(songs.limit(8), f"{path}/warm", ("year", "artist"))
    begun = time.perf_counter()
    write_small_directories(songs, f"{path}/own", ("year", "artist"))
    ended = time.perf_counter()
    songs.repartition(8, "year", "artist").write.partitionBy("year", "artist").parquet(f"{path}/spark")
    assert ended - begun < (time.perf_counter() - ended) / 2
    assert len(names(f"{path}/own")) == 1200 and names(f"{path}/own") == names(f"{path}/spark")


def test_a_write_that_fails_leaves_what_was_there(spark, path):
    old = spark.range(5).select((F.col("id") % 2).cast("int").alias("year"), "id")
    write_small_directories(old, f"{path}/t", ("year",))
    wrong = spark.range(500).select(
        (F.col("id") % 50).cast("int").alias("year"), F.when(F.col("id") < 499, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("bigint")).alias("id")
    )
    with pytest.raises(PySparkException):
        write_small_directories(wrong, f"{path}/t", ("year",))
    assert os.listdir(path) == ["t"] and same_rows(old, spark.read.parquet(f"{path}/t"))
    new = old.withColumn("year", F.col("year") + 5)
    write_small_directories(new, f"{path}/t", ("year",))
    assert names(f"{path}/t") == ["year=5", "year=6"] and same_rows(new, spark.read.parquet(f"{path}/t"))


def test_a_large_directory_is_read_and_written_in_parts(spark, path):
    rows = spark.range(300_000).select(F.lit(1).alias("year"), "id")
    write_small_directories(rows, path, ("year",))
    (file,) = [name for name in os.listdir(f"{path}/year=1") if name.startswith("part-")]
    assert pq.ParquetFile(f"{path}/year=1/{file}").num_row_groups == 2
    read = files.read_small_directories(spark, path, rows.schema, ("year",))
    assert read.agg(F.count("*"), F.sum("id"), F.countDistinct("id"), F.max("year")).first()[:] == (300_000, 300_000 * 299_999 // 2, 300_000, 1)


def test_a_repeated_attempt_replaces_the_files_of_the_first(tmp_path):
    whole = pa.RecordBatch.from_pydict({"_directory_0": ["1", "1", "2", None], "id": [1, 2, 3, 4]})
    put = lambda batches, attempt: directories.put_rows(iter(batches), str(tmp_path), ["year"], "part-0.parquet", attempt, "snappy", {})
    with pytest.raises(AttributeError):
        put([whole.slice(0, 3), None], 0)
    assert put([whole.slice(0, 1), whole.slice(1)], 1) == 4
    assert names(tmp_path) == ["year=1", "year=2", f"year={directories.NULL_NAME}"]
    schema = pa.schema([("year", pa.string()), ("id", pa.int64())])
    found = directories.subdirectories(str(tmp_path), "", "year")
    assert [row for b in directories.fetch_rows(iter(found), str(tmp_path), schema, 1) for row in zip(*b.to_pydict().values())] == [("1", 1), ("1", 2), ("2", 3), (None, 4)]
    with pytest.raises(ValueError):
        directories.subdirectories(str(tmp_path), "", "month")


def test_no_rows(spark, path):
    none = spark.createDataFrame([], "year int, id bigint")
    write_small_directories(none, path, ("year",))
    assert files.read_small_directories(spark, path, none.schema, ("year",)).collect() == []


@pytest.mark.parametrize("layout", ["year", "year_and_artist"])
def test_lake_is_read_as_written(spark, path, layout):
    song = "num_songs int, song_id string, title string, artist_id string, artist_name string, artist_location string, artist_latitude double, artist_longitude double, duration double, year int"
    songs = spark.createDataFrame([(1, f"S{n}", f"T{n}", f"{n % 3:03d}" if n else None, "N", "L", 1.5, None, 0.5 * n, n % 2) for n in range(9)], song)
    log = spark.createDataFrame([], "ts bigint, userId string, firstName string, lastName string, gender string, level string, page string, song string, "
                                "artist string, length double, sessionId bigint, location string, userAgent string, itemInSession bigint")
    played = spark.createDataFrame([(1541103205000, "1", "F", "L", "M", "free", "NextSong", "T1", "N", 0.5, 7, "here", "agent", 1)], log.schema)
    lake.write_lake(log.unionByName(played), songs, path, layout)
    read = lake.read_lake(spark, path, layout)
    assert {name: table.count() for name, table in read.items()} == {"songs": 9, "artists": 3, "users": 1, "time": 1, "songplay": 9}
    assert same_rows(songs.select("song_id", "title", "artist_id", "year", "duration"), read["songs"])
