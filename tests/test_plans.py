import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starlog import schemas
from starlog.plans import events, immigration, lake, star, warehouse
from starlog.operators.quality import QualityError, require
from starlog.schemas import conform
from test_skew import settings

MS = 1541103205000  # the start of a second, so that times a little later share it


def log_frame(spark, *rows):
    """Rows of (userId, level, page, ts, sessionId, itemInSession, song, artist, length)."""
    names = "userId string, level string, page string, ts bigint, sessionId int, itemInSession int, song string, artist string, length double"
    frame = spark.createDataFrame(rows, names).withColumns(
        {"firstName": F.lit("Ada"), "lastName": F.lit("Low"), "gender": F.lit("F"), "location": F.lit("Here"), "userAgent": F.lit("x")}
    )
    return conform(frame, schemas.LOG)


def song_frame(spark, *rows):
    """Rows of (song_id, title, artist_id, artist_name, duration, year)."""
    frame = spark.createDataFrame(rows, "song_id string, title string, artist_id string, artist_name string, duration double, year int")
    return conform(frame, schemas.SONG)


@pytest.fixture
def log(spark):
    return log_frame(
        spark,
        ("8", "free", "NextSong", MS, 5, 0, "One", "Band", 200.75),
        ("8", "paid", "NextSong", MS + 200, 5, 1, "Two", "Band", 100.5),
        ("9", "free", "NextSong", MS + 5000, 6, 0, "One", "Other", 200.75),
        ("9", "paid", "Home", MS + 9000, 6, 1, None, None, None),
        ("", "free", "Login", MS + 1, 7, 0, None, None, None),
    )


@pytest.fixture
def song_data(spark):
    return song_frame(
        spark,
        ("S1", "One", "A1", "Band", 200.25, 2001),
        ("S2", "Two", "A1", "Band", 100.5, 0),
        ("S3", "Two", "A1", "Band", 100.5, 1999),
        ("S1", "One", "A0", "Band", 200.25, 2001),
        (None, "Lost", "A9", "Nobody", 1.0, 0),
    )


def test_songs_rules(song_data):
    by_rule = {rule: star.songs(song_data, rule).collect() for rule in ("lowest_artist", "distinct", "first_seen")}
    assert sorted((r.song_id, r.artist_id) for r in by_rule["lowest_artist"]) == [("S1", "A0"), ("S2", "A1"), ("S3", "A1")]
    assert len(by_rule["distinct"]) == 5 and len(by_rule["first_seen"]) == 3
    with pytest.raises(ValueError):
        star.songs(song_data, "any")


def test_artists_rules(song_data):
    assert sorted(r.artist_id for r in star.artists(song_data).collect()) == ["A0", "A1", "A9"]
    assert star.renamed_artists(star.artists(song_data, "distinct")).columns == ["artist_id", "name", "location", "latitude", "longitude"]


def test_artist_join_repeats_plays_per_song(log, song_data):
    plays = star.plays_by_artist(log, song_data).collect()
    assert len(plays) == 2 * 4 and {r.year for r in plays} == {2018}


def test_three_key_join_on_whole_seconds(log, song_data):
    cut = star.plays_scheduled(log, song_data).collect()
    assert sorted((r.userid, r.songid or "") for r in cut) == [(8, "S1"), (8, "S1"), (8, "S2"), (8, "S3"), (9, "")]
    assert len({r.playid for r in cut if r.userid == 8}) == 1  # one session within one second
    rounded = star.plays_scheduled(log, song_data, "round").collect()
    assert sorted((r.userid, r.songid or "") for r in rounded) == [(8, ""), (8, "S2"), (8, "S3"), (9, "")]


def test_at_most_one_song_per_play(log, song_data):
    lookup = star.song_lookup(star.songs(song_data), star.artists(song_data))
    plays = star.with_serial(star.plays_relational(log, lookup)).orderBy("songplay_id").collect()
    assert [(r.songplay_id, r.user_id, r.song_id) for r in plays] == [(1, 8, None), (2, 8, "S2"), (3, 9, None)]


def test_users_rules(log):
    latest = {(r.user_id, r.level) for r in star.users(log).collect()}
    assert latest == {("8", "paid"), ("9", "free")}
    assert star.users(log, "distinct", numeric_id=True).count() == 3
    assert {(r.user_id, r.level) for r in star.users(log, "upserted", numeric_id=True).collect()} == {(8, "paid"), (9, "free")}


def test_time_rules(log):
    assert star.time_lake(log).count() == 3
    assert star.time_relational(log).count() == 3
    warehouse_time = star.time_warehouse(log).orderBy("start_time").first()
    assert (warehouse_time.start_time, warehouse_time.hour, warehouse_time.weekday) == (MS, 20, 4)
    assert star.time_relational(log).first().weekday == 3


def test_event_lookups(log):
    assert [tuple(r) for r in events.session_item(log, 5, 1).collect()] == [("Band", "Two", 100.5)]
    assert [r.song for r in events.session_playlist(log, "8", 5).collect()] == ["One", "Two"]
    assert sorted(r.userId for r in events.song_listeners(log, "One").collect()) == ["8", "9"]
    assert [tuple(r) for r in events.plays_per_hour(log).collect()] == [(20, 3)]


def test_access_tables_are_sorted_over_files(spark, log, path):
    events.write_access_tables(log, path)
    by_user = spark.read.parquet(f"{path}/by_user")
    assert [r.song for r in events.session_playlist(by_user, "8", 5).collect()] == ["One", "Two"]
    assert spark.read.parquet(f"{path}/by_song").where("song = 'One'").count() == 2
    per_file = by_user.select("userId", F.input_file_name().alias("f")).groupBy("f").agg(F.min("userId").alias("lo"), F.max("userId").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in per_file.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_downgrade_phases(spark):
    log = log_frame(spark, *[
        (user, "free", page, ts, 1, ts, None, None, None)
        for user, page, ts in [("1", "NextSong", 1), ("1", "Submit Downgrade", 2), ("1", "NextSong", 3), ("", "Submit Downgrade", 4)]
    ])
    out = events.downgrade_phases(log)
    assert sorted((r.userId, r.ts, r.downgrade, r.phase) for r in out.collect()) == [("1", 1, 0, 1), ("1", 2, 1, 1), ("1", 3, 0, 0)]


def test_lake_tables(spark, log, song_data, path):
    lake.write_lake(log, song_data, path)
    songs = spark.read.parquet(f"{path}/songs")
    assert songs.where("year = 1999 AND artist_id = 'A1'").count() == 1
    assert spark.read.parquet(f"{path}/songplay").where("month = 11").count() == 8
    assert {n: spark.read.parquet(f"{path}/{n}").count() for n in ("artists", "users", "time")} == {"artists": 3, "users": 2, "time": 3}


def test_lake_songs_are_written_by_many_tasks(spark, log, song_data, path):
    many = song_data.limit(1).drop("artist_id", "song_id").crossJoin(
        spark.range(60).select(F.concat(F.lit("A"), "id").alias("artist_id"), F.concat(F.lit("S"), "id").alias("song_id"))
    )
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="true"):
        lake.write_lake(log, many, path)
    assert spark.read.parquet(f"{path}/songs").select("artist_id").distinct().count() == 60
    assert len({name[:10] for _, _, names in os.walk(f"{path}/songs") for name in names if name.startswith("part-")}) > 1


def test_scheduled_load_is_idempotent_and_gated(spark, log, song_data, path):
    for again in (False, True):
        results = warehouse.load_star(spark, log, song_data, path, datetime(2018, 11, 1), again=again)
    assert {r.subject: r.measured for r in results.collect()} == {"songplays": 5, "users": 3, "songs": 5, "artists": 3, "time": 5}
    with pytest.raises(QualityError):
        warehouse.load_star(spark, log.limit(0), song_data, path + "-empty", datetime(2018, 11, 1))


def test_failed_load_is_taken_up_where_it_stopped(spark, log, song_data, path, monkeypatch):
    at = datetime(2018, 11, 1)
    warehouse.load_star(spark, log, song_data, path, at)
    before = sorted(map(str, warehouse.dimensions(spark, path).read("users").collect()))
    later = log.unionByName(log.withColumns({"firstName": F.lit("New"), "ts": F.col("ts") + 3_600_000}))
    write, steps = warehouse.VersionedTables.write, []

    def failing(self, number, name, df):
        steps.append(name)
        if steps.count("artists") == 1 and name == "artists":
            raise RuntimeError("lost")
        write(self, number, name, df)

    monkeypatch.setattr(warehouse.VersionedTables, "write", failing)
    hour = datetime(2018, 11, 1, 1)
    with pytest.raises(RuntimeError):
        warehouse.load_star(spark, later, song_data, path, hour)
    # readers still see the whole version before
    assert sorted(map(str, warehouse.dimensions(spark, path).read("users").collect())) == before
    assert steps == ["users", "songs", "artists"]
    results = warehouse.load_star(spark, later, song_data, path, hour)
    assert steps == ["users", "songs", "artists", "artists", "time"]  # taken up, not begun anew
    measured = {r.subject: r.measured for r in results.collect()}
    assert (measured["songplays"], measured["time"], measured["users"]) == (10, 10, 6)
    assert len(warehouse.dimensions(spark, path).versions()) == 2
    assert warehouse.load_star(spark, later, song_data, path, hour).count() == 5  # a finished run does nothing more
    assert spark.read.parquet(f"{path}/songplays").count() == 10


@pytest.fixture
def arrival_frames(spark):
    ports = spark.createDataFrame([(0, "NYC", "NEW YORK, NY"), (1, "NEW", "NEWARK/NEW YORK"), (2, "LAX", "LOS ANGELES, CA")], "ordinal bigint, code string, label string")
    addresses = spark.createDataFrame([("NY",), ("99",)], "code string")
    records = spark.createDataFrame(
        [(2016.0, 4.0, "NY", "NYC"), (2016.0, 4.0, "99", "LAX"), (2016.0, 4.0, "XX", "NYC"), (2016.0, 4.0, "NY", "???"),
         (2016.0, None, "NY", "NYC"), (2016.0, 4.0, None, "NYC")], schemas.IMMIGRATION)
    weather = spark.createDataFrame(
        [("2013-04-01", "9.125", "New York", "United States"), ("2013-04-01", "8.0", "York", "United States"),
         ("2013-04-01", "7.0", "Paris", "United States"), ("2013-04-01", None, "Los Angeles", "United States"),
         ("2013-05-01", "9.0", "New York", "United States"), ("2013-04-01", "9.0", "New York", "France"),
         ("oops", "9.0", "New York", "United States")], schemas.TEMPERATURE_TEXT)
    return immigration.arrivals(records, ports, addresses), immigration.temperatures(immigration.country_temperatures(weather), ports)


def test_arrivals_and_temperatures(arrival_frames):
    arrived, temps = arrival_frames
    assert sorted((str(r.dt), r.i94addr, r.i94port) for r in arrived.collect()) == [("2016-04-01", "99", "LAX"), ("2016-04-01", "NY", "NYC")]
    assert sorted((r.City, r.AverageTemperature, r.i94port) for r in temps.collect()) == [("New York", 9.13, "NYC"), ("York", 8.0, "NYC")]


def test_facts_never_match_across_years_but_months_do(arrival_frames):
    arrived, temps = arrival_frames
    assert {r.AverageTemperature for r in immigration.arrival_facts(arrived, temps).collect()} == {None}
    aligned = immigration.arrival_facts(arrived, temps, "month_of_year").collect()
    assert sorted((r.i94port, r.AverageTemperature or 0) for r in aligned) == [("LAX", 0), ("NYC", 8.0), ("NYC", 9.13)]


def test_checks_find_the_fan_out(spark, arrival_frames, path):
    require(immigration.write_arrivals(spark, *arrival_frames, path))
    assert spark.sql("SELECT count(*) AS n FROM fact WHERE i94port = 'NYC'").first().n == 1
    with pytest.raises(QualityError, match="same_count fact and immigration: 3 is not = 2"):
        require(immigration.write_arrivals(spark, *arrival_frames, path + "-month", "month_of_year"))
