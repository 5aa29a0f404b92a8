"""Load modes and whole jobs: append, insert if absent, upsert, scheduled load, incremental ingest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starlog import schemas
from starlog.plans import star, warehouse
from starlog.registry import query
from starlog.registry import standins as std
from starlog.session import scratch_path
from starlog.sinks import tables
from starlog.sinks.bucketed import BucketedTable
from starlog.sinks.files import write_parquet
from starlog.sources.files import read_table
from starlog.streaming.ingest import ingest_log, users_table


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS loaded FROM orders")
def append_new_only(spark, d):
    """Orders loaded in two overlapping batches, the second one twice."""
    path = scratch_path(spark, "appended")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.append_new(orders.where("o_orderstatus = 'F'").withColumn("loaded", F.lit("first")), path, ["o_orderkey"])
    for _ in range(2):
        tables.append_new(orders.withColumn("loaded", F.lit("second")), path, ["o_orderkey"])
    return spark.read.parquet(path)


@query("""WITH placed AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_linestatus,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_linestatus ORDER BY l_partkey, l_suppkey) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM placed WHERE n = 1 AND l_linestatus = 'F'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM placed p WHERE n = 1 AND l_linestatus = 'O'
  AND NOT EXISTS (SELECT 1 FROM lineitem q WHERE q.l_linestatus = 'F' AND q.l_orderkey = p.l_orderkey AND q.l_linenumber = p.l_linenumber)""")
def insert_if_absent(spark, d):
    """Lines of two batches, of which the first row per key is kept."""
    path = scratch_path(spark, "inserted")
    lines = std.longs(read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"))
    for status in ("F", "O", "O"):
        batch = lines.where(F.col("l_linestatus") == status)
        tables.insert_if_absent(batch, path, ["l_orderkey", "l_linenumber"], [F.col("l_partkey").asc()])
    return spark.read.parquet(path)


@query("""SELECT CAST(CAST(t AS DATE) AS VARCHAR) AS date, hour(t) AS hour, COUNT(*) AS times FROM
  (SELECT DISTINCT make_timestamp(epoch_us(ts) // 1000 * 1000) AS t FROM events) GROUP BY ALL""")
def insert_if_absent_partitioned(spark, d):
    """Time rows inserted in two overlapping batches into daily directories, counted by hour."""
    path = scratch_path(spark, "times")
    times = std.log(spark, d).select(F.timestamp_millis("ts").alias("start_time"), "page")
    times = times.withColumn("date", F.to_date("start_time"))
    for batch in (times.where("page <> 'click'"), times.where("page <> 'signup'")):
        tables.insert_if_absent(batch.drop("page"), path, ["start_time"], [], by=("date",))
    stored = spark.read.parquet(path)
    return std.longs(std.iso(stored.groupBy("date", F.hour("start_time").alias("hour")).agg(F.count("*").alias("times"))))


@query("""SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS latest_type
FROM events GROUP BY user_id""")
def upsert_latest_level(spark, d):
    """Users upserted from two batches in time order, the second one twice."""
    table = BucketedTable(spark, scratch_path(spark, "upserted"), "user_id", buckets=16)
    events = read_table(spark, d, "events").select(
        "user_id", F.col("event_type").alias("first_type"), F.col("event_type").alias("latest_type"), "ts", "event_id"
    )
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    for batch in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut), events.where(F.col("ts") >= cut)):
        tables.upsert(batch, table, ["ts", "event_id"], ["latest_type"])
    return table.read()


@query(f"""WITH {std.SONG_LOG}, {std.SONGS} SELECT md5(sessionId || CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR)) AS playid,
  itemInSession AS item, CAST(userId AS BIGINT) AS userid, song_id AS songid FROM log LEFT JOIN songs ON log.song = songs.title
  AND log.artist = songs.artist_name AND trunc(log.length) = trunc(songs.duration) WHERE page = 'view'""")
def append_late_plays(spark, d):
    """Plays loaded in two parts, the second with the first again: as many as in one load, also within one second."""
    path = scratch_path(spark, "late")
    log = std.log(spark, d, with_songs=True)
    for part in (log.where("itemInSession % 2 = 0"), log):
        plays = star.plays_scheduled(part, std.songs(spark, d), page=std.PLAY, with_item=True)
        tables.append_new(plays.select(*warehouse.PLAY_KEY), path, warehouse.PLAY_KEY)
    return std.longs(spark.read.parquet(path))


_SCHEDULED = f"""{std.SONG_LOG}, {std.SONGS},
  plays AS (SELECT md5(CAST(sessionId AS VARCHAR) || CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR)) AS playid,
    make_timestamp(ts // 1000 * 1000000) AS t, CAST(userId AS BIGINT) AS userid, level, song_id AS songid, songs.artist_id AS artistid,
    sessionId AS sessionid, location, userAgent AS user_agent, itemInSession AS item
  FROM log LEFT JOIN songs ON log.song = songs.title AND log.artist = songs.artist_name AND trunc(log.length) = trunc(songs.duration)
  WHERE page = 'view')"""
_WHOLE = "::DECIMAL(18,0)::BIGINT"


@query(f"WITH {_SCHEDULED} " + " UNION ALL ".join([
    std.lines_sql("songplays", """artistid; item; level; location; month(t); playid; sessionid; songid; t; user_agent; userid; year(t)""", "plays"),
    std.lines_sql("users", "firstName; gender; lastName; level; userId::BIGINT",
                  "(SELECT DISTINCT userId, firstName, lastName, gender, level FROM log WHERE page = 'view')"),
    std.lines_sql("songs", f"artist_id; trunc(duration){_WHOLE}; song_id; title; year",
                  "(SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs)"),
    std.lines_sql("artists", f"artist_id; trunc(artist_latitude){_WHOLE}; artist_location; trunc(artist_longitude){_WHOLE}; artist_name",
                  "(SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude FROM songs)"),
    std.lines_sql("time", "day(t); hour(t); month(t); t; week(t); dayofweek(t); year(t)", "plays"),
]))
def scheduled_load(spark, d):
    """The scheduled load run twice for one hour: all rows of its five tables."""
    out = scratch_path(spark, "star")
    log, songs = std.log(spark, d, with_songs=True), std.songs(spark, d)
    for again in (False, True):
        warehouse.load_star(spark, log, songs, out, datetime(2018, 11, 2, 5), std.PLAY, again=again)
    dimensions = warehouse.dimensions(spark, out)
    loaded = {"songplays": spark.read.parquet(f"{out}/songplays")} | {n: dimensions.read(n) for n in warehouse.DIMENSIONS}
    return std.as_lines(loaded)


@query("""SELECT 'replaced' AS mode, c_custkey, c_name, 1 AS rows FROM customer WHERE c_custkey % 2 = 1
UNION ALL SELECT 'added', c_custkey, c_name, 1 + c_custkey % 2 FROM customer""")
def dimension_load_modes(spark, d):
    """A dimension loaded in whole and then in part, replacing or adding."""
    names = read_table(spark, d, "customer").select("c_custkey", "c_name")
    kept = []
    for mode, clear in (("replaced", True), ("added", False)):
        table = tables.VersionedTable(spark, scratch_path(spark, "dimension"))
        for rows in (names, names.where("c_custkey % 2 = 1")):
            tables.load_dimension(rows, table, clear)
        counted = table.read().groupBy("c_custkey", "c_name").agg(F.count("*").alias("rows"))
        kept.append(counted.withColumn("mode", F.lit(mode)))
    return kept[0].unionByName(kept[1])


@query(f"""WITH {std.SONG_LOG}, {std.SONGS}, stamped AS (SELECT *, make_timestamp(ts * 1000) AS t FROM log WHERE page = 'view'),
  plays AS (SELECT *, row_number() OVER (ORDER BY ts, sessionId, itemInSession, userId::BIGINT, song_id) - 1 AS id
    FROM (SELECT stamped.*, song_id, artist_id FROM stamped JOIN songs ON artist = artist_name))
""" + " UNION ALL ".join([
    std.lines_sql("songplays", "artist_id; level; location; month(t); sessionId; song_id; id; ts; userAgent; userId::BIGINT; year(t)", "plays"),
    std.lines_sql("users", "firstName; gender; lastName; level; userId", """(SELECT DISTINCT firstName, gender, lastName, level, userId
      FROM stamped WHERE (userId, ts) IN (SELECT (userId, MAX(ts)) FROM stamped GROUP BY userId))"""),
    std.lines_sql("songs", "artist_id; duration; song_id; title; year", "(SELECT DISTINCT artist_id, duration, song_id, title, year FROM songs)"),
    std.lines_sql("artists", "artist_id; artist_latitude::DECIMAL(9,6); artist_location; artist_longitude::DECIMAL(9,6); artist_name",
           "(SELECT DISTINCT artist_id, artist_latitude, artist_location, artist_longitude, artist_name FROM songs)"),
    std.lines_sql("time", "day(t); hour(t); month(t); ts; week(t); dayofweek(t); year(t)", "(SELECT DISTINCT ts, t FROM stamped)"),
]))
def warehouse_load(spark, d):
    """The warehouse load from JSON files: all rows of its five tables."""
    path = scratch_path(spark, "warehouse")
    std.log(spark, d, with_songs=True).write.json(f"{path}/in/log")
    std.songs(spark, d).withColumnsRenamed({"song_id": "SONG_ID", "title": "Title"}).write.json(f"{path}/in/songs")
    paths = F.array(*[F.lit(f"$['{field.name}']") for field in schemas.LOG.fields])
    spark.range(1).select(F.to_json(F.struct(paths.alias("jsonpaths"))).alias("value")).write.text(f"{path}/in/mapping")
    return std.as_lines(
        warehouse.load_warehouse(spark, f"{path}/in/log", f"{path}/in/mapping", f"{path}/in/songs", f"{path}/out", std.PLAY)
    )


def _deliveries(spark, d):
    """The log in three successive parts, each in the shape of log files."""
    log = std.log(spark, d, with_songs=True).withColumns({"method": F.lit("PUT"), "status": F.lit(200)})
    day = F.dayofmonth(F.timestamp_millis("ts"))
    for low, high in ((1, 10), (11, 20), (21, 31)):
        yield schemas.conform(log.where(day.between(low, high)), schemas.LOG)


def _ingest(spark, d):
    """Ingest each delivery as it arrives, and once more with nothing new."""
    out, source = scratch_path(spark, "ingest"), scratch_path(spark, "arriving")
    songs = std.songs(spark, d)
    write_parquet(star.song_lookup(star.songs(songs), star.artists(songs)), f"{out}/lookup")
    lookup = spark.read.parquet(f"{out}/lookup")
    for number, delivery in enumerate(_deliveries(spark, d)):
        delivery.write.json(f"{source}/{number}")
        ingest_log(spark, source, out, lookup, page=std.PLAY)
    ingest_log(spark, source, out, lookup, page=std.PLAY)
    return out


@query(f"""WITH {std.LOG} SELECT CAST(userId AS BIGINT) AS user_id, arg_min(firstName, (ts, event_id)) AS first_name,
  arg_min(lastName, (ts, event_id)) AS last_name, arg_min(gender, (ts, event_id)) AS gender, arg_max(level, (ts, event_id)) AS level
FROM log WHERE page = 'view' GROUP BY userId""")
def stream_users(spark, d):
    """Users after incremental ingest of three deliveries."""
    return std.longs(users_table(spark, _ingest(spark, d)).read())


@query(f"""WITH {std.SONG_LOG}, {std.SONGS}, plays AS (SELECT ts AS start_time, CAST(userId AS BIGINT) AS user_id, level,
    (SELECT MIN(song_id) FROM songs s WHERE s.title = log.song AND s.artist_name = log.artist AND s.duration = log.length) AS song_id,
    sessionId AS session_id, location, userAgent AS user_agent, itemInSession AS item FROM log WHERE page = 'view')
SELECT (CASE WHEN day(t) <= 10 THEN 0 WHEN day(t) <= 20 THEN 1 ELSE 2 END) * 1099511627776 + row_number() OVER
    (PARTITION BY CASE WHEN day(t) <= 10 THEN 0 WHEN day(t) <= 20 THEN 1 ELSE 2 END
     ORDER BY start_time, session_id, item, user_id, plays.song_id NULLS FIRST) AS songplay_id,
  start_time, user_id, level, plays.song_id, artist_id, session_id, location, user_agent, year(t) AS year, month(t) AS month,
  hour(t) AS hour, isodow(t) - 1 AS weekday
FROM (SELECT *, make_timestamp(start_time * 1000) AS t FROM plays) plays LEFT JOIN songs ON songs.song_id = plays.song_id""")
def stream_plays(spark, d):
    """Plays joined with their time rows after incremental ingest of three deliveries."""
    out = _ingest(spark, d)
    plays = spark.read.parquet(f"{out}/songplays").drop("batch")
    return std.longs(plays.join(spark.read.parquet(f"{out}/time").select("start_time", "hour", "weekday"), "start_time"))
