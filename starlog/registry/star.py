"""Star-schema tables under each of their rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlog.plans import lake, star
from starlog.registry import query
from starlog.registry import standins as std
from starlog.schemas import USERS, conform
from starlog.session import materialise, scratch_path

_DIM_SONG = "song_id, title, artist_id, CAST(year AS BIGINT) AS year, duration"
_DIM_ARTIST = "artist_id, artist_name, artist_location, artist_latitude, artist_longitude"


def _re_released(songs):
    """The catalogue with each song repeated under a second artist, so that keys repeat."""
    again = songs.withColumns({"artist_id": F.concat(F.lit("B"), F.substring("artist_id", 2, 20)), "year": F.col("year") + 1})
    return songs.unionByName(again)


_RE_RELEASED = f"""{std.SONGS}, released AS (SELECT song_id, title, artist_id, artist_name, artist_location, artist_latitude,
  artist_longitude, duration, year FROM songs UNION ALL SELECT song_id, title, 'B' || substr(artist_id, 2), artist_name,
  artist_location, artist_latitude, artist_longitude, duration, year + 1 FROM songs)"""


@query(f"""WITH {_RE_RELEASED} SELECT {_DIM_SONG} FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY artist_id NULLS LAST) AS n
  FROM released WHERE song_id IS NOT NULL) WHERE n = 1""")
def dim_songs(spark, d):
    """One row per song, the one with the lowest artist id."""
    return std.longs(star.songs(_re_released(std.songs(spark, d))))


@query(f"WITH {_RE_RELEASED} SELECT DISTINCT {_DIM_SONG} FROM released")
def dim_songs_distinct(spark, d):
    return std.longs(star.songs(_re_released(std.songs(spark, d)), "distinct"))


@query(f"""WITH {_RE_RELEASED} SELECT {_DIM_SONG} FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY year DESC) AS n
  FROM released) WHERE n = 1""")
def dim_songs_first_seen(spark, d):
    """One row per song, the first along a given arrival order (here: newest release first)."""
    return std.longs(star.songs(_re_released(std.songs(spark, d)), "first_seen", [F.col("year").desc()]))


@query(f"""WITH {std.SONGS} SELECT {_DIM_ARTIST} FROM (SELECT *, row_number() OVER (PARTITION BY artist_id
  ORDER BY artist_name, artist_location, artist_latitude, artist_longitude) AS n FROM songs WHERE artist_id IS NOT NULL) WHERE n = 1""")
def dim_artists(spark, d):
    return star.artists(std.songs(spark, d))


@query(f"WITH {std.SONGS} SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude, artist_longitude AS longitude FROM songs")
def dim_artists_distinct(spark, d):
    return star.renamed_artists(star.artists(std.songs(spark, d), "distinct"))


@query(f"""WITH {std.SONGS} SELECT {_DIM_ARTIST} FROM (SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS n FROM songs)
WHERE n = 1""")
def dim_artists_first_seen(spark, d):
    return star.artists(std.songs(spark, d), "first_seen", [F.col("song_id").asc()])


_PROFILE = "firstName AS first_name, lastName AS last_name, gender"


@query(f"""WITH {std.LOG}, newest AS (SELECT userId, MAX(ts) AS ts FROM log WHERE userId IS NOT NULL AND page = 'view' GROUP BY userId)
SELECT DISTINCT log.userId AS user_id, {_PROFILE}, level FROM log JOIN newest ON log.userId = newest.userId AND log.ts = newest.ts
WHERE page = 'view'""")
def users_latest(spark, d):
    """Users as of their latest play."""
    return star.users(std.log(spark, d), page=std.PLAY)


_DAY_LOG = f"{std.LOG}, daily AS (SELECT * REPLACE (ts // 86400000 * 86400000 AS ts) FROM log)"


@query(f"""WITH {_DAY_LOG}, newest AS (SELECT userId, MAX(ts) AS ts FROM daily WHERE userId IS NOT NULL AND page = 'view' GROUP BY userId)
SELECT DISTINCT CAST(daily.userId AS BIGINT) AS user_id, {_PROFILE}, level FROM daily
  JOIN newest ON daily.userId = newest.userId AND daily.ts = newest.ts WHERE page = 'view'""")
def users_latest_ties(spark, d):
    """Users as of their latest play day: both levels stay when the last day has both."""
    daily = std.log(spark, d).withColumn("ts", std.idiv(F.col("ts"), 86400000) * 86400000)
    return std.longs(star.users(daily, "latest", numeric_id=True, page=std.PLAY))


@query(f"WITH {std.LOG} SELECT DISTINCT CAST(userId AS BIGINT) AS user_id, {_PROFILE}, level FROM log WHERE page = 'view'")
def users_distinct(spark, d):
    return std.longs(star.users(std.log(spark, d), "distinct", numeric_id=True, page=std.PLAY))


@query(f"""WITH {std.LOG} SELECT CAST(userId AS BIGINT) AS user_id, arg_min(firstName, (ts, event_id)) AS first_name,
  arg_min(lastName, (ts, event_id)) AS last_name, arg_min(gender, (ts, event_id)) AS gender, arg_max(level, (ts, event_id)) AS level
FROM log WHERE page = 'view' GROUP BY userId""")
def users_upserted(spark, d):
    """Users by the conflict rule: names as first seen, level as last seen."""
    return std.longs(star.users(std.log(spark, d), "upserted", numeric_id=True, order=["ts", "event_id"], page=std.PLAY))


_STAMP = "make_timestamp(epoch_us(ts) // 1000 * 1000)"
_PARTS = "hour(t) AS hour, day(t) AS day, week(t) AS week, month(t) AS month, year(t) AS year"


@query(f"""SELECT DISTINCT CAST(t AS VARCHAR) AS time_stamp, CAST(CAST(t AS DATE) AS VARCHAR) AS date, {_PARTS}, isodow(t) - 1 AS weekday
FROM (SELECT {_STAMP} AS t FROM events WHERE event_type = 'view')""")
def time_dim(spark, d):
    return std.longs(std.iso(star.time_lake(std.log(spark, d), std.PLAY)))


@query(f"""SELECT DISTINCT epoch_us(t) // 1000 AS start_time, {_PARTS}, isodow(t) - 1 AS weekday
FROM (SELECT {_STAMP} AS t FROM events WHERE event_type = 'view')""")
def time_dim_relational(spark, d):
    return std.longs(star.time_relational(std.log(spark, d), std.PLAY))


@query(f"""SELECT DISTINCT epoch_us(t) // 1000 AS start_time, {_PARTS}, dayofweek(t) AS weekday
FROM (SELECT {_STAMP} AS t FROM events WHERE event_type = 'view')""")
def time_dim_dow0(spark, d):
    return std.longs(star.time_warehouse(std.log(spark, d), std.PLAY))


_SCHEDULED = f"""plays AS (SELECT md5(CAST(sessionId AS VARCHAR) || CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR)) AS playid,
    make_timestamp(ts // 1000 * 1000000) AS start_time, CAST(userId AS BIGINT) AS userid, level, song_id AS songid, songs.artist_id AS artistid,
    sessionId AS sessionid, location, userAgent AS user_agent
  FROM log LEFT JOIN songs ON log.song = songs.title AND log.artist = songs.artist_name AND trunc(log.length) = trunc(songs.duration)
  WHERE page = 'view')"""


@query(f"""WITH {std.SONG_LOG}, {std.SONGS}, {_SCHEDULED} SELECT CAST(t AS VARCHAR) AS start_time, hour(t) AS hour, day(t) AS day,
  week(t) AS week, CAST(month(t) AS VARCHAR) AS month, year(t) AS year, CAST(dayofweek(t) AS VARCHAR) AS weekday
FROM (SELECT start_time AS t FROM plays)""")
def time_dim_scheduled(spark, d):
    """Time rows of the fact table, one per play."""
    plays = star.plays_scheduled(std.log(spark, d, with_songs=True), std.songs(spark, d), page=std.PLAY)
    return std.longs(std.iso(star.time_scheduled(plays)))


@query(f"""WITH {std.SONG_LOG}, {std.SONGS} SELECT ts AS start_time, month(t) AS month, year(t) AS year, userId AS user_id, level, song_id,
  artist_id, sessionId AS session_id, location, userAgent AS user_agent
FROM (SELECT *, make_timestamp(ts * 1000) AS t FROM log) l JOIN songs ON l.artist = songs.artist_name WHERE page = 'view'""")
def songplays_inner_artist(spark, d):
    """Plays joined on the artist's name, repeated for each of the artist's songs."""
    return std.longs(star.plays_by_artist(std.log(spark, d, with_songs=True), std.songs(spark, d), page=std.PLAY))


@query(f"""WITH {std.SONG_LOG}, {std.SONGS}, plays AS (SELECT ts AS start_time, month(t) AS month, year(t) AS year,
  CAST(userId AS BIGINT) AS user_id, level, song_id, artist_id, sessionId AS session_id, location, userAgent AS user_agent, itemInSession AS item
FROM (SELECT *, make_timestamp(ts * 1000) AS t FROM log) l JOIN songs ON l.artist = songs.artist_name WHERE page = 'view')
SELECT * EXCLUDE (item), row_number() OVER (ORDER BY start_time, session_id, item, user_id, song_id) - 1 AS songplay_id FROM plays""")
def songplays_artist_numbered(spark, d):
    """Plays joined on the artist's name, with numeric users, numbered from 0."""
    plays = star.plays_by_artist(std.log(spark, d, with_songs=True), std.songs(spark, d), True, std.PLAY, with_item=True)
    return std.longs(star.with_serial(plays, start=0))


@query(f"WITH {std.SONG_LOG}, {std.SONGS}, {_SCHEDULED} SELECT * REPLACE (CAST(start_time AS VARCHAR) AS start_time) FROM plays")
def songplays_left_3key(spark, d):
    """All plays with songs of the same title, artist and whole-second length."""
    plays = star.plays_scheduled(std.log(spark, d, with_songs=True), std.songs(spark, d), page=std.PLAY)
    return std.longs(std.iso(plays))


@query(f"""WITH {std.SONG_LOG}, {std.SONGS} SELECT CAST(userId AS BIGINT) AS userid, sessionId AS sessionid, song_id AS songid,
  CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR) AS start_time
FROM log LEFT JOIN songs ON log.song = songs.title AND log.artist = songs.artist_name
  AND CAST(log.length AS DECIMAL(18,0)) = CAST(songs.duration AS DECIMAL(18,0)) WHERE page = 'view'""")
def songplays_left_3key_rounded(spark, d):
    """The same with lengths rounded instead of cut."""
    plays = star.plays_scheduled(std.log(spark, d, with_songs=True), std.songs(spark, d), fraction="round", page=std.PLAY)
    return std.longs(std.iso(plays.select("userid", "sessionid", "songid", "start_time")))


@query(f"""WITH {std.SONG_LOG}, {std.SONGS}, first_artist AS (SELECT artist_id, MIN(artist_name) AS name FROM songs GROUP BY artist_id),
  plays AS (SELECT ts AS start_time, CAST(userId AS BIGINT) AS user_id, level,
    (SELECT MIN(song_id) FROM songs s JOIN first_artist a ON s.artist_id = a.artist_id
      WHERE s.title = log.song AND a.name = log.artist AND s.duration = log.length) AS song_id,
    sessionId AS session_id, location, userAgent AS user_agent, itemInSession AS item FROM log WHERE page = 'view')
SELECT row_number() OVER (ORDER BY start_time, session_id, item, user_id, plays.song_id NULLS FIRST) AS songplay_id, start_time, user_id, level,
  plays.song_id, artist_id, session_id, location, user_agent FROM plays LEFT JOIN songs ON songs.song_id = plays.song_id""")
def songplays_at_most_one(spark, d):
    """All plays, each with at most one song, numbered in time order."""
    songs = std.songs(spark, d)
    lookup = star.song_lookup(star.songs(songs), star.artists(songs))
    return std.longs(star.with_serial(star.plays_relational(std.log(spark, d, with_songs=True), lookup, std.PLAY)))


_LAKE = f"WITH {std.SONG_LOG}, {std.SONGS}, stamped AS (SELECT *, make_timestamp(ts * 1000) AS t FROM log WHERE page = 'view') " + " UNION ALL ".join([
    std.lines_sql("songs", "artist_id; duration; song_id; title; year", "songs"),
    std.lines_sql("artists", "artist_id; artist_latitude; artist_location; artist_longitude; artist_name", f"""(SELECT {_DIM_ARTIST} FROM
      (SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY artist_name, artist_location, artist_latitude, artist_longitude) AS n FROM songs)
      WHERE n = 1)"""),
    std.lines_sql("users", "firstName; gender; lastName; level; userId", """(SELECT DISTINCT firstName, gender, lastName, level, userId
      FROM stamped WHERE (userId, ts) IN (SELECT (userId, MAX(ts)) FROM stamped GROUP BY userId))"""),
    std.lines_sql("time", "CAST(t AS DATE); day(t); hour(t); month(t); t; week(t); isodow(t) - 1; year(t)", "(SELECT DISTINCT t FROM stamped)"),
    std.lines_sql("songplay", "artist_id; level; location; month(t); sessionId; song_id; ts; userAgent; userId; year(t)",
                  "stamped JOIN songs ON artist = artist_name"),
])


def _lake_rows(spark, d, layout):
    """All rows of the five lake tables, read from what was written."""
    out = scratch_path(spark, "lake")
    lake.write_lake(std.log(spark, d, with_songs=True), std.songs(spark, d), out, songs_layout=layout, page=std.PLAY)
    return std.as_lines(lake.read_lake(spark, out, layout))


@query(_LAKE)
def lake_load(spark, d):
    """The lake with its songs in directories by year."""
    return _lake_rows(spark, d, "year")


@query(_LAKE)
def lake_load_by_artist(spark, d):
    """The lake with its songs in directories by year and artist."""
    return _lake_rows(spark, d, "year_and_artist")


def _passed(check, *subjects):
    return [
        f"SELECT '{check}' AS \"check\", '{s}' AS subject, CAST(0 AS BIGINT) AS measured, '=' AS comparison, "
        "CAST(0 AS BIGINT) AS expected, TRUE AS passed" for s in subjects
    ]


_KEYS = ["users(user_id)", "songs(song_id)", "artists(artist_id)", "time(start_time)", "songplays(songplay_id)"]
_UNPAID = f"""SELECT 'no_orphans', 'songplays(user_id)', COUNT(*), '=', 0, COUNT(*) = 0 FROM log p WHERE page = 'view' AND NOT EXISTS
  (SELECT 1 FROM log WHERE page = 'view' AND level = 'paid' AND log.userId = p.userId)"""


@query(f"WITH {std.LOG} " + " UNION ALL ".join([
    *_passed("no_nulls", *_KEYS), *_passed("unique_key", *_KEYS),
    *_passed("no_orphans", "songs(artist_id)", "songplays(start_time)", "songplays(song_id)", "songplays(artist_id)"), _UNPAID,
]))
def dq_star_contract(spark, d):
    """What the contracts of the relational star declare, where users is built from paid plays only."""
    log, songs = std.log(spark, d, with_songs=True), std.songs(spark, d)
    tables = star.relational_star(log, songs, std.PLAY)
    paid = star.users(log.where("level = 'paid'"), "upserted", numeric_id=True, page=std.PLAY)
    tables["users"] = conform(paid, USERS)
    return star.star_checks({name: materialise(table) for name, table in tables.items()})
