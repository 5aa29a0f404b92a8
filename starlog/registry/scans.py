"""Sources and sinks: each query writes what it reads back, from the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starlog import schemas
from starlog.operators import joins
from starlog.operators.aggregates import key_counts
from starlog.operators.dedupe import first_row_per_key
from starlog.plans import events as event_jobs
from starlog.plans import star
from starlog.registry import query
from starlog.registry import standins as std
from starlog.session import scratch_path
from starlog.sinks import files as sinks
from starlog.sources import files as sources
from starlog.sources.codes import ADDRESS_CODES, PORT_LINE, address_codes, parse_codes
from starlog.sources.files import read_table


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_parquet(spark, d):
    return read_table(spark, d, "customer")


def _as_log(frame):
    """The stand-in log in the exact shape of log files (ids as JSON numbers, userId quoted)."""
    return schemas.conform(frame.withColumns({"method": F.lit("PUT"), "status": F.lit(200)}), schemas.LOG)


@query(f"""WITH {std.SONG_LOG} SELECT page, userId, firstName, level, CAST(sessionId AS BIGINT) AS sessionId,
  itemInSession, ts, song, artist, length, userAgent, CAST(200 AS BIGINT) AS status FROM log""")
def json_log_scan(spark, d):
    """Log files in month directories, read at any depth under the declared schema."""
    path = scratch_path(spark, "log-json")
    frame = _as_log(std.log(spark, d, with_songs=True))
    ts = F.timestamp_millis("ts")
    frame.withColumns({"y": F.year(ts), "m": F.month(ts)}).write.partitionBy("y", "m").json(path)
    columns = ["page", "userId", "firstName", "level", "sessionId", "itemInSession", "ts", "song", "artist", "length", "userAgent", "status"]
    return std.longs(sources.read_log(spark, path).select(*columns))


@query(f"""WITH {std.SONGS} SELECT song_id, title, artist_id, artist_name, artist_location, artist_latitude, artist_longitude,
  duration, CAST(year AS BIGINT) AS year FROM songs""")
def json_song_scan(spark, d):
    """Song files read under the declared schema."""
    path = scratch_path(spark, "song-json")
    std.songs(spark, d).write.json(path)
    frame = sources.read_songs(spark, path).drop("num_songs")
    return std.longs(frame.withColumns({c: F.col(c).cast("double") for c in ("artist_latitude", "artist_longitude")}))


@query(f"WITH {std.SONGS} SELECT song_id, title, duration, CAST(year AS BIGINT) AS year FROM songs")
def json_inferred_scan(spark, d):
    """Song files read with inferred types."""
    path = scratch_path(spark, "song-json")
    std.songs(spark, d).write.json(path)
    return sources.read_json(spark, path).select("song_id", "title", "duration", "year")


@query(f"""WITH {std.SONGS} SELECT song_id, title, artist_id, duration, CAST(year AS BIGINT) AS year,
  CAST(num_songs AS BIGINT) AS num_songs FROM songs""")
def json_by_name_load(spark, d):
    """Fields in any case go to the staged columns of the same name."""
    path = scratch_path(spark, "song-json")
    std.songs(spark, d).withColumnsRenamed({"song_id": "SONG_ID", "title": "Title"}).write.json(path)
    loaded = sources.read_by_name(spark, path, schemas.STAGED_SONGS)
    return std.longs(loaded.select("song_id", "title", "artist_id", "duration", "year", "num_songs"))


@query(f"""WITH {std.SONG_LOG} SELECT artist, firstName AS firstname, page, CAST(sessionId AS BIGINT) AS sessionid, ts,
  TRY_CAST(nullif(userId, '') AS BIGINT) AS userid, length FROM log""")
def json_mapped_load(spark, d):
    """Log files loaded through a list of source fields; the quoted user id becomes a number."""
    path = scratch_path(spark, "log-json")
    std.log(spark, d, with_songs=True).write.json(f"{path}/log")
    fields = [f.name for f in schemas.LOG.fields]
    rule = F.to_json(F.struct(F.array(*[F.lit(f"$['{name}']") for name in fields]).alias("jsonpaths")))
    spark.range(1).select(rule.alias("value")).write.text(f"{path}/mapping")
    mapping = sources.read_path_mapping(spark, f"{path}/mapping")
    staged = sources.read_mapped(spark, f"{path}/log", mapping, schemas.STAGED_EVENTS)
    return std.longs(staged.select("artist", "firstname", "page", "sessionid", "ts", "userid", "length"))


@query(f"""WITH {std.SONG_LOG} SELECT artist, firstName, gender, CAST(itemInSession AS VARCHAR) AS itemInSession, lastName, length, level,
  location, CAST(sessionId AS VARCHAR) AS sessionId, song, userId FROM log WHERE artist <> ''""")
def event_file_compaction(spark, d):
    """Event CSV files combined into one quoted CSV of the rows that name an artist."""
    path = scratch_path(spark, "event-csv")
    frame = _as_log(std.log(spark, d, with_songs=True)).select(*schemas.EVENT_CSV.fieldNames())
    frame.write.option("header", True).csv(path)
    sinks.write_quoted_csv(event_jobs.compact(sources.read_event_csv(spark, path)), f"{path}-compact")
    # the engines write a double's digits in different ways
    return sources.read_csv_text(spark, f"{path}-compact").withColumn("length", F.col("length").cast("double"))


@query("SELECT c_custkey, c_name, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment, c_acctbal FROM customer")
def tsv_bulk_load(spark, d):
    """Tab-separated rows with header and empty for NULL, written and read back."""
    path = scratch_path(spark, "tsv")
    frame = read_table(spark, d, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("c_mktsegment"), "c_acctbal"
    )
    sinks.write_tsv(frame, path)
    return sources.read_tsv(spark, path, frame.schema)


@query(f"WITH {std.SONG_LOG} SELECT song AS value, COUNT(*) AS count FROM log WHERE song IS NOT NULL GROUP BY song")
def song_line_count(spark, d):
    """One song title per text line, counted."""
    path = scratch_path(spark, "song-lines")
    plays = std.log(spark, d, with_songs=True).where("song IS NOT NULL")
    plays.select(F.col("song").alias("value")).write.text(path)
    return key_counts(sources.read_lines(spark, path))


@query("""SELECT event_type, MIN(event_id) AS event_id FROM events GROUP BY event_type""")
def first_record_per_file(spark, d):
    """The first record of each file, where files are sorted by event id; the earliest per type."""
    path = scratch_path(spark, "typed-json")
    rows = read_table(spark, d, "events").select("event_id", "event_type", F.col("event_type").alias("kind"))
    rows.sortWithinPartitions("kind", "event_id").write.partitionBy("kind").json(path)
    arrived = sources.with_arrival_order(sources.read_json(spark, path, rows.drop("kind").schema))
    first = first_row_per_key(arrived, ["_file"], [F.col("_block_start").asc(), F.col("_line").asc()])
    return first.groupBy("event_type").agg(F.min("event_id").alias("event_id"))


@query("""SELECT event_id, event_type, user_id, CAST(NULL AS VARCHAR) AS raw_text FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL, '{"event_id":' || event_id || ',broken' FROM events WHERE event_type = 'error'""")
def bad_record_quarantine(spark, d):
    """Lines that do not parse go to the quarantine with their text, all others load."""
    path = scratch_path(spark, "damaged-json")
    rows = read_table(spark, d, "events").select("event_id", "event_type", "user_id")
    damaged = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(",broken"))
    line = F.when(F.col("event_type") == "error", damaged).otherwise(F.to_json(F.struct(*rows.columns)))
    rows.select(line.alias("value")).write.text(path)
    good, bad = sources.split_bad_records(sources.read_json_checked(spark, path, rows.schema, files="*.txt"))
    return good.withColumn("raw_text", F.lit(None).cast("string")).unionByName(
        bad.select("raw_text"), allowMissingColumns=True
    )


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month, COUNT(*) AS orders,
  CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1, 2""")
def partitioned_write(spark, d):
    """Orders written in year and month directories and summed from them."""
    path = scratch_path(spark, "orders-by-month")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    orders = orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    sinks.write_parquet(orders, path, by=("year", "month"))
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    stored = spark.read.parquet(path)
    return std.longs(stored.groupBy("year", "month").agg(F.count("*").alias("orders"), cents.alias("cents")))


@query("SELECT c_nationkey, COUNT(*) AS rows FROM customer GROUP BY c_nationkey")
def partitioned_write_one_column(spark, d):
    """Customers written in one directory per nation and counted from them."""
    path = scratch_path(spark, "customer-by-nation")
    sinks.write_parquet(read_table(spark, d, "customer"), path, by=("c_nationkey",))
    return spark.read.parquet(path).groupBy("c_nationkey").agg(F.count("*").alias("rows"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def parquet_copy_once(spark, d):
    """A raw source is converted once; a second conversion leaves the copy as it is."""
    path = scratch_path(spark, "supplier-copy")
    sources.parquet_copy(spark, read_table(spark, d, "supplier"), path)
    return sources.parquet_copy(spark, read_table(spark, d, "supplier").where("s_suppkey < 0"), path)


@query("SELECT s_suppkey, s_name FROM supplier")
def full_refresh_stage(spark, d):
    """Staging twice for the same hour leaves one copy, below a path made from the run time."""
    template = scratch_path(spark, "stage") + "/{table}/{execution_date:%Y/%m/%d}"
    supplier = read_table(spark, d, "supplier").select("s_suppkey", "s_name")
    for _ in range(2):
        path = sinks.stage(supplier, template, datetime(2018, 11, 2), table="supplier")
    return spark.read.parquet(path)


@query(f"""WITH {std.SONGS} SELECT song_id, title, duration, artist_id, name FROM songs
  JOIN (SELECT artist_id, MIN(artist_name) AS name FROM songs GROUP BY artist_id) USING (artist_id)""")
def denormalise_join(spark, d):
    """Songs joined with their artists, stored as a named table that replaces the one before."""
    path = scratch_path(spark, "song-artist")
    songs = std.songs(spark, d)
    joined = star.song_lookup(star.songs(songs), star.artists(songs))
    for _ in range(2):
        sinks.materialise_as(joined, path, "song_artist")
    return spark.table("song_artist")


_EVENT_COLUMNS = """artist, firstName, gender, CAST(itemInSession AS VARCHAR) AS itemInSession, lastName, length, level, location,
  CAST(sessionId AS VARCHAR) AS sessionId, song, userId"""


_ANSWERS = f"""WITH {std.SONG_LOG}, e AS (SELECT {_EVENT_COLUMNS} FROM log WHERE artist <> '')
SELECT 'all' AS question, * FROM e UNION ALL SELECT 'listener', * FROM e WHERE song = 'small ring'
UNION ALL SELECT 'playlist', * FROM e WHERE userId = '8' AND sessionId = '801'"""


def _answers(by_session, by_user, by_song):
    answers = {
        "all": by_session,
        "listener": by_song.where(F.col("song") == "small ring"),
        "playlist": by_user.where("userId = '8' AND sessionId = 801"),
    }
    frames = [df.withColumn("question", F.lit(name)) for name, df in answers.items()]
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return rows.withColumns({c: F.col(c).cast("string") for c in ("itemInSession", "sessionId")})


@query(_ANSWERS)
def access_tables(spark, d):
    """The compacted events stored once per access pattern: all rows of one, and what two questions find in the others."""
    path = scratch_path(spark, "access")
    event_jobs.write_access_tables(event_jobs.compact(_as_log(std.log(spark, d, with_songs=True))), path)
    return _answers(*(spark.read.parquet(f"{path}/{name}") for name in event_jobs.ACCESS_ORDERS))


@query(_ANSWERS)
def access_one_copy(spark, d):
    """The same answers from one stored copy, in session order with Bloom filters of users and songs."""
    path = scratch_path(spark, "access")
    event_jobs.write_access_table(event_jobs.compact(_as_log(std.log(spark, d, with_songs=True))), path)
    return _answers(*[spark.read.parquet(path)] * 3)


@query(r"""SELECT code, MAX_BY(label, p_partkey) AS label, MIN(p_partkey) AS first_line
FROM (SELECT p_partkey, 'Brand#' || regexp_extract(line, '''(.*)''\s=\s''(.*)''', 1) AS code,
        trim(regexp_extract(line, '''(.*)''\s=\s''(.*)''', 2)) AS label, line
      FROM (SELECT p_partkey, '''' || substr(p_brand, 7) || '''' || CASE WHEN p_size = 1 THEN '  =' ELSE ' =' END
              || ' ''' || p_name || '  ''' AS line FROM part))
WHERE regexp_matches(line, '''(.*)''\s=\s''(.*)''')
GROUP BY code""")
def regex_extract_codes(spark, d):
    """Code lines `'code' = 'label'` of all parts; lines with other spacing do not match."""
    part = read_table(spark, d, "part")
    sign = F.when(F.col("p_size") == 1, "  =").otherwise(" =")
    number = F.expr("substr(p_brand, 7)")
    line = F.concat(F.lit("'"), number, F.lit("'"), sign, F.lit(" '"), F.col("p_name"), F.lit("  '"))
    lines = part.select("p_partkey", line.alias("value"))
    codes = parse_codes(lines, PORT_LINE, ["p_partkey"])
    first = lines.where(F.regexp_like("value", F.lit(PORT_LINE))).groupBy(
        F.regexp_extract("value", PORT_LINE, 1).alias("code")
    ).agg(F.min("p_partkey").alias("first_line"))
    return codes.join(first, "code").select(F.concat(F.lit("Brand#"), "code").alias("code"), "label", "first_line")


@query("""WITH labels AS (SELECT p_partkey AS k, 'P' || p_partkey AS code, p_name || ' ' || p_partkey AS label FROM part),
  terms AS (SELECT DISTINCT p_name || ' ' || (p_partkey // 10) AS term FROM part)
SELECT term, 'P' || MIN(k) AS code FROM terms LEFT JOIN labels ON contains(lower(label), lower(term)) GROUP BY term""")
def parsed_codes_lookup(spark, d):
    """Terms looked up in a code list that was parsed from the lines of several partitions."""
    part = read_table(spark, d, "part")
    quote = F.lit("'")
    label = F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))
    line = F.concat(quote, F.lit("P"), F.col("p_partkey").cast("string"), quote, F.lit(" = "), quote, label, quote)
    lines = part.select("p_partkey", line.alias("value")).repartition(8, "p_partkey")
    term = F.concat(F.col("p_name"), F.lit(" "), F.call_function("div", F.col("p_partkey"), F.lit(10)).cast("string"))
    return joins.first_label_containing(part.select(term.alias("term")), "term", parse_codes(lines, PORT_LINE, ["p_partkey"]))


_ADDRESSES = ", ".join(f"({i}, '{code}', '{label}')" for i, (code, label) in enumerate(ADDRESS_CODES.items()))


@query(f"""SELECT code, label, COUNT(*) AS customers FROM customer
  JOIN (VALUES {_ADDRESSES}) a(ordinal, code, label) ON ordinal = c_custkey % {len(ADDRESS_CODES)} GROUP BY ALL""")
def address_code_counts(spark, d):
    """The in-memory code list joined to a table."""
    customer = read_table(spark, d, "customer").select((F.col("c_custkey") % len(ADDRESS_CODES)).alias("ordinal"))
    return customer.join(address_codes(spark), "ordinal").groupBy("code", "label").agg(F.count("*").alias("customers"))
