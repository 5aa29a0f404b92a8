"""Projections, filters and scalar functions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from starlog.functions import calendar as cal
from starlog.functions import values as val
from starlog.operators import filters
from starlog.plans import events as event_jobs

from starlog.registry import query
from starlog.registry import standins as std
from starlog.sources.files import newest, read_table


@query("SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment FROM customer")
def project_subset(spark, d):
    return read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(1 - l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS net_price
FROM lineitem""")
def derive_columns(spark, d):
    net = F.col("l_extendedprice").cast("decimal(14,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    return lines.withColumn("net_price", F.round(net, 2).cast("double")).drop("l_extendedprice", "l_discount")


@query(f"WITH {std.LOG} SELECT event_id, userId, sessionId, ts FROM log WHERE page = 'view'")
def filter_event(spark, d):
    return filters.on_page(std.log(spark, d), std.PLAY).select("event_id", "userId", "sessionId", "ts")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'error' AND value > 10")
def filter_sql_text(spark, d):
    return read_table(spark, d, "events").where("event_type = 'error' AND value > 10").select("event_id", "user_id")


def _with_null_type(spark, d):
    return read_table(spark, d, "events").select(
        "event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif(F.col("user_id") % 10, F.lit(3)).alias("tenth"),
    )


@query("SELECT event_id, event_type FROM events WHERE nullif(event_type, 'error') IS NOT NULL")
def filter_not_null(spark, d):
    return _with_null_type(spark, d).where(F.col("event_type").isNotNull()).select("event_id", "event_type")


@query("""SELECT event_id, event_type, nullif(user_id % 10, 3) AS tenth FROM events
WHERE nullif(event_type, 'error') IS NOT NULL AND nullif(user_id % 10, 3) IS NOT NULL""")
def dropna_any(spark, d):
    return filters.complete(_with_null_type(spark, d), ["event_type", "tenth"]).drop("user_id")


@query("SELECT event_id, event_type FROM events WHERE replace(event_type, 'error', '') <> ''")
def filter_not_empty(spark, d):
    emptied = read_table(spark, d, "events").select(
        "event_id", F.regexp_replace("event_type", "error", "").alias("event_type")
    )
    return filters.non_empty(emptied, "event_type")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_in_list(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return filters.in_list(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders
WHERE o_orderdate >= DATE '1998-04-01' AND o_orderdate < DATE '1998-05-01'""")
def filter_date_range(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    april = filters.date_range(orders, "o_orderdate", "1998-04-01", "1998-05-01")
    return std.iso(april.withColumn("o_orderdate", F.to_date("o_orderdate")))


@query(f"WITH {std.LOG} SELECT userId, firstName, page, level FROM log WHERE userId = '46'")
def point_lookup(spark, d):
    return std.log(spark, d).where("userId = '46'").select("userId", "firstName", "page", "level")


@query(f"WITH {std.SONG_LOG} SELECT artist, song, length FROM log WHERE sessionId = 801 AND itemInSession = 0")
def session_item_lookup(spark, d):
    return event_jobs.session_item(std.log(spark, d, with_songs=True), 801, 0)


@query(f"""WITH {std.SONG_LOG} SELECT itemInSession, artist, song, firstName, lastName FROM log
WHERE userId = '8' AND sessionId = 801 ORDER BY itemInSession""")
def session_playlist(spark, d):
    return event_jobs.session_playlist(std.log(spark, d, with_songs=True), "8", 801).withColumn(
        "itemInSession", F.col("itemInSession").cast("bigint")
    )


@query(f"WITH {std.SONG_LOG} SELECT DISTINCT userId, firstName, lastName FROM log WHERE song = 'small ring'")
def song_listeners(spark, d):
    return event_jobs.song_listeners(std.log(spark, d, with_songs=True), "small ring")


@query("""SELECT event_id, CAST(make_timestamp(epoch_us(ts) // 1000 * 1000) AS VARCHAR) AS time_stamp FROM events""")
def epoch_ms_to_ts(spark, d):
    frame = std.log(spark, d).select("event_id", cal.from_epoch_ms(F.col("ts")).alias("time_stamp"))
    return std.iso(frame)


@query("""SELECT event_id, CAST(make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS VARCHAR) AS start_time FROM events""")
def epoch_ms_to_sec_ts(spark, d):
    frame = std.log(spark, d).select("event_id", cal.from_epoch_ms_whole_seconds(F.col("ts")).alias("start_time"))
    return std.iso(frame)


@query("""SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, hour(ts) AS hour, day(ts) AS day, week(ts) AS week,
  month(ts) AS month, year(ts) AS year, isodow(ts) - 1 AS weekday, dayofweek(ts) AS weekday_sunday0 FROM events""")
def calendar_fields(spark, d):
    ts = F.col("ts")
    parts = cal.calendar_parts(ts) | {"date": F.to_date(ts), "weekday_sunday0": cal.weekday_sunday0(ts)}
    events = read_table(spark, d, "events")
    return std.longs(std.iso(events.select("event_id", *[c.alias(n) for n, c in parts.items()])))


@query("SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%H:%M:%S.%g') AS time_of_day FROM events")
def time_of_day(spark, d):
    ts = cal.from_epoch_ms(F.col("ts"))
    return std.log(spark, d).select("event_id", cal.time_of_day(ts).alias("time_of_day"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS dt
FROM orders""")
def parse_date(spark, d):
    orders = read_table(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return std.iso(orders.select("o_orderkey", cal.parse_date(text).alias("dt")))


@query("""SELECT o_orderkey, CAST(make_date(year(o_orderdate), month(o_orderdate), 1) AS VARCHAR) AS dt FROM orders""")
def month_start_date(spark, d):
    orders = read_table(spark, d, "orders")
    year, month = F.year("o_orderdate").cast("double"), F.month("o_orderdate").cast("double")
    return std.iso(orders.select("o_orderkey", cal.month_start(year, month).alias("dt")))


@query(f"""WITH {std.LOG} SELECT event_id,
  md5(CAST(sessionId AS VARCHAR) || CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR)) AS playid FROM log""")
def md5_play_id(spark, d):
    start = cal.from_epoch_ms_whole_seconds(F.col("ts"))
    return std.log(spark, d).select("event_id", val.md5_key(F.col("sessionId"), start).alias("playid"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS tax FROM lineitem""")
def round_2(spark, d):
    tax = F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_tax").cast("decimal(4,2)")
    return read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(tax, 2).cast("double").alias("tax")
    )


@query(f"""WITH {std.LOG} SELECT event_id, TRY_CAST(nullif(userId, '') AS BIGINT) AS user_id, CAST(sessionId AS VARCHAR) AS session,
  CAST(ts AS DOUBLE) AS ts_double, substr(page, 1, 4) AS page4 FROM log""")
def cast_types(spark, d):
    return std.longs(
        std.log(spark, d).select(
            "event_id",
            val.user_number(F.col("userId")).alias("user_id"),
            F.col("sessionId").cast("string").alias("session"),
            F.col("ts").cast("double").alias("ts_double"),
            val.varchar(F.col("page"), 4).alias("page4"),
        )
    )


@query("""SELECT p_partkey, CAST(trunc(p_retailprice) AS BIGINT) AS truncated, CAST(CAST(p_retailprice AS DECIMAL(18,0)) AS BIGINT) AS rounded
FROM part""")
def drop_fraction_modes(spark, d):
    price = F.col("p_retailprice")
    return read_table(spark, d, "part").select(
        "p_partkey",
        val.drop_fraction(price).cast("bigint").alias("truncated"),
        val.drop_fraction(price, "round").cast("bigint").alias("rounded"),
    )


@query(f"WITH {std.LOG} SELECT event_id, CASE WHEN page = 'error' THEN 1 ELSE 0 END AS downgrade FROM log")
def flag_event(spark, d):
    return std.log(spark, d).select("event_id", val.event_flag(F.col("page"), std.DOWNGRADE).alias("downgrade"))


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS user_key FROM customer")
def surrogate_key(spark, d):
    from starlog.operators.windows import number_rows

    people = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return number_rows(people, ["c_acctbal", "c_custkey"], "user_key", start=0).drop("c_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey"
    )


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_n(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey").limit(5)


@query("SELECT event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events ORDER BY events.ts DESC, event_id LIMIT 5")
def topk_recent(spark, d):
    events = read_table(spark, d, "events").select("event_id", "event_type", "ts")
    return std.iso(newest(events, "ts", 5, ties=("event_id",)))


@query("SELECT c_custkey, TRUE AS is_now, TRUE AS same_second FROM customer")
def load_stamped(spark, d):
    """Rows marked with the time of their load and its epoch, which tell the same second."""
    started = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    rows = read_table(spark, d, "customer").select("c_custkey").withColumns(cal.load_stamp())
    late = F.unix_seconds("loaded_at") - F.unix_seconds(started)
    return rows.select(
        "c_custkey", late.between(-1, 3600).alias("is_now"), (F.unix_seconds("loaded_at") == F.col("loaded_epoch")).alias("same_second")
    )
