"""Counts, statistics, distinct rows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlog.operators import aggregates as agg
from starlog.operators.dedupe import first_row_per_key
from starlog.plans import events as event_jobs
from starlog.registry import query
from starlog.registry import standins as std
from starlog.sources.files import read_table


@query("SELECT COUNT(*) AS rows FROM lineitem")
def count_rows(spark, d):
    return read_table(spark, d, "lineitem").agg(F.count("*").alias("rows"))


@query("""SELECT COUNT(*) FILTER (nullif(event_type, 'error') IS NULL) AS event_type_nulls,
  COUNT(*) FILTER (nullif(user_id % 10, 3) IS NULL) AS tenth_nulls,
  COUNT(*) FILTER (nullif(event_type, 'error') IS NULL OR nullif(user_id % 10, 3) IS NULL) AS any_null FROM events""")
def count_nulls(spark, d):
    frame = read_table(spark, d, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type"), F.nullif(F.col("user_id") % 10, F.lit(3)).alias("tenth")
    )
    return agg.count_nulls(frame, ["event_type", "tenth"])


@query(f"WITH {std.LOG} SELECT userId, MAX(ts) AS ts FROM log WHERE page = 'view' GROUP BY userId")
def group_max(spark, d):
    plays = std.log(spark, d).where("page = 'view'")
    return plays.groupBy("userId").agg(F.max("ts").alias("ts"))


@query("""SELECT nullif(event_type, 'error') AS value, COUNT(nullif(event_type, 'error')) AS count FROM events GROUP BY 1""")
def value_counts(spark, d):
    frame = read_table(spark, d, "events").select(F.nullif("event_type", F.lit("error")).alias("event_type"))
    return agg.value_counts(frame, "event_type")


@query("SELECT CAST(value AS VARCHAR) AS value, COUNT(*) AS count FROM events GROUP BY 1 ORDER BY count, value LIMIT 20")
def rarest_values(spark, d):
    """The twenty rarest values."""
    cents = read_table(spark, d, "events").select(F.col("value").cast("string").alias("value"))
    return agg.value_counts(cents, "value").limit(20)


@query("SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY o_orderpriority")
def group_count(spark, d):
    return read_table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("count"))


@query("SELECT hour(ts) AS hour, COUNT(*) AS count FROM events WHERE event_type = 'view' GROUP BY 1")
def plays_per_hour(spark, d):
    return std.longs(event_jobs.plays_per_hour(std.log(spark, d), std.PLAY))


@query("""SELECT word AS value, COUNT(*) AS count FROM
  (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def song_count(spark, d):
    """How often each word occurs in the documents."""
    words = read_table(spark, d, "documents").select(F.explode(F.split("text", r"\s+")).alias("value"))
    return agg.key_counts(words.where("value <> ''"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, d):
    return read_table(spark, d, "events").select("user_id", "event_type").distinct()


@query(f"WITH {std.LOG} SELECT DISTINCT page FROM log ORDER BY page")
def distinct_sorted(spark, d):
    return std.log(spark, d).select("page").dropDuplicates().sort("page")


@query(f"""WITH {std.LOG}
SELECT 'page' AS "column", COUNT(page) AS count, NULL AS mean, NULL AS stddev, MIN(page) AS min, MAX(page) AS max FROM log
UNION ALL SELECT 'sessionId', COUNT(sessionId), round(AVG(sessionId), 4), round(stddev_samp(sessionId), 4),
  CAST(MIN(sessionId) AS VARCHAR), CAST(MAX(sessionId) AS VARCHAR) FROM log""")
def describe_stats(spark, d):
    stats = agg.summary(std.log(spark, d), ["page", "sessionId"])
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM
  (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
     row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, lineitem.l_shipdate) AS n FROM lineitem)
WHERE n = 1""")
def dedupe_row_number(spark, d):
    lines = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("l_shipdate")
    )
    return std.iso(first_row_per_key(lines, ["l_orderkey", "l_linenumber"], [F.col("l_partkey").asc_nulls_last()]))


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity FROM
  (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS n FROM lineitem)
WHERE n = 1""")
def first_per_group(spark, d):
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return std.longs(first_row_per_key(lines, ["l_orderkey"], [F.col("l_linenumber").asc()]))


_LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, COUNT({c}) AS count FROM lineitem GROUP BY {c}""" for c in _LINE
))
def profile_columns(spark, d):
    """The values of every column of a table with how often each occurs."""
    return agg.profile_columns(read_table(spark, d, "lineitem"))


_SEVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {t}" for t in _SEVEN))
def union_all_counts(spark, d):
    return agg.table_counts({name: read_table(spark, d, name) for name in _SEVEN})


@query("SELECT 'named_orders' AS \"table\", COUNT(*) AS rows FROM orders UNION ALL SELECT 'named_events', COUNT(*) FROM events")
def named_table_counts(spark, d):
    """Views counted by name."""
    read_table(spark, d, "orders").createOrReplaceTempView("named_orders")
    read_table(spark, d, "events").createOrReplaceTempView("named_events")
    return agg.named_table_counts(spark, ["named_orders", "named_events"])
