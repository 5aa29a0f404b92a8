"""The activity log, song catalogue, arrivals and temperatures, as shaped from the test tables.

Each frame has its SQL counterpart, a CTE, next to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.sources.files import read_table


def text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def idiv(column: Column, n: int) -> Column:
    return F.call_function("div", column, F.lit(n))


def iso(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, the form in which both engines write them alike."""
    return df.select(
        *[F.col(n).cast("string").alias(n) if t in ("date", "timestamp", "timestamp_ntz") else F.col(n) for n, t in df.dtypes]
    )


def longs(df: DataFrame) -> DataFrame:
    """Integer columns as bigint."""
    return df.select(*[F.col(n).cast("bigint").alias(n) if t in ("int", "smallint", "tinyint") else F.col(n) for n, t in df.dtypes])


# The event types that stand for the play and the downgrade page.
PLAY, DOWNGRADE = "view", "error"


def log(spark: SparkSession, sf_dir: str, with_songs: bool = False) -> DataFrame:
    """`events` as an activity log; with songs, a play's song is the part its value points at."""
    events = read_table(spark, sf_dir, "events")
    user, kind = F.col("user_id"), F.col("event_type")
    columns = {
        "event_id": F.col("event_id"),
        "page": kind,
        "userId": F.when(kind == "signup", "").otherwise(user.cast("string")),
        "firstName": text("First", user % 7),
        "lastName": text("Last", user % 11),
        "gender": F.when(user % 2 == 0, "F").otherwise("M"),
        "level": F.when(F.col("value") >= 50, "paid").otherwise("free"),
        "sessionId": user * 100 + F.dayofmonth("ts"),
        "itemInSession": F.col("event_id") % 1000000,
        "ts": F.unix_millis(F.col("ts").cast("timestamp")),
        "location": text("Region ", user % 5),
        "userAgent": F.col("props"),
    }
    if with_songs:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
        events = events.join(part, F.round(F.col("value") * 100).cast("bigint") == F.col("p_partkey"), "left")
        played = kind == PLAY
        later = F.col("p_retailprice").cast("decimal(12,2)") + (F.col("event_id") % 3).cast("decimal(12,2)") * F.lit(0.25).cast("decimal(3,2)")
        columns |= {
            "song": F.when(played, F.col("p_name")),
            "artist": F.when(played, text("Artist ", idiv(F.col("p_partkey"), 3))),
            "length": F.when(played, later.cast("double")),
        }
    return events.select(*[c.alias(n) for n, c in columns.items()])


_LOG_COLUMNS = """event_id, event_type AS page,
    CASE WHEN event_type = 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END AS userId,
    'First' || (user_id % 7) AS firstName, 'Last' || (user_id % 11) AS lastName,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END AS level,
    user_id * 100 + day(ts) AS sessionId, event_id % 1000000 AS itemInSession, epoch_us(ts) // 1000 AS ts,
    'Region ' || (user_id % 5) AS location, props AS userAgent"""

LOG = f"log AS (SELECT {_LOG_COLUMNS} FROM events)"

SONG_LOG = f"""log AS (SELECT {_LOG_COLUMNS},
    CASE WHEN event_type = 'view' THEN p_name END AS song,
    CASE WHEN event_type = 'view' THEN 'Artist ' || (p_partkey // 3) END AS artist,
    CASE WHEN event_type = 'view' THEN CAST(CAST(p_retailprice AS DECIMAL(12,2))
         + CAST(event_id % 3 AS DECIMAL(12,2)) * 0.25 AS DOUBLE) END AS length
  FROM events LEFT JOIN part ON p_partkey = CAST(round(value * 100) AS BIGINT))"""


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as a song catalogue in which an artist has up to three songs."""
    artist = idiv(F.col("p_partkey"), 3)
    return read_table(spark, sf_dir, "part").select(
        F.lit(1).alias("num_songs"),
        text("SO", F.col("p_partkey")).alias("song_id"),
        F.col("p_name").alias("title"),
        text("AR", artist).alias("artist_id"),
        text("Artist ", artist).alias("artist_name"),
        F.col("p_brand").alias("artist_location"),
        (F.col("p_size") - 25).cast("double").alias("artist_latitude"),
        (F.col("p_size") * 2).cast("double").alias("artist_longitude"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


SONGS = """songs AS (SELECT 1 AS num_songs, 'SO' || p_partkey AS song_id, p_name AS title, 'AR' || (p_partkey // 3) AS artist_id,
    'Artist ' || (p_partkey // 3) AS artist_name, p_brand AS artist_location, CAST(p_size - 25 AS DOUBLE) AS artist_latitude,
    CAST(p_size * 2 AS DOUBLE) AS artist_longitude, p_retailprice AS duration, p_size AS year FROM part)"""


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`customer` as employees: id, dept and a salary with many ties."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("dept"),
        F.floor(F.col("c_acctbal") / 100).cast("bigint").alias("salary"),
    )


EMPLOYEES = """emp AS (SELECT c_custkey AS id, c_mktsegment AS dept, CAST(floor(c_acctbal / 100) AS BIGINT) AS salary FROM customer)"""


def arrival_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as an arrival: month of the order, address = order status, port = nation number."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("i94addr"),
        text("N", F.col("c_nationkey")).alias("i94port"),
    )


def port_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as ports, highest key first; those of region 4 are not listed."""
    return read_table(spark, sf_dir, "nation").where("n_regionkey <> 4").select(
        (100 - F.col("n_nationkey")).cast("bigint").alias("ordinal"),
        text("N", F.col("n_nationkey")).alias("code"),
        F.col("n_name").alias("label"),
    )


def address_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order statuses in use as address codes."""
    return read_table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("code")).distinct()


def temperature_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly quantity of returned lines by the supplier's nation, as text temperature rows.

    City is the nation's name in lower case, country its region.
    """
    lines = read_table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    monthly = (
        lines.select("l_suppkey", "l_quantity", "l_shipdate")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", F.date_format("l_shipdate", "yyyy-MM-01").alias("dt"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )
    return (
        monthly.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "dt",
            text(F.col("quantity"), ".125").alias("AverageTemperature"),
            F.lower("n_name").alias("City"),
            F.col("r_name").alias("Country"),
        )
    )


ARRIVAL_RECORDS = """records AS (SELECT CAST(year(o_orderdate) AS DOUBLE) AS i94yr, CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
    nullif(o_orderstatus, 'P') AS i94addr, 'N' || c_nationkey AS i94port FROM orders JOIN customer ON o_custkey = c_custkey)"""

PORT_LIST = """ports AS (SELECT CAST(100 - n_nationkey AS BIGINT) AS ordinal, 'N' || n_nationkey AS code, n_name AS label
    FROM nation WHERE n_regionkey <> 4)"""

TEMPERATURE_RECORDS = """trecords AS (SELECT dt, quantity || '.125' AS AverageTemperature, lower(n_name) AS City, r_name AS Country
    FROM (SELECT s_nationkey, strftime(l_shipdate, '%Y-%m-01') AS dt, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY 1, 2)
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def lines_sql(table: str, columns: str, source: str) -> str:
    """SELECT of a table's rows as text, as `as_lines` writes them; the columns in name order, apart by semicolons."""
    values = ", ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), '')" for c in columns.split(";"))
    return f"SELECT '{table}' AS \"table\", concat_ws('|', {values}) AS row FROM {source}"


def as_lines(loaded: dict[str, DataFrame]) -> DataFrame:
    """The rows of several tables as (table, row), columns in name order."""
    parts = [
        df.select(
            F.lit(name).alias("table"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]).alias("row"),
        )
        for name, df in loaded.items()
    ]
    return reduce(DataFrame.unionByName, parts)
