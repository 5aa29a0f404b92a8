"""Arrivals by port and month, joined with city temperatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.functions.calendar import month_start, parse_date
from starlog.operators import quality
from starlog.operators.filters import complete, date_range
from starlog.operators.joins import add_first_label, keep_listed
from starlog.schemas import ARRIVAL_FACTS, ARRIVALS, TEMPERATURES, conform
from starlog.sinks.co_located import join_co_located, write_co_located
from starlog.sinks.files import write_parquet


def arrivals(records: DataFrame, ports: DataFrame, addresses: DataFrame) -> DataFrame:
    """Arrivals with a valid port and address code, dated to the first of their month."""
    known = complete(records.select("i94yr", "i94mon", "i94addr", "i94port"), ["i94yr", "i94mon", "i94addr", "i94port"])
    known = keep_listed(keep_listed(known, ports, "i94port"), addresses, "i94addr")
    return known.select(
        month_start(F.col("i94yr"), F.col("i94mon")).alias("dt"),
        "i94addr",
        "i94port",
    )


def country_temperatures(
    records: DataFrame, country: str = "United States", start: str = "2013-04-01", end: str = "2013-05-01"
) -> DataFrame:
    """One country's temperature rows with start <= dt < end; dates and numbers are read from text."""
    rows = records.where(F.col("Country") == country).select(
        parse_date(F.col("dt")).alias("dt"),
        "Country",
        "City",
        F.col("AverageTemperature").try_cast("double").alias("AverageTemperature"),
    )
    return date_range(rows, "dt", start, end)


def temperatures(rows: DataFrame, ports: DataFrame) -> DataFrame:
    """Complete temperature rows with the first port whose label contains the city, to two places."""
    located = add_first_label(rows, "City", ports, "i94port")
    return complete(located, ["dt", "Country", "City", "AverageTemperature", "i94port"]).select(
        "dt",
        "Country",
        "City",
        F.round("AverageTemperature", 2).alias("AverageTemperature"),
        "i94port",
    )


def arrival_facts(arrived: DataFrame, temps: DataFrame, align: str = "date") -> DataFrame:
    """Every arrival with the temperatures of its port at its date, or NULL.

    `align="month_of_year"` matches the calendar month whatever the year. An arrival is repeated
    for each city that shares its port.
    """
    if align == "date":
        return arrived.select("dt", "i94port").join(
            temps.select("dt", "i94port", "AverageTemperature"), ["i94port", "dt"], "left"
        ).select("dt", "i94port", "AverageTemperature")
    if align == "month_of_year":
        left = arrived.select("dt", "i94port", F.month("dt").alias("_month"))
        right = temps.select(F.month("dt").alias("_month"), "i94port", "AverageTemperature")
        return left.join(right, ["i94port", "_month"], "left").select("dt", "i94port", "AverageTemperature")
    raise ValueError(f"unknown alignment {align!r}")


def co_located_facts(
    spark: SparkSession, arrived: DataFrame, temps: DataFrame, out: str, names: tuple[str, str], buckets: int = 64, hot_rows: int = 1_000_000
) -> DataFrame:
    """`arrival_facts` by date over both tables stored in the same buckets, which join without an exchange."""
    keys = ["i94port", "dt"]
    weather = temps.select(*keys, "AverageTemperature")
    write_co_located(arrived.select(*keys), weather, keys, names, out, buckets, hot_rows)
    return join_co_located(spark, names, keys).select("dt", "i94port", "AverageTemperature")


def write_arrivals(
    spark: SparkSession, arrived: DataFrame, temps: DataFrame, out: str, align: str = "date"
) -> DataFrame:
    """Write immigration, temperature and fact tables by port, then check them and return the results.

    The checks read the written tables: none is empty, the fact holds one row per arrival, and its
    key columns hold no NULL. The tables are also named as views for SQL.
    """
    arrived, temps = conform(arrived, ARRIVALS), conform(temps, TEMPERATURES)
    write_parquet(arrived, f"{out}/immigration", by=("i94port",))
    write_parquet(temps, f"{out}/temperature", by=("i94port",))
    immigration = spark.read.schema(arrived.schema).parquet(f"{out}/immigration")
    temperature = spark.read.schema(temps.schema).parquet(f"{out}/temperature")
    facts = conform(arrival_facts(immigration, temperature, align), ARRIVAL_FACTS)
    write_parquet(facts, f"{out}/fact", by=("i94port",))
    fact = spark.read.schema(facts.schema).parquet(f"{out}/fact")
    tables = {"immigration": immigration, "temperature": temperature, "fact": fact}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return quality.run_checks(
        [
            *[quality.row_count(name, table) for name, table in tables.items()],
            quality.same_count("fact and immigration", fact, immigration),
            quality.no_nulls("fact", fact, ARRIVAL_FACTS.required),
        ]
    )
