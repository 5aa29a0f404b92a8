"""Immigration and temperature jobs."""

from __future__ import annotations

import uuid

from starlog.plans import immigration as imm
from starlog.registry import query
from starlog.registry import standins as std
from starlog.session import scratch_path

_ARRIVALS = f"""{std.ARRIVAL_RECORDS}, {std.PORT_LIST}, arrivals AS (
  SELECT make_date(CAST(i94yr AS INT), CAST(i94mon AS INT), 1) AS dt, i94addr, i94port FROM records
  WHERE i94addr IN (SELECT o_orderstatus FROM orders) AND i94port IN (SELECT code FROM ports))"""

_TEMPERATURES = f"""{std.TEMPERATURE_RECORDS}, temps AS (
  SELECT dt, Country, City, round(t, 2) AS AverageTemperature, i94port FROM (
    SELECT CAST(dt AS DATE) AS dt, Country, City, CAST(AverageTemperature AS DOUBLE) AS t,
      (SELECT arg_min(code, ordinal) FROM ports WHERE contains(lower(label), lower(City))) AS i94port FROM trecords
    WHERE Country = 'AMERICA' AND dt >= '1997-01-01' AND dt < '1999-01-01') WHERE i94port IS NOT NULL)"""


def _arrivals(spark, d):
    return imm.arrivals(std.arrival_records(spark, d), std.port_list(spark, d), std.address_list(spark, d))


def _temperatures(spark, d):
    rows = imm.country_temperatures(std.temperature_records(spark, d), "AMERICA", "1997-01-01", "1999-01-01")
    return imm.temperatures(rows, std.port_list(spark, d))


@query(f"WITH {_ARRIVALS} SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM arrivals")
def immigration_dim(spark, d):
    return std.iso(_arrivals(spark, d))


@query(f"WITH {std.PORT_LIST}, {_TEMPERATURES} SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM temps")
def temperature_dim(spark, d):
    return std.iso(_temperatures(spark, d))


@query(f"""WITH {_ARRIVALS}, {_TEMPERATURES} SELECT CAST(a.dt AS VARCHAR) AS dt, a.i94port, AverageTemperature
FROM arrivals a LEFT JOIN temps t ON a.i94port = t.i94port AND a.dt = t.dt""")
def fact_left_2key(spark, d):
    return std.iso(imm.arrival_facts(_arrivals(spark, d), _temperatures(spark, d)))


@query(f"""WITH {_ARRIVALS}, {_TEMPERATURES} SELECT CAST(a.dt AS VARCHAR) AS dt, a.i94port, AverageTemperature
FROM arrivals a LEFT JOIN temps t ON a.i94port = t.i94port AND a.dt = t.dt""")
def fact_co_located(spark, d):
    """The same from tables stored in the same buckets, where a port and date of over 100 arrivals is cut into shares."""
    run = uuid.uuid4().hex
    names = f"arrivals_{run}", f"temperatures_{run}"
    out = scratch_path(spark, "co-located")
    return std.iso(imm.co_located_facts(spark, _arrivals(spark, d), _temperatures(spark, d), out, names, buckets=8, hot_rows=100))


@query(f"""WITH {_ARRIVALS}, {_TEMPERATURES} SELECT CAST(a.dt AS VARCHAR) AS dt, a.i94port, AverageTemperature
FROM arrivals a LEFT JOIN temps t ON a.i94port = t.i94port AND month(a.dt) = month(t.dt)""")
def fact_month_of_year(spark, d):
    return std.iso(imm.arrival_facts(_arrivals(spark, d), _temperatures(spark, d), "month_of_year"))


def _rows(on):
    """The rows of the three tables, and the checks on them, as text."""
    fact = f"arrivals a LEFT JOIN temps t ON a.i94port = t.i94port AND {on}"
    arrived = "(SELECT COUNT(*) FROM arrivals)"
    checks = " UNION ALL ".join(
        f"SELECT {values} FROM (SELECT ({measured}) AS m)"
        for values, measured in [
            ("'row_count' AS c, '>' AS o, 0 AS e, m, m > 0 AS p, 'immigration' AS s", "SELECT COUNT(*) FROM arrivals"),
            ("'row_count', '>', 0, m, m > 0, 'temperature'", "SELECT COUNT(*) FROM temps"),
            ("'row_count', '>', 0, m, m > 0, 'fact'", f"SELECT COUNT(*) FROM {fact}"),
            (f"'same_count', '=', {arrived}, m, m = {arrived}, 'fact and immigration'", f"SELECT COUNT(*) FROM {fact}"),
            ("'no_nulls', '=', 0, m, m = 0, 'fact(dt, i94port)'", "SELECT 0"),
        ]
    )
    return " UNION ALL ".join([
        std.lines_sql("immigration", "dt; i94addr; i94port", "arrivals"),
        std.lines_sql("temperature", "AverageTemperature; City; Country; dt; i94port", "temps"),
        std.lines_sql("fact", "AverageTemperature; dt; i94port", f"(SELECT a.dt, a.i94port, AverageTemperature FROM {fact})"),
        std.lines_sql("checks", "c; o; e; m; p; s", f"({checks})"),
    ])


def _written(spark, d, align):
    out = scratch_path(spark, "immigration")
    checks = imm.write_arrivals(spark, _arrivals(spark, d), _temperatures(spark, d), out, align=align)
    return std.as_lines({name: spark.read.parquet(f"{out}/{name}") for name in ("immigration", "temperature", "fact")} | {"checks": checks})


@query(f"WITH {_ARRIVALS}, {_TEMPERATURES} {_rows('a.dt = t.dt')}")
def immigration_load(spark, d):
    """The three tables written by port, read back, and the checks on what was written."""
    return _written(spark, d, "date")


@query(f"WITH {_ARRIVALS}, {_TEMPERATURES} {_rows('month(a.dt) = month(t.dt)')}")
def immigration_load_fan_out(spark, d):
    """The same matched by month of year, where the count check finds the repeated arrivals."""
    return _written(spark, d, "month_of_year")
