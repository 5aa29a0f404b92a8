"""Quality checks, as their result rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlog.operators import quality as dq
from starlog.operators.aggregates import duplicate_keys
from starlog.operators.measures import PartitionMeasures
from starlog.registry import query
from starlog.registry import standins as std
from starlog.session import scratch_path
from starlog.sinks.files import write_parquet
from starlog.sources.files import read_table


def _sql(check, subject, measured, comparison, expected, test):
    return (
        f"SELECT '{check}' AS \"check\", '{subject}' AS subject, measured, '{comparison}' AS comparison, "
        f"CAST({expected} AS BIGINT) AS expected, {test} AS passed FROM (SELECT CAST(({measured}) AS BIGINT) AS measured)"
    )


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(" UNION ALL ".join(_sql("row_count", t, f"SELECT COUNT(*) FROM {t}", ">", 0, "measured > 0") for t in _TABLES))
def dq_row_counts(spark, d):
    return dq.run_checks([dq.row_count(t, read_table(spark, d, t)) for t in _TABLES])


@query(_sql("row_count", "missing orders", "SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'X'", ">=", 0, "measured >= 0"))
def dq_row_count_at_least(spark, d):
    """An empty table passes when zero rows are enough."""
    none = read_table(spark, d, "orders").where("o_orderstatus = 'X'")
    return dq.run_checks([dq.row_count("missing orders", none, ">=", 0)])


@query(_sql("same_count", "lines and orders", "SELECT COUNT(*) FROM lineitem", "=", "(SELECT COUNT(*) FROM orders)",
            "measured = (SELECT COUNT(*) FROM orders)"))
def dq_count_match(spark, d):
    lines, orders = read_table(spark, d, "lineitem"), read_table(spark, d, "orders")
    return dq.run_checks([dq.same_count("lines and orders", lines, orders)])


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def dq_duplicate_keys(spark, d):
    return std.longs(duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query(" UNION ALL ".join([
    _sql("no_nulls", "orders(o_orderkey, o_custkey)", "SELECT COUNT(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL", "=", 0, "measured = 0"),
    _sql("unique_key", "lineitem(l_orderkey, l_linenumber)", "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)", "=", 0, "measured = 0"),
    _sql("unique_key", "orders(o_orderkey)", "SELECT COUNT(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1)", "=", 0, "measured = 0"),
    _sql("no_orphans", "orders(o_custkey)", "SELECT COUNT(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)", "=", 0, "measured = 0"),
    _sql("no_orphans", "events(user_id)", "SELECT COUNT(*) FROM events WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)", "=", 0, "measured = 0"),
]))
def dq_constraints(spark, d):
    """NOT NULL, key and reference checks; some are meant to fail."""
    orders, customer = read_table(spark, d, "orders"), read_table(spark, d, "customer")
    events, supplier = read_table(spark, d, "events"), read_table(spark, d, "supplier")
    return dq.run_checks([
        dq.no_nulls("orders", orders, ["o_orderkey", "o_custkey"]),
        dq.unique_key("lineitem", read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        dq.unique_key("orders", orders, ["o_orderkey"]),
        dq.no_orphans("orders", orders, "o_custkey", customer, "c_custkey"),
        dq.no_orphans("events", events, "user_id", supplier, "s_suppkey"),
    ])


@query("""WITH o AS (SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders
    WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, '2030-01' FROM orders WHERE o_orderstatus = 'P')
SELECT 'o_orderkey' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT(o_orderkey) AS nulls, CAST(MIN(o_orderkey) AS VARCHAR) AS low,
  CAST(MAX(o_orderkey) AS VARCHAR) AS high, CAST(NULL AS BOOLEAN) AS passed FROM o
UNION ALL SELECT 'o_custkey', COUNT(*), COUNT(*) - COUNT(o_custkey), CAST(MIN(o_custkey) AS VARCHAR), CAST(MAX(o_custkey) AS VARCHAR), NULL FROM o
UNION ALL SELECT 'row_count', COUNT(*), NULL, NULL, NULL, COUNT(*) > 0 FROM o
UNION ALL SELECT 'no_nulls', COUNT(*) FILTER (o_custkey IS NULL), NULL, NULL, NULL, COUNT(*) FILTER (o_custkey IS NULL) = 0 FROM o
UNION ALL SELECT 'unique_key', 0, NULL, NULL, NULL, TRUE""")
def dq_incremental(spark, d):
    """Orders by month, measured month by month; a month that is delivered later is the only one then read."""
    path = scratch_path(spark, "orders")
    orders = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    first = orders.where("o_orderstatus <> 'P'").withColumn("o_custkey", F.nullif("o_custkey", F.lit(7)))
    late = orders.where("o_orderstatus = 'P'").withColumn("month", F.lit("2030-01"))
    kept = PartitionMeasures(spark, path, f"{path}-measures", ["o_orderkey", "o_custkey"], ["o_custkey"], ["month", "o_orderkey"])
    for part in (first, late):
        write_parquet(part.drop("o_orderstatus"), path, by=("month",), mode="append")
        kept.refresh()
    checks = kept.checks("orders").select(F.col("check").alias("column"), F.col("measured").alias("rows"), "passed")
    return kept.totals().unionByName(checks, allowMissingColumns=True)
