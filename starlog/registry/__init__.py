"""Every operator and job as a query over the test tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starlog.session import fit_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its SQL."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            fit_shuffles(spark, sf_dir)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return run

    return register


def load_all() -> None:
    """Import the modules that register queries."""
    from starlog.registry import aggregates, damage, expressions, joins, loads, quality, reports, scans, star, windows  # noqa: F401
