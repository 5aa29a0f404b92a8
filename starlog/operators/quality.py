"""Declarative quality checks.

Each check is a one-row DataFrame (check, subject, measured, comparison, expected, passed);
`run_checks` unions them and `require` raises on failures. `passed` is false for a NULL measure.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlog.operators.aggregates import duplicate_keys
from starlog.operators.joins import orphans
from starlog.schemas import Contract

COMPARISONS = {
    ">": operator.gt,
    ">=": operator.ge,
    "=": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
}


class QualityError(ValueError):
    """A quality check failed."""


def _check(measure: DataFrame, check: str, subject: str, comparison: str, expected) -> DataFrame:
    target = expected if comparison in COMPARISONS and hasattr(expected, "isNull") else F.lit(expected)
    compared = COMPARISONS[comparison](F.col("measured"), target.cast("bigint"))
    return measure.select(
        F.lit(check).alias("check"),
        F.lit(subject).alias("subject"),
        F.col("measured").cast("bigint").alias("measured"),
        F.lit(comparison).alias("comparison"),
        target.cast("bigint").alias("expected"),
        F.coalesce(compared, F.lit(False)).alias("passed"),
    )


def row_count(name: str, df: DataFrame, comparison: str = ">", expected: int = 0) -> DataFrame:
    """The table's row count compared with a number."""
    return _check(df.agg(F.count("*").alias("measured")), "row_count", name, comparison, expected)


def same_count(name: str, fact: DataFrame, other: DataFrame) -> DataFrame:
    """Fact and dimension hold equally many rows."""
    sides = fact.select(F.lit(1).alias("f"), F.lit(0).alias("d")).unionAll(other.select(F.lit(0), F.lit(1)))
    counts = sides.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("measured"), F.coalesce(F.sum("d"), F.lit(0)).alias("d"))
    return _check(counts, "same_count", name, "=", F.col("d"))


def no_nulls(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """No row has a NULL in any of the columns."""
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return _check(df.agg(F.count_if(null).alias("measured")), "no_nulls", f"{name}({', '.join(columns)})", "=", 0)


def unique_key(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """No key is held by two rows."""
    repeated = duplicate_keys(df, keys).agg(F.count("*").alias("measured"))
    return _check(repeated, "unique_key", f"{name}({', '.join(keys)})", "=", 0)


def no_orphans(name: str, df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Every non-NULL foreign key has a parent."""
    missing = orphans(df, column, parent, parent_key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("measured"))
    return _check(missing, "no_orphans", f"{name}({column})", "=", 0)


def nulls_and_key(name: str, df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """`no_nulls` and `unique_key` from one aggregation: the NULLs are counted within the keys."""
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    by_key = df.groupBy(*keys).agg(F.count("*").alias("_rows"), F.count_if(null).alias("_nulls"))
    measures = by_key.agg(
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("no_nulls"),
        F.count_if(F.col("_rows") > 1).alias("unique_key"),
    )
    named = {"no_nulls": columns, "unique_key": keys}
    rows = [
        F.struct(F.lit(c).alias("check"), F.lit(f"{name}({', '.join(n)})").alias("subject"), F.col(c).alias("measured"))
        for c, n in named.items()
    ]
    return measures.select(F.inline(F.array(*rows))).select(
        "check",
        "subject",
        "measured",
        F.lit("=").alias("comparison"),
        F.lit(0).cast("bigint").alias("expected"),
        (F.col("measured") == 0).alias("passed"),
    )


def contract_checks(df: DataFrame, contract: Contract, tables: dict[str, tuple[DataFrame, str]] | None = None):
    """The checks a contract declares: NOT NULL columns, key, and references into `tables`.

    `tables` maps a table name to (DataFrame, key column).
    """
    checks = []
    if contract.required and contract.key:
        checks.append(nulls_and_key(contract.name, df, contract.required, list(contract.key)))
    elif contract.required:
        checks.append(no_nulls(contract.name, df, contract.required))
    elif contract.key:
        checks.append(unique_key(contract.name, df, list(contract.key)))
    for column, parent in contract.references.items():
        if tables and parent in tables:
            checks.append(no_orphans(contract.name, df, column, *tables[parent]))
    return checks


def run_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require(results: DataFrame) -> DataFrame:
    """Raise `QualityError` listing the failed checks; return the results otherwise.

    One row per check reaches the driver.
    """
    failed = results.where(~F.col("passed")).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.check} {r.subject}: {r.measured} is not {r.comparison} {r.expected}" for r in failed)
        )
    return results
