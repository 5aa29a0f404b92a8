"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PLAY_PAGE = "NextSong"


def on_page(log: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    return log.where(F.col("page") == page)


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither NULL nor ''."""
    return df.where(F.col(column) != "")


def date_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows with start <= column < end."""
    return df.where((F.col(column) >= F.lit(start).cast("date")) & (F.col(column) < F.lit(end).cast("date")))


def in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose column is in a short literal list; use `keep_listed` for a code table."""
    return df.where(F.col(column).isin(values))


def without_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a NULL in the columns; the condition reaches the file scan."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a NULL or NaN in the columns."""
    return without_nulls(df, columns).dropna(how="any", subset=columns)
