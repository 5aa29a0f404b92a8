"""Casts, rounding, flags, text and key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when a label is stripped (fixed values).
BLANKS = " \t\n\r\x0b\x0c"


def drop_fraction(number: Column, mode: str = "truncate") -> Column:
    """A number as decimal(18,0): `truncate` toward zero or `round` half up; NULL where it does not fit."""
    if mode == "truncate":
        return number.try_cast("bigint").try_cast("decimal(18,0)")
    if mode == "round":
        return number.try_cast("decimal(18,0)")
    raise ValueError(f"unknown mode {mode!r}")


def varchar(text: Column, length: int) -> Column:
    """Text cut to `length` characters (a Spark cast does not cut)."""
    return F.substring(text.cast("string"), 1, length)


def user_number(text: Column) -> Column:
    """Quoted user id to int; '' and other non-numbers become NULL."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("int")


def md5_key(*parts: Column) -> Column:
    """md5 of the parts' text written one after another; NULL if any part is NULL."""
    return F.md5(F.concat(*[part.cast("string") for part in parts]))


def event_flag(column: Column, value: str) -> Column:
    """1 where the column equals `value`, else 0 (also for NULL)."""
    return F.when(column == value, 1).otherwise(0)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))
