"""Time expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

DAY = 86_400
HOUR = 3_600


def as_col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_text_time(col: str | Column) -> Column:
    """Text to timestamp; text that is no timestamp gives null, also under ANSI."""
    return F.try_to_timestamp(as_col(col))


def tolerant_time(col: str | Column) -> Column:
    """Text or timestamp to timestamp: every letter Z is removed first, the rest
    is read as UTC, and what cannot be read is null."""
    return F.try_to_timestamp(F.replace(as_col(col).cast("string"), F.lit("Z"), F.lit("")))


def epoch_second(col: str | Column) -> Column:
    """Whole seconds since 1970; fractions are cut off. Zone-less input is UTC."""
    return F.unix_seconds(as_col(col).cast("timestamp"))


def instant(value: str | datetime | Column) -> Column:
    """A fixed moment, given as text, naive UTC datetime or column."""
    if isinstance(value, Column):
        return value
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def hours_before(now: str | datetime | Column, hours: int) -> Column:
    return instant(now) - F.make_dt_interval(hours=F.lit(hours))


def day_number(second: Column) -> Column:
    """Days since 1970 of an epoch second."""
    return block_number(second, DAY)


def block_number(second: Column, width: int) -> Column:
    """Number of the block of ``width`` seconds that holds an epoch second."""
    return F.floor(second / F.lit(width))


def clock_text(col: str | Column) -> Column:
    """``2024-01-30 07:15:00``, with six more digits only if there is a fraction."""
    c = as_col(col).cast("timestamp")
    whole = F.pmod(F.unix_micros(c), F.lit(1_000_000)) == 0
    return F.when(whole, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
