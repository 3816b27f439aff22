"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumelake.functions.times import as_col


def nan_to_null(col: str | Column) -> Column:
    """Reports skip missing values, and a NaN counts as missing."""
    c = as_col(col).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def to_units(col: str | Column, scale: int) -> Column:
    """A decimal reading as a whole number of units of ``10**-scale``."""
    return F.round(as_col(col) * float(10 ** scale)).cast("bigint")


def ratio(total: Column, n: Column, scale: int | None = None) -> Column:
    """``total / n`` in double, null for an empty group; undoes ``to_units``."""
    divisor = float(10 ** (scale or 0))
    return F.try_divide(total.cast("double"), n * F.lit(divisor))


def mean(col: str | Column, scale: int | None = None) -> Column:
    """Aggregate mean. With ``scale`` the sum runs over whole units, so that the
    result does not depend on the order in which Spark adds partial sums."""
    if scale is None:
        return F.avg(as_col(col))
    return ratio(F.sum(to_units(col, scale)), F.count(as_col(col)), scale)


def percent(part: Column, total: Column, places: int = 1) -> Column:
    return F.round(F.try_divide(F.lit(100) * part, total), places)


def hash_percent(*cols: str | Column) -> Column:
    """A number from 0 to 99 that depends on the values only, not on the layout
    of the rows: the first eight hex digits of the MD5 of the joined values."""
    text = F.concat_ws("|", *[as_col(c).cast("string") for c in cols])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(100))
