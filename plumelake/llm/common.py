"""Expressions and limits that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumelake.session import written

# The white space that separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

__all__ = ["SPACES", "SPACE", "NOT_SPACE", "words", "n_words", "partitions", "written"]


def words(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, f"{SPACE}+")).otherwise(
        F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def partitions(df: DataFrame) -> int:
    """Tasks of a shuffle. A cluster sets this with the size of its input, so what
    is cut by it stays of bounded size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
