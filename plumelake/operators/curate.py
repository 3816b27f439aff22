"""Raw readings to clean readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plumelake.functions.air import aqi_category
from plumelake.functions.times import parse_text_time
from plumelake.sources import schemas

REQUIRED = ["station_id", "timestamp", "pm25"]
IDENTITY = ["station_id", "timestamp"]


def clean_nulls(raw: DataFrame) -> DataFrame:
    """Keep readings with a station, a timestamp text and a PM2.5 value (not NaN)."""
    return raw.dropna(subset=REQUIRED)


def dedup(df: DataFrame, keys: list[str] = IDENTITY, order: list[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order``.

    Without ``order`` the remaining columns decide, so the survivor is fixed
    either way. Spark keeps one row per key and map task before it shuffles
    (``WindowGroupLimit``), so a key that holds a third of all rows sends no more
    rows than there are map tasks.
    """
    by = order or [c for c in df.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def parse_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_parsed", parse_text_time("timestamp"))


def date_parts(df: DataFrame) -> DataFrame:
    """Calendar columns; year, month and day are text without leading zeros."""
    t = F.col("timestamp_parsed")
    return df.withColumns({
        "year": F.year(t).cast("string"),
        "month": F.month(t).cast("string"),
        "day": F.dayofmonth(t).cast("string"),
        "curated_date": F.to_date(t),
    })


def shape_clean(timed: DataFrame) -> DataFrame:
    """The clean columns of readings with ``timestamp_parsed``. Row by row, so the
    same step serves batches and streams."""
    dated = date_parts(timed).withColumn("aqi_category", aqi_category("aqi"))
    return dated.select(*schemas.columns(schemas.CLEAN))


def quarantine(raw: DataFrame) -> DataFrame:
    """Readings with a fault and the first ``reason``. Readings with a bad time are
    listed here and stay in the clean table with a null time."""
    if schemas.CORRUPT not in raw.columns:
        raw = raw.withColumn(schemas.CORRUPT, F.lit(None).cast("string"))
    reason = (
        F.when(F.col(schemas.CORRUPT).isNotNull(), "malformed")
        .when(F.col("station_id").isNull(), "no station")
        .when(F.col("timestamp").isNull(), "no timestamp")
        .when(F.col("pm25").isNull() | F.isnan("pm25"), "no pm25")
        .when(parse_text_time("timestamp").isNull(), "bad timestamp")
    )
    kept = [*schemas.columns(schemas.RAW), schemas.CORRUPT]
    return raw.select(*kept, reason.alias("reason")).where(F.col("reason").isNotNull())


def curate(raw: DataFrame, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean readings and quarantined readings. ``order`` names the columns that
    decide which of several readings of one station and time survives."""
    known = [c for c in raw.columns
             if c in schemas.columns(schemas.RAW) or c in (order or [])]
    clean = shape_clean(parse_time(dedup(clean_nulls(raw.select(*known)), IDENTITY, order)))
    return clean, quarantine(raw)
