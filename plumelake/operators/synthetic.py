"""Backfill readings for trials: seeded, the same on every run and layout."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumelake.functions.times import instant
from plumelake.sources import schemas

# Lowest and highest reading per column, in hundredths.
RANGES = {
    "co": (30_000, 100_000),
    "no2": (0, 15_000),
    "o3": (0, 15_000),
    "pm25": (0, 15_000),
    "pm10": (0, 15_000),
}
DAYS_BACK, HOURS_BACK = 30, 23


def _draw(seed: int, name: str, key: Column, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, fixed by seed, name and key."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), key.cast("string"))
    drawn = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return F.lit(low) + F.pmod(drawn, F.lit(high - low + 1))


def synthesize(keys: DataFrame, key: str, stations: list[tuple[str, str, float, float]],
               now: str | datetime, seed: int = 42) -> DataFrame:
    """One raw reading per row of ``keys``. Values are uniform; the time is ``now``
    minus 0 to 30 whole days and 0 to 23 whole hours."""
    k = F.col(key)
    pick = _draw(seed, "station", k, 1, len(stations)).cast("int")
    places = F.array(*[
        F.struct(F.lit(i).alias("station_id"), F.lit(n).alias("station_name"),
                 F.lit(float(lat)).alias("latitude"), F.lit(float(lon)).alias("longitude"))
        for i, n, lat, lon in stations])
    hours = _draw(seed, "days", k, 0, DAYS_BACK) * 24 + _draw(seed, "hours", k, 0, HOURS_BACK)
    time = instant(now) - F.make_dt_interval(hours=hours.cast("int"))
    values = {c: _draw(seed, c, k, *RANGES[c]) / F.lit(100.0) for c in RANGES}
    return keys.select(k, F.element_at(places, pick).alias("_place")).select(
        "_place.*",
        _draw(seed, "aqi", k, 1, 5).cast("int").alias("aqi"),
        *[v.alias(c) for c, v in values.items()],
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    ).select(*schemas.columns(schemas.RAW))


def synthetic_readings(spark: SparkSession, n: int, stations: list[tuple[str, str, float, float]],
                       now: str | datetime, seed: int = 42) -> DataFrame:
    return synthesize(spark.range(n), "id", stations, now, seed)
