"""Raw readings from the sample table ``events``.

The sample has no stations and no faults, so each event becomes a reading of the
station named by its type (or its user), some with gaps, bad values or a repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumelake.session import use_utc

# Places of the stations, limits of the index, and which event
# numbers carry which fault.
PLACES = {"click": (6.2442, -75.5812), "error": (6.3373, -75.5579),
          "purchase": (6.17, -75.587), "signup": (6.25, -75.6)}
ELSEWHERE = (6.3, -75.5)
INDEX_LIMITS = [(15, 1), (45, 2), (75, 3), (115, 4)]
REPEAT, NO_STATION, NO_INDEX, ZERO_INDEX, NO_PM25, BAD_TIME = 50, 307, 101, 103, 97, 211

ARRIVAL = ["event_id", "ingest_seq"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _place(axis: int) -> Column:
    expr = F.lit(float(ELSEWHERE[axis]))
    for kind, place in PLACES.items():
        expr = F.when(F.col("event_type") == kind, F.lit(place[axis])).otherwise(expr)
    return expr


def _index(value: Column) -> Column:
    expr = F.lit(5)
    for limit, index in reversed(INDEX_LIMITS):
        expr = F.when(value < limit, index).otherwise(expr)
    return (
        F.when(_every(NO_INDEX), F.lit(None)).when(_every(ZERO_INDEX), 0).otherwise(expr).cast("int")
    )


def raw_readings(source: DataFrame, station: str = "event_type") -> DataFrame:
    """Raw readings plus the arrival columns ``event_id`` and ``ingest_seq``."""
    times = F.when(_every(REPEAT), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = source.select("event_id", "ts", "user_id", "event_type", "value",
                         F.explode(times).alias("ingest_seq"))
    value = F.col("value") + F.col("ingest_seq")
    name = F.col(station).cast("string")
    return rows.select(
        "event_id", "ingest_seq",
        F.when(~_every(NO_STATION), name).alias("station_id"),
        F.concat(F.lit("Station "), name).alias("station_name"),
        _place(0).alias("latitude"),
        _place(1).alias("longitude"),
        _index(value).alias("aqi"),
        (200 + F.col("user_id") % 300).cast("double").alias("co"),
        (F.col("event_id") % 80).cast("double").alias("no2"),
        (F.col("user_id") % 120).cast("double").alias("o3"),
        F.when(~_every(NO_PM25), value).alias("pm25"),
        (value * 2).alias("pm10"),
        F.when(_every(BAD_TIME), "bad").otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("timestamp"),
    )
