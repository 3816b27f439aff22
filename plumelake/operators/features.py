"""Clean readings to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plumelake.functions.air import HIGH_LIMIT, reaches, weekend_flag
from plumelake.functions.times import DAY, HOUR, day_number, epoch_second
from plumelake.operators.rolling import STATION, TIME, RollingSpec, rolling_with_trend
from plumelake.sources import schemas

FEATURE_SPECS = [
    RollingSpec("pm25_prom_24h", "avg", "pm25", DAY),
    RollingSpec("pm25_prom_6h", "avg", "pm25", 6 * HOUR),
    RollingSpec("aqi_prom_24h", "avg", "aqi", DAY),
    RollingSpec("aqi_max_24h", "max", "aqi", DAY),
    RollingSpec("aqi_prom_1h", "avg", "aqi", HOUR),
]


def calendar(df: DataFrame) -> DataFrame:
    """Hour, day of week (1 = Sunday) and weekend flag of each reading."""
    return df.withColumns({
        "hora_dia": F.hour(TIME),
        "dia_semana": F.dayofweek(TIME),
        "es_fin_semana": weekend_flag(F.dayofweek(TIME)),
    })


def label(df: DataFrame, limit: int = HIGH_LIMIT, horizon: int | None = None) -> DataFrame:
    """The training label: 1 if the index is at or above ``limit``.

    The default labels a reading with its own index, so the model classifies the
    present. With ``horizon`` in seconds the label comes from the station's first
    reading at least that much later (null if there is none): a forecast.
    """
    if horizon is None:
        return df.withColumn("contaminacion_alta", reaches("aqi", limit))
    ahead = _index_at_least_later(df, horizon)
    return ahead.withColumn("contaminacion_alta", reaches("_later", limit)).drop("_later")


def _index_at_least_later(df: DataFrame, horizon: int) -> DataFrame:
    """``_later``: the index of the first reading ``horizon`` seconds or more ahead.

    Works on one row per station and second. Each reading second asks at
    ``second + horizon``; questions and readings are laid out together by station
    and day, the nearest reading at or after each question is a running ``first``
    value, and the first reading of the next day with data answers questions that
    find none in their own day.
    """
    timed = df.withColumn("_second", epoch_second(TIME))
    seconds = timed.where(F.col("_second").isNotNull()).groupBy(STATION, "_second").agg(
        F.min(F.struct(F.col(TIME).alias("t"), F.col("aqi").alias("v"))).alias("_read"))
    told = seconds.select(STATION, F.col("_second").alias("_at"), F.struct("_read.v").alias("_read"),
                          F.lit(None).cast("bigint").alias("_asks"))
    asked = seconds.select(STATION, (F.col("_second") + horizon).alias("_at"),
                           F.lit(None).cast(told.schema["_read"].dataType).alias("_read"),
                           F.col("_second").alias("_asks"))
    both = told.unionByName(asked).withColumn("_day", day_number(F.col("_at")))

    first_of_day = both.groupBy(STATION, "_day").agg(
        F.min_by("_read", F.when(F.col("_read").isNotNull(), F.col("_at"))).alias("_open"))
    days_ahead = Window.partitionBy(STATION).orderBy(F.col("_day").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    first_of_day = first_of_day.select(
        STATION, "_day", F.last("_open", ignorenulls=True).over(days_ahead).alias("_next"))

    rest_of_day = Window.partitionBy(STATION, "_day").orderBy(F.col("_at").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    answers = (
        both.withColumn("_found", F.last("_read", ignorenulls=True).over(rest_of_day))
        .join(first_of_day, [STATION, "_day"], "left")
        .where(F.col("_asks").isNotNull())
        .select(STATION, F.col("_asks").alias("_second"),
                F.coalesce("_found", "_next")["v"].alias("_later"))
    )
    return timed.join(answers, [STATION, "_second"], "left").drop("_second")


def features(clean: DataFrame, method: str = "bucket", scale: int | None = None,
             drop_null_time: bool = False, horizon: int | None = None) -> DataFrame:
    """The 23 feature columns of every reading that has 24-hour means."""
    if drop_null_time:
        clean = clean.where(F.col(TIME).isNotNull())
    rolled = rolling_with_trend(clean, FEATURE_SPECS, method=method, scale=scale)
    full = label(calendar(rolled), horizon=horizon)
    return full.select(*schemas.columns(schemas.FEATURES)).dropna(
        subset=["pm25_prom_24h", "aqi_prom_24h"])
