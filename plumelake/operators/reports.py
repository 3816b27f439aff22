"""Report tables over clean readings."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from plumelake.functions.air import DANGER_LIMIT
from plumelake.functions.numbers import mean, nan_to_null, percent
from plumelake.functions.times import instant
from plumelake.sources import schemas

# Display names of the table of worst readings.
DISPLAY_NAMES = {
    "station_name": "Estacion",
    "timestamp_parsed": "Fecha y hora",
    "aqi": "AQI",
    "aqi_category": "Categoria",
    "pm25": "PM2.5",
    "pm10": "PM10",
    "o3": "O3",
}


def _day(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def _between_days(df: DataFrame, start: date, end: date) -> Column:
    """Readings of the days ``start`` to ``end``, both included, as a half-open
    time range that reaches the Parquet scan. Where the folder columns of the
    clean table are there, they say the same, so other days are not even listed."""
    time = F.col("timestamp_parsed")
    inside = (time >= instant(str(start))) & (time < instant(str(end + timedelta(days=1))))
    if set(schemas.CLEAN_PARTITIONS) <= set(df.columns):
        folder = F.make_date(*[F.col(c).cast("int") for c in schemas.CLEAN_PARTITIONS])
        inside = inside & folder.between(F.lit(start), F.lit(end))
    return inside


def select_readings(clean: DataFrame, stations: list[str] | None = None,
                    start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Readings of some stations (by name) and of a closed range of days. The range
    applies only if both ends are given."""
    if stations is not None:
        clean = clean.where(F.col("station_name").isin(*stations))
    if start is not None and end is not None:
        clean = clean.where(_between_days(clean, _day(start), _day(end)))
    return clean


def last_days(clean: DataFrame, now: str | datetime, days: int = 7) -> DataFrame:
    """The report extract: readings of the last ``days`` days up to ``now``."""
    moment = datetime.fromisoformat(now) if isinstance(now, str) else now
    since = moment - timedelta(days=days)
    recent = clean.where(_between_days(clean, since.date(), moment.date())).where(
        (F.col("timestamp_parsed") >= instant(since)) & (F.col("timestamp_parsed") <= instant(now)))
    return recent.select(*schemas.columns(schemas.EXTRACT))


def kpis(df: DataFrame, danger: int = DANGER_LIMIT) -> DataFrame:
    """Worst and mean index, worst PM2.5, and readings in danger; no row for an
    empty selection."""
    rows = F.count(F.lit(1))
    dangerous = F.count_if(F.col("aqi") >= danger)
    return df.agg(
        rows.alias("lecturas"),
        F.max("aqi").cast("int").alias("aqi_max"),
        F.round(F.avg("aqi"), 2).alias("aqi_prom"),
        F.round(F.max(nan_to_null("pm25")), 1).alias("pm25_max"),
        dangerous.alias("n_alertas"),
        percent(dangerous, rows).alias("pct_alertas"),
    ).where("lecturas > 0")


def hourly(df: DataFrame) -> DataFrame:
    """Mean index per station and hour, for hours that have readings."""
    known = df.where(F.col("station_name").isNotNull() & F.col("timestamp_parsed").isNotNull())
    return known.groupBy(
        F.date_trunc("hour", "timestamp_parsed").alias("timestamp_parsed"), "station_name",
    ).agg(F.avg("aqi").alias("aqi"))


def station_summary(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean index, mean PM2.5 and number of index readings per station and place."""
    place = ["station_name", "latitude", "longitude"]
    clean_pm = df.withColumn("pm25", nan_to_null("pm25"))
    return clean_pm.dropna(subset=place).groupBy(*place).agg(
        F.avg("aqi").alias("aqi_prom"),
        mean("pm25", scale).alias("pm25_prom"),
        F.count("aqi").alias("lecturas"),
    )


def category_counts(df: DataFrame) -> DataFrame:
    """Readings per category, rarest first."""
    return (
        df.where(F.col("aqi_category").isNotNull())
        .groupBy("aqi_category").agg(F.count(F.lit(1)).alias("lecturas"))
        .orderBy("lecturas", "aqi_category")
    )


def date_span(df: DataFrame) -> DataFrame:
    """First and last day, and the last time of the whole set."""
    time = F.col("timestamp_parsed")
    return df.agg(F.to_date(F.min(time)).alias("fecha_min"), F.to_date(F.max(time)).alias("fecha_max"),
                  F.max(time).alias("ultima_lectura"))


def station_list(df: DataFrame) -> DataFrame:
    return df.select("station_name").where("station_name IS NOT NULL").distinct().orderBy("station_name")


def with_day_and_hour(df: DataFrame) -> DataFrame:
    return df.withColumns({"fecha": F.to_date("timestamp_parsed"), "hora": F.hour("timestamp_parsed")})


def worst(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` worst readings by index, then PM2.5, under display names. Ties are
    settled by time and station."""
    ranked = df.withColumn("pm25", nan_to_null("pm25")).orderBy(
        F.desc_nulls_last("aqi"), F.desc_nulls_last("pm25"),
        F.asc_nulls_last("timestamp_parsed"), F.asc_nulls_last("station_name"),
        *[F.asc_nulls_last(c) for c in ("pm10", "o3")]).limit(n)
    return ranked.select(*DISPLAY_NAMES).withColumnsRenamed(DISPLAY_NAMES)


LATEST_FEATURES = ["station_name", "aqi", "pm25_prom_24h", "aqi_prom_24h", "tendencia_aqi",
                   "hora_dia", "contaminacion_alta"]
LATEST_PREDICTIONS = ["station_name", "timestamp_parsed", "aqi", "contaminacion_alta_pred",
                      "probabilidad_alerta", "estado_predicho"]


def latest(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The ``n`` most recent rows; rows of the same time in the order of their
    station, then of the shown columns."""
    ties = ["station_id", *[c for c in columns if c not in ("station_id", "timestamp_parsed")]]
    newest = df.orderBy(F.desc_nulls_last("timestamp_parsed"), *[F.asc_nulls_last(c) for c in ties])
    return newest.limit(n).select(*columns)


def report(clean: DataFrame, stations: list[str] | None = None, start: str | date | None = None,
           end: str | date | None = None) -> dict[str, DataFrame]:
    """All panels for one selection, as lazy DataFrames."""
    chosen = select_readings(clean, stations, start, end)
    return {
        "kpis": kpis(chosen),
        "hourly": hourly(chosen),
        "stations": station_summary(chosen),
        "categories": category_counts(chosen),
        "worst": worst(chosen),
        "station_list": station_list(clean),
        "date_span": date_span(clean),
    }
