"""Predictions to alerts and alert messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from plumelake.functions.air import STATE_DANGER
from plumelake.functions.times import (
    clock_text, epoch_second, hours_before, instant, tolerant_time)
from plumelake.operators.rolling import TIME

THRESHOLD = 0.70
HOURS = 24
SUBJECT_LENGTH = 100
READING = ["station_id", TIME]     # what an alert is about

# The wording of an alert message. The place and the signature of
# the sender are arguments of ``digest``.
TITLE = "ALERTA - CALIDAD DEL AIRE"
RULE = "------------------------------------------"
HEADER = "%s\nFecha de deteccion: %s\nEstaciones afectadas: %d\n" + RULE + "\n\n"
BLOCK = ("Estacion: %s\n"
         "  Estado:        " + STATE_DANGER + "\n"
         "  Probabilidad:  %s%%\n"
         "  AQI actual:    %s\n"
         "  PM2.5:         %s\n"
         "  Timestamp:     %s\n")
FOOTER = ("\n" + RULE + "\n"
          "Recomendaciones:\n"
          "  - Evitar actividad fisica al aire libre.\n"
          "  - Personas con asma: usar mascarilla.\n"
          "  - Cerrar ventanas y limitar exposicion.\n\n"
          "Alerta generada automaticamente por el pipeline.")
SUBJECT = "Alerta Calidad del Aire (%d estacion%s)"
NO_NAME, NO_VALUE = "desconocida", "n/a"


def is_alert(df: DataFrame, now: str | datetime | Column, threshold: float = THRESHOLD,
             hours: int = HOURS) -> Column:
    """True for a positive prediction with enough probability whose reading is at
    most ``hours`` old. Both limits are closed; a missing value is never an alert."""
    time = F.col(TIME)
    if isinstance(df.schema[TIME].dataType, T.StringType):
        time = tolerant_time(TIME)
    return is_danger(threshold) & F.coalesce(time >= hours_before(now, hours), F.lit(False))


def is_danger(threshold: float = THRESHOLD) -> Column:
    """True for a positive prediction with enough probability, however old."""
    test = (F.col("contaminacion_alta_pred") == 1.0) & (F.col("probabilidad_alerta") >= threshold)
    return F.coalesce(test, F.lit(False))


def alerts(pred: DataFrame, now: str | datetime | Column, threshold: float = THRESHOLD,
           hours: int = HOURS) -> DataFrame:
    """The predictions that raise an alert, with all their columns."""
    return pred.where(is_alert(pred, now, threshold, hours))


def standing_alerts(pred: DataFrame, raised: DataFrame, now: str | datetime | Column, threshold: float = THRESHOLD,
                    hours: int = HOURS) -> DataFrame:
    """The predictions that raise an alert now, and those that raised one before (in
    ``raised``) and still tell of danger, however old they have become."""
    before = raised.select(*[F.col(c).alias(f"_{c}") for c in READING])
    same = [F.col(c) == F.col(f"_{c}") for c in READING]
    held = pred.where(is_danger(threshold) & ~is_alert(pred, now, threshold, hours)).join(before, same, "left_semi")
    return alerts(pred, now, threshold, hours).unionByName(held)


def alert_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What became of each reading's alert: ``raised``, ``kept`` or ``withdrawn``, with its
    probability before and after."""
    sides = [df.select(*READING, F.col("probabilidad_alerta").alias(name), F.lit(True).alias(f"_{name}"))
             for df, name in ((old, "before"), (new, "after"))]
    both = sides[0].join(sides[1], READING, "full_outer")
    change = F.when(F.col("_before").isNull(), "raised").when(F.col("_after").isNull(), "withdrawn").otherwise("kept")
    return both.select(*READING, change.alias("change"), "before", "after")


def alert_counts(found: DataFrame, by: str | list[str]) -> DataFrame:
    """Alerts per file or station; none with zero."""
    keys = [by] if isinstance(by, str) else by
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("alerts_sent"))


def alert_totals(pred: DataFrame, now: str | datetime | Column, by: str = "source_file",
                 threshold: float = THRESHOLD, hours: int = HOURS,
                 groups: DataFrame | None = None) -> DataFrame:
    """Number of files (or other groups) looked at and of alerts in them. One row.
    ``groups`` lists files in ``by`` that count even without a row."""
    flagged = pred.select(by, is_alert(pred, now, threshold, hours).alias("_alert"))
    if groups is not None:
        flagged = flagged.unionByName(groups.select(by, F.lit(False).alias("_alert")))
    per_group = flagged.groupBy(by).agg(F.count_if("_alert").alias("_n"))
    return per_group.agg(F.count(F.lit(1)).alias("files_processed"),
                         F.coalesce(F.sum("_n"), F.lit(0)).alias("alerts_sent"))


def totals_json(totals: DataFrame) -> DataFrame:
    return totals.select(F.to_json(F.struct("files_processed", "alerts_sent")).alias("body"))


def numbered(df: DataFrame, by: list[str], ties: list[str]) -> DataFrame:
    """Add ``_nth`` (position in its group by time) and ``_of`` (size of the group).

    Rows are counted per group and second first; the running total over those
    counts gives where each second starts, so a group that holds many of the rows
    is numbered second by second and not in one task.
    """
    keyed = df.withColumn("_second", epoch_second(TIME))
    counts = keyed.groupBy(*by, "_second").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *by, "_second",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_of"))
    in_second = Window.partitionBy(*by, "_second").orderBy(TIME, *ties)
    return (
        keyed.withColumn("_i", F.row_number().over(in_second))
        .join(starts, [*by, "_second"])
        .withColumn("_nth", F.col("_start") + F.col("_i"))
        .drop("_second", "_i", "_start")
    )


def alert_block(name: str = "station_name") -> Column:
    """The lines about one alert."""
    share = F.round(F.coalesce("probabilidad_alerta", F.lit(0.0)) * 100, 1)
    return F.format_string(
        BLOCK,
        F.coalesce(F.col(name), F.lit(NO_NAME)),
        share.cast("string"),
        F.coalesce(F.col("aqi").cast("string"), F.lit(NO_VALUE)),
        F.coalesce(F.col("pm25").cast("string"), F.lit(NO_VALUE)),
        F.coalesce(clock_text(TIME), F.lit(NO_VALUE)),
    )


def subject(n: Column) -> Column:
    plural = F.when(n > 1, F.lit("es")).otherwise(F.lit(""))
    return F.left(F.format_string(SUBJECT, n, plural), F.lit(SUBJECT_LENGTH))


def alert_lines(found: DataFrame, by: str | list[str] = "source_file") -> DataFrame:
    """One row per alert: its group, ``position`` in the group by time, ``alert_count``
    and ``station_count`` of the whole group, and ``block``, the lines about it."""
    keys = [by] if isinstance(by, str) else by
    ties = [c for c in ("station_id", "station_name", "aqi", "pm25", "probabilidad_alerta")
            if c in found.columns and c not in keys]
    lines = numbered(found, keys, ties).select(
        *keys, F.col("_nth").alias("position"), F.col("_of").alias("alert_count"),
        F.col("station_name"), alert_block().alias("block"))
    stations = found.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.count_distinct("station_name").alias("station_count"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return lines.join(stations, same).select(
        *keys, "position", "alert_count", "station_count", "block")


def digest(found: DataFrame, now: str | datetime | Column, by: str | list[str] = "source_file",
           region: str = "", signature: str = "", *, part_size: int | None) -> DataFrame:
    """Alert messages, one per file or station, with all its alerts in time order,
    joined from ``alert_lines``.

    The number in header and subject is that of alert rows. ``part_size`` is the most
    alerts one message may tell; further ones follow in the next ``part`` of
    ``parts``. With ``None`` a group is one message, as long as the group is.
    """
    keys = [by] if isinstance(by, str) else by
    size = F.lit(part_size).cast("long") if part_size else F.col("alert_count")
    lines = alert_lines(found, keys).withColumn("part", F.ceil(F.col("position") / size).cast("int"))
    messages = lines.groupBy(*keys, "part").agg(
        F.max("alert_count").alias("alert_count"), F.max("station_count").alias("station_count"),
        F.array_sort(F.collect_list(F.struct("position", "block"))).alias("_blocks"))
    title = F.lit(f"{TITLE} {region}".strip())
    stamp = F.date_format(instant(now), "yyyy-MM-dd HH:mm 'UTC'")
    body = F.concat(
        F.format_string(HEADER, title, stamp, F.col("alert_count")),
        F.array_join(F.transform("_blocks", lambda b: b["block"]), "\n"),
        F.lit(FOOTER + (f"\n{signature}" if signature else "")))
    return messages.select(
        *keys, "part", F.ceil(F.col("alert_count") / size).cast("int").alias("parts"),
        "alert_count", F.col("station_count").cast("int").alias("station_count"),
        subject(F.col("alert_count")).alias("subject"), body.alias("message"))
