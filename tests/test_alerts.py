import pytest
from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators import alerts as al
from plumelake.sources import schemas

NOW = "2024-01-30 00:00:00"


@pytest.fixture(scope="module")
def predictions_of(spark):
    """Predictions as (station, time text, prediction, probability)."""
    def make(*given, **other):
        values = {"aqi": 4, "pm25": 120.5, **other}
        df = spark.createDataFrame([(*g,) for g in given], "station_id string, t string, pred double, prob double")
        full = df.select(
            "station_id", F.concat(F.lit("Station "), "station_id").alias("station_name"),
            F.col("t").cast("timestamp").alias("timestamp_parsed"),
            F.lit(values["aqi"]).cast("int").alias("aqi"), F.lit(values["pm25"]).cast("double").alias("pm25"),
            *[F.lit(1.0).alias(c) for c in ("aqi_prom_24h", "pm25_prom_6h", "tendencia_aqi", "hora_dia",
                                           "dia_semana", "contaminacion_alta_real")],
            F.col("pred").alias("contaminacion_alta_pred"), F.col("prob").alias("probabilidad_alerta"),
            F.lit("PELIGROSO").alias("estado_predicho"), F.lit("x").alias("prediction_timestamp"))
        return full.select(*schemas.columns(schemas.PREDICTIONS))
    return make


def test_limits_are_closed_and_missing_never_alerts(predictions_of):
    df = predictions_of(
        ("edge", "2024-01-29 00:00:00", 1.0, 0.70), ("low", "2024-01-29 12:00:00", 1.0, 0.6999),
        ("old", "2024-01-28 23:59:59", 1.0, 0.9), ("no", "2024-01-29 12:00:00", 0.0, 0.9),
        ("noprob", "2024-01-29 12:00:00", 1.0, None), ("notime", None, 1.0, 0.9),
        ("nopred", "2024-01-29 12:00:00", None, 0.9), ("future", "2024-02-05 00:00:00", 1.0, 0.9))
    assert rows(al.alerts(df, NOW).select("station_id"), "station_id") == [("edge",), ("future",)]
    assert rows(al.alerts(df, NOW, threshold=0.5, hours=25).select("station_id"), "station_id") == [
        ("edge",), ("future",), ("low",), ("old",)]
    # a missing probability counts as 0 and still raises no alert
    assert al.alerts(df, NOW, threshold=0.0).where("station_id = 'noprob'").count() == 0


def test_text_times(predictions_of):
    df = predictions_of(("a", "2024-01-29 12:00:00", 1.0, 0.9), ("b", "2024-01-29 12:00:00", 1.0, 0.9))
    text = df.withColumn("timestamp_parsed", F.when(F.col("station_id") == "a", "2024-01-29T12:00:00Z").otherwise("?"))
    assert rows(al.alerts(text, NOW).select("station_id")) == [("a",)]


def test_counts_and_totals(predictions_of):
    df = predictions_of(("a", "2024-01-29 12:00:00", 1.0, 0.9), ("a", "2024-01-29 13:00:00", 1.0, 0.8),
                        ("b", "2024-01-29 12:00:00", 0.0, 0.1))
    assert rows(al.alert_counts(al.alerts(df, NOW), "station_id")) == [("a", 2)]
    totals = al.alert_totals(df, NOW, by="station_id")
    assert rows(totals) == [(2, 2)]
    assert rows(al.totals_json(totals)) == [('{"files_processed":2,"alerts_sent":2}',)]
    assert rows(al.alert_totals(df.limit(0), NOW, by="station_id")) == [(0, 0)]


MESSAGE = """ALERTA - CALIDAD DEL AIRE
Fecha de deteccion: 2024-01-30 00:00 UTC
Estaciones afectadas: 2
------------------------------------------

Estacion: Station a
  Estado:        PELIGROSO
  Probabilidad:  87.6%
  AQI actual:    4
  PM2.5:         120.5
  Timestamp:     2024-01-29 12:00:00

Estacion: Station a
  Estado:        PELIGROSO
  Probabilidad:  100.0%
  AQI actual:    4
  PM2.5:         120.5
  Timestamp:     2024-01-29 12:30:00.250000

------------------------------------------
Recomendaciones:
  - Evitar actividad fisica al aire libre.
  - Personas con asma: usar mascarilla.
  - Cerrar ventanas y limitar exposicion.

Alerta generada automaticamente por el pipeline."""


def test_message_text(predictions_of):
    df = predictions_of(("a", "2024-01-29 12:30:00.25", 1.0, 1.0), ("a", "2024-01-29 12:00:00", 1.0, 0.876))
    got = al.digest(df, NOW, "station_id", part_size=None).first()
    assert got["message"] == MESSAGE
    assert got["subject"] == "Alerta Calidad del Aire (2 estaciones)"
    named = al.digest(df, NOW, "station_id", region="VALLE", signature="Equipo", part_size=None).first()["message"]
    assert named.startswith("ALERTA - CALIDAD DEL AIRE VALLE\n") and named.endswith("pipeline.\nEquipo")


def test_message_defaults_and_singular(predictions_of):
    df = predictions_of(("a", "2024-01-29 12:00:00", 1.0, 0.9), aqi=None, pm25=None).withColumn(
        "station_name", F.lit(None).cast("string"))
    got = al.digest(df, NOW, "station_id", part_size=None).first()
    assert "Estacion: desconocida\n" in got["message"]
    assert "AQI actual:    n/a\n  PM2.5:         n/a\n" in got["message"]
    assert got["subject"] == "Alerta Calidad del Aire (1 estacion)"


def test_big_groups_are_told_in_parts_and_nothing_is_lost(predictions_of):
    many = [("a", f"2024-01-29 {i // 60:02d}:{i % 60:02d}:00", 1.0, 0.9) for i in range(100)]
    same = [("a", "2024-01-29 05:00:00", 1.0, 0.7 + i / 1000) for i in range(30)]
    got = al.digest(predictions_of(*many, *same, ("b", "2024-01-29 05:00:00", 1.0, 0.9)), NOW,
                    "station_id", part_size=40)
    assert rows(got.select("station_id", "part", "parts", "alert_count", "station_count"), "station_id", "part") == [
        ("a", 1, 4, 130, 1), ("a", 2, 4, 130, 1), ("a", 3, 4, 130, 1), ("a", 4, 4, 130, 1), ("b", 1, 1, 1, 1)]
    text = "".join(r["message"] for r in got.orderBy("station_id", "part").collect())
    assert text.count("Estacion: Station a") == 130
    stamps = [line.split("  Timestamp:     ")[1] for line in text.split("\n") if "Timestamp:" in line]
    assert stamps[:130] == sorted(stamps[:130])


def test_no_alerts_no_message(predictions_of):
    assert al.digest(predictions_of(("a", NOW, 1.0, 0.9)).limit(0), NOW, "station_id", part_size=None).count() == 0


def test_counts_are_those_of_the_whole_group(predictions_of):
    """50 alerts of 7 stations in one file, told in parts of 5."""
    many = [(f"s{i % 7}", f"2024-01-29 00:{i:02d}:00", 1.0, 0.9) for i in range(50)]
    df = predictions_of(*many).withColumn("source_file", F.lit("f"))
    got = al.digest(df, NOW, part_size=5)
    assert rows(got.select("alert_count", "station_count", "parts").distinct()) == [(50, 7, 10)]
    lines = al.alert_lines(df)
    assert [r["position"] for r in lines.orderBy("position").collect()] == list(range(1, 51))
    assert {(r["alert_count"], r["station_count"]) for r in lines.collect()} == {(50, 7)}


def test_files_without_rows_count(predictions_of):
    df = predictions_of(("a", NOW, 1.0, 0.9)).withColumn("source_file", F.lit("f"))
    files = df.select("source_file").union(df.select(F.lit("empty")))
    assert rows(al.alert_totals(df, NOW, groups=files)) == [(2, 1)]
