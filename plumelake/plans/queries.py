"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

All of them read the whole ``events`` table through the adapter. Queries about
sources, sinks and streams first write what Spark derived from it to the shared
folder. Outputs carry zone-less timestamps and dates as text, so that they compare
with any SQL engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumelake.functions.air import aqi_category
from plumelake.functions.times import DAY, HOUR, parse_text_time, tolerant_time
from plumelake.operators import alerts as al, model as ml, reports as rp
from plumelake.operators.curate import REQUIRED, clean_nulls, curate, dedup, quarantine
from plumelake.operators.features import calendar, features, label
from plumelake.operators.rolling import RollingSpec, rolling, trend
from plumelake.operators.synthetic import synthesize
from plumelake.plans.adapter import ARRIVAL, events, raw_readings
from plumelake.plans.incremental import run_incremental
from plumelake.plans.pipeline import Places, run_batch
from plumelake.session import shared_folder, use_utc, written
from plumelake.sources import readers, schemas, writers
from plumelake.streaming import features as sf, hourly as sh, intake, scoring, stateful
from plumelake.streaming.chain import read_by_batch, run_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL side.
NOW = "2024-01-30 00:00:00"
RUN_TS = "2024-01-30T00:00:00"
SELECTED = ["Station click", "Station error", "Station view"]
SELECTED_DAYS = ("2024-01-05", "2024-01-20")
WEIGHTS = {"pm25_prom_6h": 0.9, "aqi_prom_24h": 0.6, "tendencia_aqi": 0.8,
           "hora_dia": -0.05, "dia_semana": 0.02}
MEANS = {"pm25_prom_6h": 50.0, "aqi_prom_24h": 2.25, "tendencia_aqi": 0.0,
         "hora_dia": 11.5, "dia_semana": 4.0}
STDS = {"pm25_prom_6h": 12.5, "aqi_prom_24h": 0.25, "tendencia_aqi": 1.5,
        "hora_dia": 7.0, "dia_semana": 2.0}
BIAS = -0.4
STATIONS = [("click", "Station click", 6.2442, -75.5812),
            ("error", "Station error", 6.3373, -75.5579),
            ("view", "Station view", 6.3, -75.5)]
SEED = 42
LATE = "40 days"    # longer than the sample, so that no streamed row is late
REGION, SIGNATURE = "VALLE", "Equipo de guardia"


def plain(df: DataFrame) -> DataFrame:
    """Zone-less timestamps, dates as text."""
    cast = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cast[f.name] = F.col(f"`{f.name}`").cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            cast[f.name] = F.col(f.name).cast("string")
    return df.withColumns(cast) if cast else df


def _raw(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    return raw_readings(events(spark, sf_dir), station)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(*schemas.columns(schemas.RAW))


def _clean(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    return curate(_raw(spark, sf_dir, station), ARRIVAL)[0]


def _clean_table(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    """Clean readings as a stored table, for operators that read them more than
    once; otherwise each read would repeat the de-duplication."""
    return written(_clean(spark, sf_dir, station), "clean")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(_clean_table(spark, sf_dir), scale=2)


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.training_frame(_features(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.score_with(_frame(spark, sf_dir), WEIGHTS, MEANS, STDS, BIAS, RUN_TS)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.alerts(_scored(spark, sf_dir), NOW)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("probabilidad_alerta", F.round("probabilidad_alerta", 6))


def _rolled(spark: SparkSession, sf_dir: str, *specs: tuple, station: str = "event_type") -> DataFrame:
    rolled = rolling(_clean_table(spark, sf_dir, station), list(specs), scale=2)
    return plain(rolled.select("station_id", "timestamp_parsed", "pm25", "aqi", *[s[0] for s in specs]))


# --- clean ------------------------------------------------------------------

def curated_readings(spark, sf_dir):
    return plain(_clean(spark, sf_dir))


def required_fields(spark, sf_dir):
    return clean_nulls(_readings(spark, sf_dir)).select(*REQUIRED, "aqi")


def quarantined_readings(spark, sf_dir):
    return quarantine(_raw(spark, sf_dir)).drop(schemas.CORRUPT)


def dedup_readings(spark, sf_dir):
    return dedup(clean_nulls(_raw(spark, sf_dir)), order=ARRIVAL)


def aqi_category_map(spark, sf_dir):
    return _raw(spark, sf_dir).groupBy("aqi", aqi_category("aqi").alias("aqi_category")).agg(
        F.count(F.lit(1)).alias("lecturas"))


def timestamp_parsing(spark, sf_dir):
    marked = F.concat("timestamp", F.lit("Z"))
    return plain(_raw(spark, sf_dir).select(
        "event_id", "ingest_seq",
        parse_text_time("timestamp").alias("parsed"), tolerant_time(marked).alias("tolerant")))


# --- features ---------------------------------------------------------------

def rolling_pm25_24h(spark, sf_dir):
    return _rolled(spark, sf_dir, RollingSpec("pm25_prom_24h", "avg", "pm25", DAY))


def rolling_pm25_6h(spark, sf_dir):
    return _rolled(spark, sf_dir, RollingSpec("pm25_prom_6h", "avg", "pm25", 6 * HOUR))


def rolling_aqi_24h_avg_max(spark, sf_dir):
    return _rolled(spark, sf_dir, RollingSpec("aqi_prom_24h", "avg", "aqi", DAY),
                   RollingSpec("aqi_max_24h", "max", "aqi", DAY))


def rolling_aqi_1h(spark, sf_dir):
    return _rolled(spark, sf_dir, RollingSpec("aqi_prom_1h", "avg", "aqi", HOUR))


def rolling_bucketed_24h(spark, sf_dir):
    return _rolled(spark, sf_dir, RollingSpec("pm25_prom_24h", "avg", "pm25", DAY),
                   RollingSpec("aqi_max_24h", "max", "aqi", DAY),
                   RollingSpec("aqi_prom_1h", "avg", "aqi", HOUR), station="user_id")


def aqi_trend(spark, sf_dir):
    return plain(trend(_clean_table(spark, sf_dir)).select(
        "station_id", "timestamp_parsed", "aqi", "tendencia_aqi"))


def aqi_trend_many_stations(spark, sf_dir):
    return plain(trend(_clean_table(spark, sf_dir, "user_id")).select(
        "station_id", "timestamp_parsed", "aqi", "tendencia_aqi"))


def calendar_features(spark, sf_dir):
    return plain(calendar(_clean(spark, sf_dir)).select(
        "station_id", "timestamp_parsed", "hora_dia", "dia_semana", "es_fin_semana"))


def high_pollution_label(spark, sf_dir):
    return plain(label(_clean(spark, sf_dir)).select(
        "station_id", "timestamp_parsed", "aqi", "contaminacion_alta"))


def label_six_hours_ahead(spark, sf_dir):
    return plain(label(_clean_table(spark, sf_dir), horizon=6 * HOUR).select(
        "station_id", "timestamp_parsed", "aqi", "contaminacion_alta"))


def feature_table(spark, sf_dir):
    return plain(_features(spark, sf_dir))


def training_rows(spark, sf_dir):
    return plain(_frame(spark, sf_dir).select("station_id", "timestamp_parsed", *ml.INPUTS, ml.LABEL))


# --- model ------------------------------------------------------------------

def class_balance(spark, sf_dir):
    return ml.class_balance(_frame(spark, sf_dir))


def hash_split_counts(spark, sf_dir):
    sides = _frame(spark, sf_dir).groupBy((ml.split_bucket() < 80).alias("train"))
    return sides.agg(F.count(F.lit(1)).alias("count"))


def scaler_stats(spark, sf_dir):
    train, _ = ml.split(_frame(spark, sf_dir), method="hash")
    return ml.scaler_stats(train).select(
        "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def fixed_weight_scores(spark, sf_dir):
    return plain(_rounded(_scored(spark, sf_dir)))


def confusion_matrix(spark, sf_dir):
    return ml.confusion(_scored(spark, sf_dir))


def classification_metrics(spark, sf_dir):
    return ml.metrics(_scored(spark, sf_dir))


def auc_exact(spark, sf_dir):
    margin = ml.margin(WEIGHTS, MEANS, STDS, BIAS)
    scored = _frame(spark, sf_dir).select(margin.alias("score"), ml.LABEL)
    return ml.auc(scored, by="score", real=ml.LABEL)


def predicted_state(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("estado_predicho", "contaminacion_alta_pred").agg(
        F.count(F.lit(1)).alias("count"))


def _tight_fit(frame: DataFrame):
    """A model so close to the optimum that any other way to it agrees."""
    return ml.fit(ml.split(frame, method="hash")[0], max_iter=500, tol=1e-12)


def lr_coefficients(spark, sf_dir):
    """Weights and bias of the fitted, stored and reloaded model."""
    known = ml.model_coefficients(_tight_fit(written(_frame(spark, sf_dir), "frame")))
    rows = [*known["weights"].items(), ("bias", known["bias"])]
    return spark.createDataFrame([(n, round(w, 3)) for n, w in rows], "feature string, weight double")


def lr_predictions(spark, sf_dir):
    frame = written(_frame(spark, sf_dir), "frame")
    return plain(ml.score(_tight_fit(frame), frame, RUN_TS)).select(
        "station_id", "timestamp_parsed", "contaminacion_alta_real", "contaminacion_alta_pred",
        F.round("probabilidad_alerta", 4).alias("probabilidad_alerta"), "estado_predicho")


def incomplete_alerts(spark, sf_dir):
    """Lines about alerts whose name, index or PM2.5 is missing."""
    found = _alerts(spark, sf_dir)
    second = F.unix_timestamp("timestamp_parsed")
    holes = {"station_name": F.when(second % 2 == 0, F.col("station_name")),
             "aqi": F.when(second % 3 == 0, F.col("aqi")), "pm25": F.when(second % 5 == 0, F.col("pm25"))}
    lines = al.alert_lines(found.withColumns(holes), "station_id")
    return lines.groupBy("station_id", "alert_count").agg(
        F.count_if(F.contains("block", F.lit(f"Estacion: {al.NO_NAME}"))).alias("no_name"),
        F.count_if(F.contains("block", F.lit(f"AQI actual:    {al.NO_VALUE}"))).alias("no_index"),
        F.count_if(F.contains("block", F.lit(f"PM2.5:         {al.NO_VALUE}"))).alias("no_pm25"))


# --- alerts -----------------------------------------------------------------

def danger_alerts(spark, sf_dir):
    return plain(_rounded(_alerts(spark, sf_dir)))


def alert_counts(spark, sf_dir):
    return al.alert_counts(_alerts(spark, sf_dir), "station_id")


def alert_totals(spark, sf_dir):
    return al.alert_totals(_scored(spark, sf_dir), NOW, by="station_id")


def alert_totals_json(spark, sf_dir):
    return al.totals_json(al.alert_totals(_scored(spark, sf_dir), NOW, by="station_id"))


def alert_digest(spark, sf_dir):
    found = written(_alerts(spark, sf_dir), "alerts")
    return al.digest(found, NOW, "station_id", REGION, SIGNATURE, part_size=20)


def url_decode_keys(spark, sf_dir):
    """Object keys as a storage event delivers them."""
    key = F.concat(F.lit("curated/predictions/station_id%3D"), F.col("event_type"),
                   F.lit("/part%2D"), F.col("event_id").cast("string"), F.lit(".parquet"))
    decoded = events(spark, sf_dir).select("event_id", F.url_decode(key).alias("key"))
    return decoded.withColumn("is_parquet", F.endswith("key", F.lit(".parquet")))


# --- reports ----------------------------------------------------------------

def kpi_summary(spark, sf_dir):
    return rp.kpis(_clean(spark, sf_dir))


def hourly_aqi(spark, sf_dir):
    return plain(rp.hourly(_clean(spark, sf_dir)))


def station_summary(spark, sf_dir):
    return rp.station_summary(_clean(spark, sf_dir), scale=2)


def category_counts(spark, sf_dir):
    return rp.category_counts(_clean(spark, sf_dir))


def date_span(spark, sf_dir):
    return plain(rp.date_span(_clean(spark, sf_dir)))


def station_list(spark, sf_dir):
    return rp.station_list(_clean(spark, sf_dir))


def worst_10(spark, sf_dir):
    return plain(rp.worst(_clean(spark, sf_dir)))


def latest_10_features(spark, sf_dir):
    return plain(rp.latest(_features(spark, sf_dir), rp.LATEST_FEATURES))


def latest_10_predictions(spark, sf_dir):
    return plain(_rounded(rp.latest(_scored(spark, sf_dir), rp.LATEST_PREDICTIONS)))


def filtered_readings(spark, sf_dir):
    chosen = rp.select_readings(_clean(spark, sf_dir), SELECTED, *SELECTED_DAYS)
    return plain(rp.with_day_and_hour(chosen))


def filtered_kpis(spark, sf_dir):
    return rp.report(_clean(spark, sf_dir), SELECTED, *SELECTED_DAYS)["kpis"]


def last_7_days_export(spark, sf_dir):
    return plain(rp.last_days(_clean(spark, sf_dir), NOW))


# --- sources and sinks ------------------------------------------------------

def _dated(readings: DataFrame) -> DataFrame:
    """Folder columns of the intake: the day of the reading, if it can be read."""
    time = F.try_to_timestamp(F.col("timestamp"))
    return readings.withColumns({
        "year": F.date_format(time, "yyyy"), "month": F.date_format(time, "MM"),
        "day": F.date_format(time, "dd")})


def _raw_files(spark: SparkSession, readings: DataFrame) -> str:
    path = shared_folder(spark, "raw")
    writers.write_raw_json(_dated(readings), path, ["year", "month", "day"])
    return path


def _clean_files(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "clean")
    writers.write_clean(_clean(spark, sf_dir), path)
    return path


def _prediction_files(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "predictions")
    writers.write_predictions(_scored(spark, sf_dir), path)
    return path


def raw_json_scan(spark, sf_dir):
    path = _raw_files(spark, _readings(spark, sf_dir))
    return readers.read_raw(spark, path).select(*schemas.columns(schemas.RAW))


def _concatenated_files(spark: SparkSession, sf_dir: str) -> str:
    """A repeated reading on the same line as the first, without a separator."""
    objects = _raw(spark, sf_dir).select(
        *ARRIVAL, F.to_json(F.struct(*schemas.columns(schemas.RAW))).alias("object"))
    lines = objects.groupBy("event_id").agg(      # one or two objects each
        F.array_sort(F.collect_list(F.struct("ingest_seq", "object"))).alias("objects"))
    path = shared_folder(spark, "lines")
    lines.select(F.array_join(F.transform("objects", lambda o: o["object"]), "").alias("value")
                 ).write.text(path)
    return path


def concatenated_json_scan(spark, sf_dir):
    path = _concatenated_files(spark, sf_dir)
    return readers.read_raw(spark, path).select(*schemas.columns(schemas.RAW))


def _nested_files(spark: SparkSession, sf_dir: str) -> str:
    """Readings as an API forwards them: with fields of objects and lists that the schema
    does not name, with braces and quotes in texts, and repeated ones on the same line."""
    place = F.struct("latitude", F.array(F.struct(F.col("event_id").alias("seen"))).alias("log"))
    note = F.concat(F.lit('{"'), "event_id", F.lit("\\} }{ "), "station_name")
    raw = _raw(spark, sf_dir).withColumns({"coord": place, "note": note})
    extra = ["coord", *schemas.columns(schemas.RAW), "note"]
    objects = raw.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct(      # one or two each
        "ingest_seq", F.to_json(F.struct(*extra)).alias("object")))).alias("objects"))
    path = shared_folder(spark, "nested")
    objects.select(F.array_join("objects.object", " ").alias("value")).write.text(path)
    return path


def nested_json_scan(spark, sf_dir):
    """Also tells how many records could not be read."""
    raw = readers.read_raw(spark, _nested_files(spark, sf_dir))
    return raw.select(*schemas.columns(schemas.RAW), F.col(schemas.CORRUPT).isNotNull().alias("malformed"))


def malformed_records(spark, sf_dir):
    """Every 100th event also leaves a text that is no reading: a line without an
    object, an object without an end, or something behind an object."""
    raw = _raw(spark, sf_dir)
    whole = F.to_json(F.struct(*schemas.columns(schemas.RAW)))
    kind = F.col("event_id") % 300
    line = F.when(kind == 0, F.concat(F.lit("no reading "), "event_id", F.lit("\n"), whole)).when(
        kind == 100, F.concat(whole, F.lit('{"station_id":"cut '), "event_id")).when(
        kind == 200, F.concat(whole, F.lit(" behind "), "event_id")).otherwise(whole)
    path = shared_folder(spark, "malformed")
    raw.select(line.alias("value")).write.text(path)
    bad = quarantine(readers.read_raw(spark, path)).where("reason = 'malformed'")
    return bad.select(F.regexp_replace(F.trim(schemas.CORRUPT), r"^\{", "").alias("record"))


def clean_table_scan(spark, sf_dir):
    return plain(readers.read_clean(spark, _clean_files(spark, sf_dir)))


def clean_table_range(spark, sf_dir):
    table = readers.read_clean(spark, _clean_files(spark, sf_dir))
    return plain(rp.with_day_and_hour(rp.select_readings(table, SELECTED, *SELECTED_DAYS)))


def clean_table_count(spark, sf_dir):
    """Registered table, found partitions, plain SQL."""
    name = f"clean_{uuid.uuid4().hex}"
    writers.register_table(spark, name, _clean_files(spark, sf_dir), schemas.CLEAN,
                           schemas.CLEAN_PARTITIONS)
    counted = spark.sql(f"SELECT COUNT(*) AS lecturas FROM {name}").first()     # one row
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([tuple(counted)], "lecturas long")


def feature_table_scan(spark, sf_dir):
    path = shared_folder(spark, "features")
    writers.write_features(_features(spark, sf_dir), path)
    return plain(readers.read_features(spark, path))


def latest_10_sql(spark, sf_dir):
    """The look at the newest features through the registered table."""
    path, name = shared_folder(spark, "features"), f"features_{uuid.uuid4().hex}"
    writers.write_features(_features(spark, sf_dir), path)
    writers.register_table(spark, name, path, schemas.FEATURES, schemas.FEATURE_PARTITIONS)
    shown = ", ".join(rp.LATEST_FEATURES)
    return spark.sql(
        f"SELECT {shown} FROM {name} ORDER BY timestamp_parsed DESC NULLS LAST, station_id LIMIT 10")


def prediction_files_scan(spark, sf_dir):
    table = readers.read_predictions(spark, _prediction_files(spark, sf_dir))
    return plain(_rounded(table.drop("source_file")))


def csv_export_scan(spark, sf_dir):
    path = shared_folder(spark, "extract")
    writers.export_csv(_clean(spark, sf_dir), path)
    return plain(readers.read_export(spark, path))


def touched_days_overwrite(spark, sf_dir):
    """Rewriting some days of the clean table leaves the others as they were."""
    path = _clean_files(spark, sf_dir)
    some = rp.select_readings(_clean(spark, sf_dir), None, *SELECTED_DAYS)
    writers.write_clean(some.withColumn("station_name", F.upper("station_name")), path,
                        touched_only=True)
    return readers.read_clean(spark, path).groupBy("station_name").agg(
        F.count(F.lit(1)).alias("lecturas"))


def synthetic_readings(spark, sf_dir):
    return synthesize(events(spark, sf_dir), "event_id", STATIONS, NOW, SEED)


def synthetic_csv_scan(spark, sf_dir):
    path = shared_folder(spark, "synthetic")
    writers.write_csv(synthetic_readings(spark, sf_dir), path)
    return spark.read.schema(schemas.RAW).option("header", True).csv(path)


def pipeline_stage_counts(spark, sf_dir):
    """The whole batch run from raw files; rows per stage."""
    path = _raw_files(spark, _readings(spark, sf_dir))
    counts = run_batch(spark, path, shared_folder(spark, "run"), NOW)
    stages = ["read", "clean", "featured", "train", "test", "scored"]
    return spark.createDataFrame([(s, counts[s]) for s in stages], "stage string, n long")


def incremental_pipeline(spark, sf_dir):
    """Runs over three deliveries, each with readings of all days, equal one over all."""
    raw, out = shared_folder(spark, "raw"), shared_folder(spark, "incremental")
    readings = _raw(spark, sf_dir)
    for delivery in range(DELIVERIES):
        part = readings.where(F.pmod("event_id", F.lit(DELIVERIES)) == delivery).select(*schemas.columns(schemas.RAW))
        part.write.mode("append").json(raw)
        run_incremental(spark, raw, out, NOW, scale=2)
    return plain(readers.read_features(spark, Places(out).features))


def register_touched_days(spark, sf_dir):
    """A registered table follows a day that is added and one that is emptied, without a
    look at the others."""
    path, name = shared_folder(spark, "clean"), f"clean_{uuid.uuid4().hex}"
    timed = _clean(spark, sf_dir).where(F.col("curated_date").isNotNull())
    first, last = [F.lit(d).cast("date") for d in SELECTED_DAYS]
    writers.write_clean(timed.where(F.col("curated_date") != last), path)
    writers.register_table(spark, name, path, schemas.CLEAN, schemas.CLEAN_PARTITIONS)
    writers.write_clean(timed.where(F.col("curated_date") == last), path, touched_only=True)
    days = [date.fromisoformat(d) for d in SELECTED_DAYS]
    writers.remove(spark, f"{path}/year={days[0].year}/month={days[0].month}/day={days[0].day}")
    writers.register_days(spark, name, days)
    counted = spark.sql(f"SELECT CAST(curated_date AS STRING) AS day, COUNT(*) AS lecturas FROM {name} GROUP BY 1")
    counted = written(counted, "registered")
    spark.sql(f"DROP TABLE {name}")
    return counted


def schema_and_preview(spark, sf_dir):
    """Types of the stored tables, and how many rows a look at them shows."""
    table = readers.read_clean(spark, _clean_files(spark, sf_dir))
    shown = writers.preview(table, 5).count()
    return writers.schema_rows(table).withColumn("shown", F.lit(shown))


# --- streams ----------------------------------------------------------------

def stream_dedup(spark, sf_dir):
    path = shared_folder(spark, "stream-clean")
    intake.follow_clean(spark, _raw_files(spark, _readings(spark, sf_dir)), path,
                        shared_folder(spark, "ckpt")).awaitTermination()
    return plain(readers.read_clean(spark, path))


FIXED = {"weights": WEIGHTS, "means": MEANS, "stds": STDS, "bias": BIAS}
DELIVERIES = 3


def _delivered(spark: SparkSession, sf_dir: str, order: tuple[int, ...] = (0, 1, 2)) -> Places:
    """The chain over deliveries that each hold readings of all days."""
    raw, out, ckpt = (shared_folder(spark, n) for n in ("raw", "chain", "ckpt"))
    readings = _raw(spark, sf_dir)
    for delivery in order:
        part = readings.where(F.pmod("event_id", F.lit(DELIVERIES)) == delivery).select(*schemas.columns(schemas.RAW))
        part.write.mode("append").json(raw)
        run_stream(spark, raw, out, ckpt, FIXED, RUN_TS, NOW, scale=2).awaitTermination()
    return Places(out)


def stream_pipeline_predictions(spark, sf_dir):
    """Later deliveries are late, and the second comes twice."""
    places = _delivered(spark, sf_dir, (0, 1, 1, 2))
    return plain(_rounded(readers.read_predictions(spark, places.predictions).drop("source_file")))


def stream_withdrawn_alerts(spark, sf_dir):
    """Alerts that each delivery raised and withdrew, and those that stand at the end."""
    places = _delivered(spark, sf_dir)
    changed = read_by_batch(spark, places.alert_changes).where("change <> 'kept'").select(
        "station_id", "timestamp_parsed", "change", F.col("batch").cast("int").alias("delivery"))
    standing = spark.read.parquet(places.alerts).select(
        "station_id", "timestamp_parsed", F.lit("stands").alias("change"), F.lit(DELIVERIES).alias("delivery"))
    return plain(changed.unionByName(standing))


def stream_stage_counts(spark, sf_dir):
    """Rows of each step by micro-batch; a delivery that comes twice changes nothing."""
    places = _delivered(spark, sf_dir, (0, 1, 2, 2))
    return read_by_batch(spark, places.stages).select(F.col("batch").cast("int").alias("batch"), "stage", "n")


def stream_concatenated_intake(spark, sf_dir):
    raw = readers.stream_raw(spark, _concatenated_files(spark, sf_dir))
    path = shared_folder(spark, "stream-raw")
    intake.append_parquet(raw, path, shared_folder(spark, "ckpt")).awaitTermination()
    return spark.read.schema(raw.schema).parquet(path).select(*schemas.columns(schemas.RAW))


def stream_nested_intake(spark, sf_dir):
    raw = readers.stream_raw(spark, _nested_files(spark, sf_dir))
    path = shared_folder(spark, "stream-nested")
    intake.append_parquet(raw, path, shared_folder(spark, "ckpt")).awaitTermination()
    return spark.read.schema(raw.schema).parquet(path).select(*schemas.columns(schemas.RAW))


def stream_quarantine(spark, sf_dir):
    raw = readers.stream_raw(spark, _raw_files(spark, _readings(spark, sf_dir)))
    faulty = intake.stream_quarantine(raw)
    path = shared_folder(spark, "stream-quarantine")
    intake.append_parquet(faulty, path, shared_folder(spark, "ckpt")).awaitTermination()
    return spark.read.schema(faulty.schema).parquet(path).drop(schemas.CORRUPT)


def stream_hourly_aqi(spark, sf_dir):
    clean = readers.stream_clean(spark, _clean_files(spark, sf_dir))
    path = shared_folder(spark, "stream-hourly")
    sh.write_hourly(sh.stream_hourly(clean, LATE), path,
                    shared_folder(spark, "ckpt")).awaitTermination()
    return plain(sh.read_hourly(spark, path).drop("curated_date"))


def stream_hourly_late(spark, sf_dir):
    """The latest days are delivered first; no watermark loses the earlier ones."""
    src, path, ckpt = (shared_folder(spark, n) for n in ("clean", "hours", "ckpt"))
    clean = _clean_table(spark, sf_dir)
    cuts = [None, *SELECTED_DAYS[::-1], None]
    for high, low in zip(cuts, cuts[1:]):
        part = clean.where(F.coalesce(F.col("curated_date") < high, F.lit(False)) if high else F.lit(True))
        part = part.where(F.col("curated_date") >= low) if low else part
        part.write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(src)
        sh.merge_hours(spark, src, path, ckpt).awaitTermination()
    return plain(sh.read_merged_hours(spark, path))


def stream_feature_table(spark, sf_dir):
    feats, days = shared_folder(spark, "stream-features"), shared_folder(spark, "stream-days")
    sf.stream_features(spark, _clean_files(spark, sf_dir), feats, days,
                       shared_folder(spark, "ckpt"), scale=2).awaitTermination()
    return plain(readers.read_features(spark, feats))


def stateful_feature_table(spark, sf_dir):
    """Features from the state of each station; every seventh reading of the last two days
    of a delivery comes with the next one."""
    src, feats, ckpt = (shared_folder(spark, n) for n in ("clean", "stateful", "ckpt"))
    clean = _clean_table(spark, sf_dir)
    late = F.pmod(F.unix_timestamp("timestamp_parsed"), F.lit(7)) == 0
    taken = F.lit(False)
    for day in [*SELECTED_DAYS, None]:
        here = F.lit(True)
        if day:
            end = F.lit(day).cast("date")
            here = (F.col("curated_date") <= end) & ~(late & (F.col("curated_date") > F.date_sub(end, 2)))
        part = clean.where(F.col("curated_date").isNotNull() & here & ~taken)
        part.write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(src)
        taken = taken | here
        stateful.stateful_features(spark, src, feats, ckpt, late="3 days").awaitTermination()
    return plain(readers.read_features(spark, feats))


def stream_scores(spark, sf_dir):
    source = shared_folder(spark, "features")
    writers.write_features(_features(spark, sf_dir), source)
    scored = scoring.stream_score(readers.stream_features(spark, source), FIXED, RUN_TS)
    path = shared_folder(spark, "stream-predictions")
    intake.append_parquet(scored, path, shared_folder(spark, "ckpt"),
                          schemas.PREDICTION_PARTITIONS).awaitTermination()
    return plain(_rounded(readers.read_predictions(spark, path).drop("source_file")))


def stream_alerts(spark, sf_dir, mode="once"):
    pred = readers.stream_predictions(spark, _prediction_files(spark, sf_dir))
    found = scoring.stream_alerts(pred, NOW, mode=mode, watermark=LATE)
    path = shared_folder(spark, "stream-alerts")
    intake.append_parquet(found, path, shared_folder(spark, "ckpt")).awaitTermination()
    table = spark.read.schema(found.schema).parquet(path).drop("source_file")
    return plain(_rounded(table))


def stream_alerts_reference(spark, sf_dir):
    return stream_alerts(spark, sf_dir, "reference")


REGISTERED: list[Query] = [
    curated_readings, required_fields, quarantined_readings, dedup_readings, aqi_category_map,
    timestamp_parsing, rolling_pm25_24h, rolling_pm25_6h, rolling_aqi_24h_avg_max,
    rolling_aqi_1h, rolling_bucketed_24h, aqi_trend, aqi_trend_many_stations, calendar_features,
    high_pollution_label, label_six_hours_ahead, feature_table, training_rows, class_balance,
    hash_split_counts, scaler_stats, fixed_weight_scores, confusion_matrix,
    classification_metrics, auc_exact, predicted_state, lr_coefficients, lr_predictions, danger_alerts,
    alert_counts, alert_totals, alert_totals_json, alert_digest, incomplete_alerts, url_decode_keys, kpi_summary,
    hourly_aqi, station_summary, category_counts, date_span, station_list, worst_10,
    latest_10_features, latest_10_predictions, filtered_readings, filtered_kpis,
    last_7_days_export, raw_json_scan, concatenated_json_scan, nested_json_scan, malformed_records, clean_table_scan,
    clean_table_range, clean_table_count, feature_table_scan, latest_10_sql,
    prediction_files_scan, csv_export_scan, touched_days_overwrite, synthetic_readings, synthetic_csv_scan,
    pipeline_stage_counts, incremental_pipeline, register_touched_days, schema_and_preview, stream_dedup, stream_concatenated_intake, stream_nested_intake, stream_quarantine, stream_hourly_aqi, stream_hourly_late,
    stream_feature_table, stateful_feature_table, stream_scores, stream_alerts, stream_alerts_reference,
    stream_pipeline_predictions, stream_withdrawn_alerts, stream_stage_counts,
]


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)
    run.__name__ = query.__name__
    return run


def registered() -> dict[str, Query]:
    return {q.__name__: _in_utc(q) for q in REGISTERED}
