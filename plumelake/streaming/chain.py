"""The whole pipeline as a stream: raw files to clean table, features, predictions and
alerts, each kept current by the days a batch touches.

A batch may run twice after a failure, or bring rows that are late or were there
before: every table is a function of the readings seen so far, written by day over
what was there, so the result is the same. Nothing is appended, and no sink log stands
between these tables and a batch run: either may repair what the other wrote. Days and
stations that have no rows any more lose their folder.

An alert stands as long as its reading tells of danger. What each batch raised, kept and
withdrew on the days it touched is listed by batch in ``alert_changes``, and how many rows
its steps had in ``stages``; both are written before the alerts they compare with, so a
second run of a batch finds them and leaves them as they are.

Readings without a readable time have no day. They are listed in quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plumelake.operators.alerts import HOURS, THRESHOLD, alert_changes, standing_alerts
from plumelake.operators.curate import quarantine
from plumelake.plans.pipeline import Places
from plumelake.session import Workspace, use_utc
from plumelake.sources import schemas
from plumelake.sources.readers import exists, read_features, stream_raw
from plumelake.sources.writers import replace_days
from plumelake.streaming.features import note_days, refresh_features, touched_days
from plumelake.streaming.intake import merge_clean
from plumelake.streaming.scoring import stream_score


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a job of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def absorb(space: Workspace, batch: DataFrame, number: int, places: Places,
           scale: int | None = None) -> tuple[list, dict[str, int]]:
    """Bring quarantine, clean table and features up to date with the raw readings of
    one batch. Returns the days that changed, and rows by step."""
    spark = space.spark
    read, n_read = _counted(batch.select(*schemas.columns(schemas.RAW), schemas.CORRUPT))
    raw = space.written(read, "raw")
    faulty, n_faulty = _counted(quarantine(raw))
    faulty.write.mode("overwrite").parquet(f"{places.quarantine}/batch={number}")
    new = merge_clean(space, raw, places.clean)
    note_days(space, new, places.days)
    days = touched_days(space, new, places.days) if exists(spark, places.days) else []
    refresh_features(space, places.clean, places.features, places.days, days, scale)
    return days, {"read": n_read.get["n"], "quarantined": n_faulty.get["n"], "new": new.count()}


def judge(space: Workspace, days: list, number: int, places: Places, model: PipelineModel | Mapping,
          run_ts: str, now: str, threshold: float = THRESHOLD, hours: int = HOURS) -> dict[str, int]:
    """Predictions and alerts of the days that changed, and the list of changed alerts."""
    spark = space.spark
    rebuilt, n_feats = _counted(read_features(spark, places.features).where(F.col("curated_date").isin(days)))
    scored, n_scored = _counted(stream_score(rebuilt, model, run_ts).withColumn(
        "curated_date", F.to_date("timestamp_parsed")))
    current = space.written(scored, "scored")
    replace_days(current, places.predictions, days, schemas.PREDICTION_PARTITIONS)

    old = spark.createDataFrame([], current.schema)
    if exists(spark, places.alerts):
        old = spark.read.schema(current.schema).parquet(places.alerts).where(F.col("curated_date").isin(days))
    standing = space.written(standing_alerts(current, old, now, threshold, hours), "standing")
    listed = f"{places.alert_changes}/batch={number}"
    if not exists(spark, f"{listed}/_SUCCESS"):
        alert_changes(old, standing).write.mode("overwrite").parquet(listed)
    changes = spark.read.parquet(listed).groupBy("change").count().collect()      # three rows at most
    replace_days(standing, places.alerts, days)
    counts = {"featured": n_feats.get["n"], "scored": n_scored.get["n"], "raised": 0, "kept": 0, "withdrawn": 0}
    return counts | {r["change"]: r["count"] for r in changes}


def update(spark: SparkSession, batch: DataFrame, number: int, places: Places,
           model: PipelineModel | Mapping, run_ts: str, now: str, scale: int | None = None,
           threshold: float = THRESHOLD, hours: int = HOURS) -> None:
    """Bring all tables up to date with the raw readings of one batch."""
    with Workspace(spark, "batch") as space:
        days, counts = absorb(space, batch, number, places, scale)
        if days:
            counts |= judge(space, days, number, places, model, run_ts, now, threshold, hours)
        rows = spark.createDataFrame(list(counts.items()), schemas.STAGES)
        if not exists(spark, f"{places.stages}/batch={number}/_SUCCESS"):
            rows.coalesce(1).write.mode("overwrite").parquet(f"{places.stages}/batch={number}")


def read_by_batch(spark: SparkSession, path: str) -> DataFrame:
    """A table that is written batch by batch, with the number of the batch."""
    return spark.read.parquet(path)


def run_stream(spark: SparkSession, raw_path: str, out_path: str, checkpoint: str,
               model: PipelineModel | Mapping, run_ts: str, now: str, every: str | None = None,
               scale: int | None = None, max_files: int | None = None) -> StreamingQuery:
    """Follow the raw files. Without ``every`` the query works off what is there and
    ends, so any scheduler can call it."""
    use_utc(spark)
    places = Places(out_path)

    def put(batch: DataFrame, number: int) -> None:
        update(spark, batch, number, places, model, run_ts, now, scale)

    writer = stream_raw(spark, raw_path, max_files).writeStream.option(
        "checkpointLocation", checkpoint).foreachBatch(put)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
