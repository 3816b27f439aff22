"""The batch pipeline: raw files to clean table, features, model, predictions,
alerts and messages. Tables are the hand-over between steps, so no step computes
an earlier one again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from plumelake.operators.alerts import HOURS, THRESHOLD, alert_lines, alerts, digest
from plumelake.operators.curate import clean_nulls, dedup, parse_time, quarantine, shape_clean
from plumelake.operators.features import features
from plumelake.operators.model import (
    PREDICTED, PROBABILITY, REAL, auc, fit, metrics, save_model, score, split, training_frame)
from plumelake.session import Workspace, use_utc
from plumelake.sources.readers import read_clean, read_features, read_predictions, read_raw
from plumelake.sources.schemas import CORRUPT, RAW, columns
from plumelake.sources.writers import write_clean, write_features, write_predictions


@dataclass(frozen=True)
class Places:
    """Where a run keeps its tables."""
    out: str

    def __getattr__(self, name: str) -> str:
        if name in ("clean", "quarantine", "features", "model", "predictions", "test_scores",
                    "alerts", "alert_changes", "alert_lines", "messages", "days", "stages", "ledger"):
            return f"{self.out.rstrip('/')}/{name}"
        raise AttributeError(name)


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def build_clean(spark: SparkSession, raw_path: str, places: Places, timed_only: bool = False) -> dict[str, int]:
    """Clean and quarantine tables. The JSON is parsed once, into a staged table that
    both are made from. ``timed_only`` leaves readings without a readable time to
    quarantine, as streams and incremental runs do."""
    raw = read_raw(spark, raw_path)
    staged, read = _counted(raw.select(*columns(RAW), CORRUPT), "read")
    with Workspace(spark, "stage") as space:
        raw = space.written(staged, "raw")
        shaped = shape_clean(parse_time(dedup(clean_nulls(raw.select(*columns(RAW))))))
        clean, kept = _counted(shaped.where(F.col("timestamp_parsed").isNotNull()) if timed_only else shaped, "clean")
        write_clean(clean, places.clean)
        quarantine(raw).write.mode("overwrite").parquet(places.quarantine)
    return {"read": read.get["n"], "clean": kept.get["n"]}


def build_features(spark: SparkSession, places: Places, scale: int | None = None,
                   horizon: int | None = None) -> dict[str, int]:
    clean = read_clean(spark, places.clean)
    feats, made = _counted(features(clean, scale=scale, horizon=horizon), "featured")
    write_features(feats, places.features)
    return {"featured": made.get["n"]}


def train_and_score(spark: SparkSession, places: Places, run_ts: str,
                    split_method: str = "hash") -> dict[str, int | float]:
    """Fit on the training side, evaluate on the other, score all rows."""
    frame = training_frame(read_features(spark, places.features))
    train, test = split(frame, method=split_method)
    model = fit(train)
    save_model(model, places.model)

    tested, n_test = _counted(
        score(model, test, run_ts).select(REAL, PREDICTED, PROBABILITY), "test")
    tested.write.mode("overwrite").parquet(places.test_scores)
    held_out = spark.read.schema(tested.schema).parquet(places.test_scores)
    quality = {**metrics(held_out).first().asDict(), **auc(held_out).first().asDict()}

    predictions, scored = _counted(score(model, frame, run_ts), "scored")
    write_predictions(predictions, places.predictions)
    return {"test": n_test.get["n"], "scored": scored.get["n"],
            "train": scored.get["n"] - n_test.get["n"], **quality}


def raise_alerts(spark: SparkSession, places: Places, now: str, threshold: float = THRESHOLD,
                 hours: int = HOURS, by: str = "source_file", region: str = "",
                 signature: str = "", part_size: int | None = None) -> dict[str, int]:
    """The alerts, a table of one line each, and the messages made from them, one per
    file unless ``part_size`` divides them."""
    found, raised = _counted(
        alerts(read_predictions(spark, places.predictions), now, threshold, hours), "alerts")
    found.write.mode("overwrite").parquet(places.alerts)
    table = spark.read.schema(found.schema).parquet(places.alerts)
    alert_lines(table, by).write.mode("overwrite").parquet(places.alert_lines)
    digest(table, now, by, region, signature, part_size=part_size).write.mode("overwrite").parquet(places.messages)
    return {"alerts": raised.get["n"]}


def run_batch(spark: SparkSession, raw_path: str, out_path: str, now: str,
              scale: int | None = None, split_method: str = "hash", region: str = "", signature: str = "",
              timed_only: bool = False) -> dict:
    """All steps in order; an error ends the run. Returns row counts per stage and
    the quality of the model. Any outside scheduler can call it every two hours."""
    use_utc(spark)
    places = Places(out_path)
    result = build_clean(spark, raw_path, places, timed_only)
    result |= build_features(spark, places, scale)
    result |= train_and_score(spark, places, now, split_method)
    result |= raise_alerts(spark, places, now, region=region, signature=signature)
    return result
