"""Scoring and alerting as streams."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from plumelake.operators.alerts import HOURS, THRESHOLD, alerts
from plumelake.operators.model import score, score_with, training_frame


def stream_score(src: DataFrame, model: PipelineModel | Mapping, run_ts: str) -> DataFrame:
    """Predictions for new feature rows, row by row, from a fitted model or from
    coefficients as ``score_with`` takes them."""
    frame = training_frame(src)
    if isinstance(model, Mapping):
        return score_with(frame, **model, run_ts=run_ts)
    return score(model, frame, run_ts)


def stream_alerts(src: DataFrame, now: str | datetime | Column | None = None, mode: str = "reference",
                  threshold: float = THRESHOLD, hours: int = HOURS,
                  watermark: str = "2 days") -> DataFrame:
    """Alerts among new prediction rows.

    ``now`` defaults to the time of each batch. ``mode="reference"`` raises an
    alert every time a prediction arrives, so rewriting a prediction repeats it.
    ``mode="once"`` raises one alert per station and reading.
    """
    found = alerts(src, F.current_timestamp() if now is None else now, threshold, hours)
    if mode == "reference":
        return found
    if mode == "once":
        return found.withWatermark("timestamp_parsed", watermark).dropDuplicatesWithinWatermark(
            ["station_id", "timestamp_parsed"])
    raise ValueError(f"unknown mode {mode!r}")
