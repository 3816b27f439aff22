"""Air-quality index expressions. The index is an ordinal from 1 to 5."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumelake.functions.times import as_col

# The labels and limits that results must carry.
AQI_LABELS = {
    1: "Buena",
    2: "Moderada",
    3: "Insalubre sensibles",
    4: "Insalubre",
    5: "Peligrosa",
}
AQI_UNKNOWN = "Desconocida"
HIGH_LIMIT = 3      # training label: this index or worse
DANGER_LIMIT = 4    # report panels: this index or worse
STATE_DANGER = "PELIGROSO"
STATE_NORMAL = "NORMAL"
WEEKEND = (1, 7)    # dayofweek, 1 = Sunday


def aqi_category(aqi: str | Column) -> Column:
    """Label of an index; anything outside 1 to 5, and null, is unknown."""
    pairs = [F.lit(part) for pair in AQI_LABELS.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_col(aqi)), F.lit(AQI_UNKNOWN))


def reaches(aqi: str | Column, limit: int) -> Column:
    """1 if the index is at or above ``limit``, else 0; null stays null."""
    return (as_col(aqi) >= limit).cast("int")


def weekend_flag(day_of_week: str | Column) -> Column:
    return as_col(day_of_week).isin(*WEEKEND).cast("int")


def predicted_state(prediction: str | Column) -> Column:
    return F.when(as_col(prediction) == 1.0, STATE_DANGER).otherwise(STATE_NORMAL)
