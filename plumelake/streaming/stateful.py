"""The feature table from keyed state: each station keeps its readings of the last day.

Where ``stream_features`` reads days of the clean table back, here the readings that a
frame can still reach are state of the stream, so a batch reads nothing but itself. What a
reading changes are its own features, those of the readings in the 24 hours behind it, and
the trend of the next one; just these rows come out and replace theirs in the table.

Kept are readings up to ``late`` and a day older than the newest of the station, and the
last one before them, for the trend. Readings later than the watermark are left out by
Spark; ``refresh_features`` mends their days from the clean table. A station that falls
silent is cut down to its last reading by a timer.

Sums run over whole units (``scale``), so the values are those of the batch form bit by
bit. The readings of a station and batch are worked on at once, as arrays; only
``STEP`` of them are Python objects at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from plumelake.functions.numbers import to_units
from plumelake.functions.times import DAY
from plumelake.operators.features import FEATURE_SPECS, calendar, label
from plumelake.session import Workspace
from plumelake.sources import schemas
from plumelake.sources.readers import exists, read_features, stream_clean
from plumelake.sources.writers import write_features

# The processor travels with the query, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules["plumelake"])

TREND = "tendencia_aqi"
# What a reading brings along: its instant, its values, and PM2.5 in whole units.
_VALUES = ["station_name", "latitude", "longitude", "aqi", "aqi_category", "pm25", "pm10", "co", "no2", "o3"]
_STORED = T.StructType([*[schemas.CLEAN[c] for c in _VALUES], T.StructField("units", T.LongType())])
_OUT = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("micros", T.LongType()),
                     *_STORED.fields[:-1], *[schemas.FEATURES[s.out] for s in FEATURE_SPECS], schemas.FEATURES[TREND]])
_WHOLE = [isinstance(f.dataType, T.IntegralType) for f in _STORED.fields]
_PRIORITY = [_VALUES.index(c) for c in schemas.columns(schemas.RAW) if c in _VALUES]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


STEP = 1 << 14      # readings that are Python objects at once


def _columns(frame: pd.DataFrame) -> dict[str, pd.Series]:
    """Readings as arrays of one kind: null for NaN, whole numbers whole, which pandas makes
    fractions of in a column with nulls; equal texts of a batch are one object."""
    out = {"micros": frame["micros"].astype("int64")}
    for f, whole in zip(_STORED.fields, _WHOLE):
        kind = "Int64" if whole else "float64" if isinstance(f.dataType, T.FractionalType) else object
        out[f.name] = frame[f.name].astype(kind)
    return out


def _gathered(parts: list[dict[str, pd.Series]]) -> pd.DataFrame:
    """The parts, which are used up column by column, behind each other."""
    return pd.DataFrame({c: pd.concat([p.pop(c) for p in parts], ignore_index=True) for c in ["micros", *_STORED.names]},
                        copy=False)


def _stored(rows: Iterator[tuple]) -> Iterator[dict[str, pd.Series]]:
    """The readings of the state, some at a time."""
    rows, texts = iter(rows), {}
    while part := list(islice(rows, STEP)):
        frame = pd.DataFrame([tuple(texts.setdefault(v, v) if isinstance(v, str) else v for v in r) for r in part],
                             columns=["micros", *_STORED.names])
        yield _columns(frame)


def _plain(frame: pd.DataFrame) -> list[tuple]:
    """Rows as state takes them: no numpy types, null for NaN."""
    return list(zip(*[[None if v is None or v is pd.NA or v != v else v for v in frame[c].tolist()] for c in frame]))


def _survivors(given: pd.DataFrame) -> np.ndarray:
    """Places of one reading per instant, by time. Of two the lower one survives, nulls first,
    as in the batch form without an order of arrival; of equal ones the first."""
    again = given["micros"].duplicated(keep=False).to_numpy()
    stay = np.nonzero(~again)[0]
    if again.any():
        several = given[again].sort_values(["micros", *[_VALUES[i] for i in _PRIORITY]], na_position="first", kind="stable")
        stay = np.concatenate([stay, several.index[~several["micros"].duplicated().to_numpy()].to_numpy()])
    return stay[np.argsort(given["micros"].to_numpy()[stay], kind="stable")]


class StationHistory(StatefulProcessor):
    """State and features of one station at a time."""

    def __init__(self, late: int, scale: int) -> None:
        self.keep, self.scale = late + DAY, scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getListState("readings", T.StructType([T.StructField("micros", T.LongType()), *_STORED.fields]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(_stored(self.readings.get()))
        before = sum(len(p["micros"]) for p in parts)
        parts += [_columns(batch) for batch in rows]
        if not parts:
            return
        given = _gathered(parts)
        stay = _survivors(given)
        changed = stay >= before
        if not changed.any():
            return
        known = given.iloc[stay].reset_index(drop=True)
        del given
        times = known["micros"].to_numpy()
        kept = known.iloc[self._old(times):]
        self.readings.put(_plain(kept[:STEP]))
        for at in range(STEP, len(kept), STEP):
            self.readings.appendList(_plain(kept[at:at + STEP]))
        self.handle.registerTimer(int(times[-1]) // 1000 + self.keep * 1000)
        for out in self._features(times, known, times[changed]):
            out.insert(0, "station_id", key[0])
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = sorted(map(tuple, self.readings.get()), key=lambda r: r[0])
        if known and known[-1][0] // 1000 + self.keep * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.readings.put(known[-1:])
        return iter([])

    def close(self) -> None:
        pass

    def _old(self, times: np.ndarray) -> int:
        """How many readings no frame can reach any more, but for the last of them."""
        cut = int(np.searchsorted(times, times[-1] - self.keep * 1_000_000))
        return max(cut - 1, 0)

    def _features(self, times: np.ndarray, known: pd.DataFrame, changed: np.ndarray) -> Iterator[pd.DataFrame]:
        """The rows that readings at the times ``changed`` reach, ``STEP`` at a time."""
        second = np.floor_divide(times, 1_000_000)
        own = np.floor_divide(changed, 1_000_000)
        marks = np.zeros(len(times) + 1, np.int64)
        at = np.searchsorted(times, changed)
        np.add.at(marks, np.searchsorted(second, own), 1)
        np.add.at(marks, np.searchsorted(second, own + DAY, "right"), -1)
        reached = np.cumsum(marks[:-1]) > 0
        reached[np.minimum(at + 1, len(times) - 1)] = True
        every = np.nonzero(reached)[0]

        given, whole, sums = {}, {}, {}
        for c, source in (("pm25", "units"), ("aqi", "aqi")):
            given[c] = known[source].notna().to_numpy()
            whole[c] = known[source].to_numpy(np.int64, na_value=0)
            sums[c] = [np.concatenate([[0], np.cumsum(v)]) for v in (given[c], whole[c])]
        lowest = np.iinfo(np.int64).min
        padded = {c: np.append(np.where(given[c], whole[c], lowest), lowest) for c in given}
        for start in range(0, len(every), STEP):
            rows = every[start:start + STEP]
            frame = known.iloc[rows].reset_index(drop=True)
            for s in FEATURE_SPECS:
                low, high = np.searchsorted(second, second[rows] - s.seconds), np.searchsorted(second, second[rows], "right")
                n, total = (v[high] - v[low] for v in sums[s.col])
                if s.fn == "max":
                    best = np.maximum.reduceat(padded[s.col], np.stack([low, high], 1).ravel())[::2]
                    frame[s.out] = pd.array([int(b) if k else None for b, k in zip(best, n)], "Int32")
                else:
                    divisor = n * float(10 ** self.scale if s.col == "pm25" else 1)
                    with np.errstate(invalid="ignore"):
                        mean = total.astype(np.float64) / divisor
                    frame[s.out] = [m if k else None for m, k in zip(mean.tolist(), n.tolist())]
            last = np.maximum(rows - 1, 0)
            both = (rows > 0) & given["aqi"][rows] & given["aqi"][last]
            step = whole["aqi"][rows] - whole["aqi"][last]
            frame[TREND] = pd.array([d if k else None for d, k in zip(step.tolist(), both.tolist())], "Int32")
            frame["aqi"] = frame["aqi"].astype("Int32")
            yield frame.drop(columns="units")


def station_features(clean: DataFrame, late: str = "2 days", scale: int = 2) -> DataFrame:
    """Changed feature rows of a stream of clean readings: the feature columns, rows
    without a mean included, so that they can replace what was there."""
    seconds = int(pd.Timedelta(late).total_seconds())
    timed = clean.where(F.col("timestamp_parsed").isNotNull()).withWatermark("timestamp_parsed", late)
    given = timed.select("station_id", "timestamp_parsed", F.unix_micros("timestamp_parsed").alias("micros"), *_VALUES,
                         to_units("pm25", scale).alias("units"))
    rows = given.groupBy("station_id").transformWithStateInPandas(
        StationHistory(seconds, scale), _OUT, outputMode="Update", timeMode="EventTime")
    dated = rows.withColumn("timestamp_parsed", F.timestamp_micros("micros")).withColumn(
        "curated_date", F.to_date("timestamp_parsed"))
    return label(calendar(dated)).select(*schemas.columns(schemas.FEATURES))


def stateful_features(spark: SparkSession, clean_path: str, features_path: str, checkpoint: str,
                      every: str | None = None, late: str = "2 days", scale: int = 2,
                      max_files: int | None = None) -> StreamingQuery:
    """Follow the clean table and keep the feature table current from keyed state. A
    batch may run twice after a failure: its rows replace themselves. The session must
    use the RocksDB state store (``PROVIDER``)."""
    def put(batch: DataFrame, number: int) -> None:
        with Workspace(spark, "stateful") as space:
            new = space.written(batch, "new")
            days = [r[0] for r in new.select("curated_date").distinct().collect()]     # bounded by the calendar
            if not days:
                return
            rows = new.dropna(subset=["pm25_prom_24h", "aqi_prom_24h"])
            if exists(spark, features_path):
                stored = read_features(spark, features_path).where(F.col("curated_date").isin(days))
                rows = stored.join(new, ["station_id", "timestamp_parsed"], "left_anti").select(
                    *new.columns).unionByName(rows)
            write_features(space.written(rows, "merged"), features_path, touched_only=True)

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = station_features(stream_clean(spark, clean_path, max_files), late, scale)
    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
