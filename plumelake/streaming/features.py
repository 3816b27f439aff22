"""Keep the feature table current while clean readings arrive.

RANGE frames and ``lag`` are not allowed on a stream, and a late reading changes
features of readings that were there before it: all within 24 hours after it, and
the trend of the next reading however far off. So each batch finds the days it
touched and rebuilds exactly those from the clean table with the batch operator.
Readings without a time have no day; the result is that of the batch operator with
``drop_null_time=True``.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plumelake.functions.times import DAY
from plumelake.operators.features import FEATURE_SPECS, features
from plumelake.sources import schemas
from plumelake.session import Workspace
from plumelake.sources.readers import day_folders, exists, folder_values, read_clean, stream_clean
from plumelake.sources.writers import remove, write_by_day, write_features
from plumelake.streaming.intake import on_days

REACH_DAYS = -(-max(s.seconds for s in FEATURE_SPECS) // DAY)


def note_days(space: Workspace, new: DataFrame, days_path: str) -> None:
    """Add the stations and days of new readings to the table of station days: one row
    each, in a folder per day that is written over, so it does not grow with batches; and
    move the frontier, the first and last day of each station."""
    spark = new.sparkSession
    fresh = space.written(new.where(F.col("curated_date").isNotNull()).select(
        "station_id", "curated_date").distinct(), "days")
    touched = [r[0] for r in fresh.select("curated_date").distinct().collect()]    # bounded by the calendar
    if not touched:
        return
    _move_frontier(space, fresh, days_path)
    if exists(spark, days_path):
        known = _station_days(spark, days_path, touched)
        fresh = space.written(fresh.unionByName(known).distinct(), "days-merged")
    write_by_day(fresh, days_path)


def _station_days(spark: SparkSession, path: str, days: list) -> DataFrame:
    """Stations that have readings on some days; other folders are not read."""
    return spark.read.schema(schemas.STATION_DAY).parquet(path).where(F.col("curated_date").isin(days))


def frontier_path(days_path: str) -> str:
    return f"{days_path.rstrip('/')}-frontier"


def _versions(spark: SparkSession, path: str) -> list[int]:
    found = sorted(int(v) for (v,) in folder_values(spark, path, ["version"]))
    return [v for v in found if exists(spark, f"{path}/version={v}/_SUCCESS")]


def _frontier(spark: SparkSession, days_path: str) -> DataFrame:
    """One row per station. A table of days that was written without it is read once."""
    path = frontier_path(days_path)
    versions = _versions(spark, path)
    if versions:
        return spark.read.schema(schemas.FRONTIER).parquet(f"{path}/version={versions[-1]}")
    if not exists(spark, days_path):
        return spark.createDataFrame([], schemas.FRONTIER)
    return _spans(spark.read.schema(schemas.STATION_DAY).parquet(days_path).select(
        "station_id", F.col("curated_date").alias("first"), F.col("curated_date").alias("last")))


def _spans(rows: DataFrame) -> DataFrame:
    return rows.groupBy("station_id").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def _move_frontier(space: Workspace, fresh: DataFrame, days_path: str) -> None:
    """A new version of the frontier; the one before is deleted when it is complete."""
    spark, path = space.spark, frontier_path(days_path)
    own = fresh.select("station_id", F.col("curated_date").alias("first"), F.col("curated_date").alias("last"))
    versions = _versions(spark, path)
    version = versions[-1] + 1 if versions else 0
    _spans(_frontier(spark, days_path).unionByName(own)).write.mode("overwrite").parquet(f"{path}/version={version}")
    for old in versions:
        remove(spark, f"{path}/version={old}")


def neighbours(space: Workspace, keys: DataFrame, days_path: str, name: str, back: bool) -> DataFrame:
    """Of station days, the day with readings before (``back``) or after it, in ``other``.

    The frontier tells which have one; it is searched for day by day in widening spans, so
    what is read grows with the gap between the two, not with the age of the table.
    """
    spark = space.spark
    edge = F.col("curated_date") > F.col("first") if back else F.col("curated_date") < F.col("last")
    left = space.written(keys.join(_frontier(spark, days_path), "station_id").where(edge).select(*keys.columns), name)
    known, width, found = day_folders(spark, days_path), 2, []
    by_time = Window.partitionBy("station_id").orderBy(F.col("curated_date") if back else F.desc("curated_date"))
    while True:
        low, high = left.agg(F.min("curated_date"), F.max("curated_date")).first()
        if low is None:
            break
        reach = timedelta(days=width)
        span = [d for d in known if (low - reach <= d <= high if back else low <= d <= high + reach)]
        pairs = _station_days(spark, days_path, span).withColumn("other", F.lag("curated_date").over(by_time))
        near = space.written(pairs.where(F.col("other").isNotNull()).join(
            left, ["station_id", "curated_date"], "left_semi"), f"{name}-near-{width}")
        found.append(near)
        left = space.written(left.join(near, ["station_id", "curated_date"], "left_anti"), f"{name}-left-{width}")
        if span == [d for d in known if (d <= high if back else d >= low)]:
            break
        width *= 4
    none = spark.createDataFrame([], T.StructType([*schemas.STATION_DAY.fields, T.StructField("other", T.DateType())]))
    return reduce(DataFrame.unionByName, found, none)


def touched_days(space: Workspace, new: DataFrame, days_path: str) -> list:
    """Days whose features new readings (as station and day) can change: their own
    days, the days their frames reach into, and the day of each station's next
    reading."""
    dated = new.where(F.col("curated_date").isNotNull()).select("station_id", "curated_date").distinct()
    own = dated.select(F.explode(F.sequence(
        "curated_date", F.date_add("curated_date", REACH_DAYS))).alias("curated_date"))
    after = neighbours(space, dated, days_path, "after", back=False).select(F.col("other").alias("curated_date"))
    rows = own.unionByName(after).distinct().collect()   # bounded by the calendar
    return sorted(r[0] for r in rows)


def refresh_features(space: Workspace, clean_path: str, features_path: str, days_path: str,
                     days: list, scale: int | None = None) -> None:
    """Rebuild the feature rows of ``days`` and overwrite only those folders.

    Read are the days themselves, the days their frames reach back into, and for
    each station its last day with readings before one of them (for the trend).
    """
    if not days:
        return
    spark = space.spark
    reach = sorted({d - timedelta(days=n) for d in days for n in range(REACH_DAYS + 1)})
    before = neighbours(space, _station_days(spark, days_path, days), days_path, "before", back=True)
    wanted = space.written(_station_days(spark, days_path, reach).unionByName(
        before.select("station_id", F.col("other").alias("curated_date"))).distinct(), "wanted")
    # A list of days, bounded by the calendar.
    listed = sorted(r[0] for r in wanted.select("curated_date").distinct().collect())
    source = on_days(read_clean(spark, clean_path), listed).join(
        wanted, ["station_id", "curated_date"], "left_semi")
    rows = features(source, scale=scale).where(F.col("curated_date").isin(days))
    write_features(rows, features_path, touched_only=True)


def stream_features(spark: SparkSession, clean_path: str, features_path: str, days_path: str,
                    checkpoint: str, every: str | None = None, scale: int | None = None,
                    max_files: int | None = None) -> StreamingQuery:
    """Follow the clean table and keep the feature table current.

    For a clean table that only gets new files; where days are written over, the chain
    (``run_stream``) keeps both tables. A batch may run twice after a failure; the
    result is the same, since it is rebuilt from the clean table.
    """
    def update(batch: DataFrame, number: int) -> None:
        with Workspace(spark, "batch") as space:
            new = space.written(batch.select("station_id", "curated_date").distinct(), "new")
            note_days(space, new, days_path)
            days = touched_days(space, new, days_path) if exists(spark, days_path) else []
            refresh_features(space, clean_path, features_path, days_path, days, scale)

    writer = (
        stream_clean(spark, clean_path, max_files).writeStream
        .option("checkpointLocation", checkpoint).foreachBatch(update)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
