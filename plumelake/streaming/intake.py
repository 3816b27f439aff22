"""Raw files as they arrive to the clean table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plumelake.operators.curate import IDENTITY, clean_nulls, dedup, parse_time, quarantine, shape_clean
from plumelake.session import Workspace
from plumelake.sources import schemas
from plumelake.sources.readers import day_folders, folder_values, read_clean, read_clean_if_there, stream_raw
from plumelake.sources.writers import append_clean, key_path, put_clean, write_by_day


KEY = ["station_id", "timestamp_parsed"]
# Which of several readings of one station and instant survives: the values decide, as in
# the batch form without an order of arrival.
SURVIVOR = [c for c in schemas.columns(schemas.RAW) if c not in IDENTITY]


def merge_clean(space: Workspace, raw: DataFrame, clean_path: str) -> DataFrame:
    """Add raw readings to the clean table and return them, cleaned.

    Days that hold none of the new keys get new files, and nothing of them is read. Days
    that may hold one are read and written over, with the survivor of several readings of
    one station and instant, which is the same in any order of arrival. So a late or
    repeated delivery, or a second run of a batch, changes nothing. Whether a day holds a
    key is told by the key filter (``note_keys``), which is brought up to date before the
    readings are written: a run that fails between them finds its keys next time.
    """
    spark = raw.sparkSession
    timed = shape_clean(parse_time(clean_nulls(raw)).where(F.col("timestamp_parsed").isNotNull()))
    new = space.written(dedup(timed, KEY, SURVIVOR), "new")
    days = [r[0] for r in new.select("curated_date").distinct().collect()]     # bounded by the calendar
    if days:
        known = note_keys(space, new, days, clean_path)
        fresh = [d for d in days if d not in known]
        if known:
            both = on_days(read_clean_if_there(spark, clean_path), known).unionByName(on_days(new, known))
            put_clean(space.written(dedup(both, KEY, SURVIVOR), "merged"), clean_path, touched_only=True)
        if fresh:
            append_clean(on_days(new, fresh), clean_path)
    return new


def key_bits(readings: DataFrame) -> DataFrame:
    """The minutes of each station, day and hour that have a reading, as the bits of a
    number: at most 24 rows for a station and day, however many readings it has."""
    time = F.col("timestamp_parsed")
    return readings.groupBy("curated_date", "station_id", F.hour(time).alias("hour")).agg(
        F.bit_or(F.expr("shiftleft(1L, minute(timestamp_parsed))")).alias("bits"))


def note_keys(space: Workspace, new: DataFrame, days: list, clean_path: str) -> list:
    """Add the keys of new readings to the filter, and return the days that may hold one of
    them already: those with a reading of the same station and minute, and those that the
    filter does not know but the clean table does."""
    spark, path = new.sparkSession, key_path(clean_path)
    fresh = space.written(key_bits(new), "keys")
    listed = set(day_folders(spark, path))
    there = [d for d in days if d in listed]
    unknown = [d for d in days if d not in listed and d in set(clean_days(spark, clean_path))]
    hit: list = []
    if unknown:     # written without the filter
        stored = key_bits(on_days(read_clean(spark, clean_path), unknown))
        fresh = space.written(_merged_bits(fresh.unionByName(stored)), "keys-unknown")
    if there:
        known = spark.read.schema(schemas.KEYS).parquet(path).where(F.col("curated_date").isin(there))
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("curated_date", "station_id", "hour")]
        both = fresh.alias("n").join(known.alias("k"), same).where("n.bits & k.bits <> 0")
        hit = [r[0] for r in both.select("n.curated_date").distinct().collect()]      # bounded by the calendar
        fresh = space.written(_merged_bits(fresh.unionByName(known.select(*fresh.columns))), "keys-merged")
    write_by_day(fresh, path)
    return sorted({*hit, *unknown})


def _merged_bits(rows: DataFrame) -> DataFrame:
    return rows.groupBy("curated_date", "station_id", "hour").agg(F.bit_or("bits").alias("bits"))


def clean_days(spark: SparkSession, clean_path: str) -> list[date]:
    """Days that have a folder in the clean table."""
    return [date(*map(int, parts)) for parts in folder_values(spark, clean_path, schemas.CLEAN_PARTITIONS)
            if all(p.isdigit() for p in parts)]


def on_days(df: DataFrame, days: list) -> DataFrame:
    """Readings of some days, by the folder columns of the clean table, so other
    days are not listed or read. The list is bounded by the calendar."""
    folder = F.make_date(*[F.col(c).cast("int") for c in schemas.CLEAN_PARTITIONS])
    return df.where(folder.isin(days))


def follow_clean(spark: SparkSession, raw_path: str, clean_path: str, checkpoint: str,
                 every: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Keep the clean table current while raw files arrive."""
    def put(batch: DataFrame, number: int) -> None:
        with Workspace(spark, "batch") as space:
            merge_clean(space, space.written(batch.select(*schemas.columns(schemas.RAW)), "raw"), clean_path)

    writer = stream_raw(spark, raw_path, max_files).writeStream.option(
        "checkpointLocation", checkpoint).foreachBatch(put)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def stream_quarantine(src: DataFrame) -> DataFrame:
    """Faulty readings with the reason, row by row."""
    return quarantine(src)


def append_parquet(df: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None,
                   every: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once. Without ``every``
    the query works off what is there and ends."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if keys:
        writer = writer.partitionBy(*keys)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
