"""Hourly mean index as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plumelake.session import Workspace
from plumelake.sources import schemas
from plumelake.sources.readers import exists, stream_clean
from plumelake.sources.writers import write_by_day

MERGED = ["total", "readings", "batch"]


def stream_hourly(src: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Mean index per station and hour, updated as readings arrive. The state is
    a sum and a count per open hour and station."""
    known = src.where(F.col("station_name").isNotNull() & F.col("timestamp_parsed").isNotNull())
    return (
        known.withWatermark("timestamp_parsed", watermark)
        .groupBy(F.window("timestamp_parsed", "1 hour").alias("_hour"), "station_name")
        .agg(F.avg("aqi").alias("aqi"))
        .select(F.col("_hour.start").alias("timestamp_parsed"), "station_name", "aqi")
    )


def write_hourly(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep a table of hours by day: the hours that changed replace what was there, in the
    folders of their days only, so there is one folder per day after any number of
    batches. Append mode would hold back the latest hours until the watermark passes
    them, complete mode would write all hours every time."""
    def put(batch: DataFrame, number: int) -> None:
        with Workspace(batch.sparkSession, "hours") as space:
            dated = batch.withColumn("curated_date", F.to_date("timestamp_parsed"))
            new = space.written(dated.select(*schemas.columns(schemas.HOURLY)), "new")
            days = [r[0] for r in new.select("curated_date").distinct().collect()]   # bounded by the calendar
            if days and exists(batch.sparkSession, path):
                known = read_hourly(batch.sparkSession, path).where(F.col("curated_date").isin(days))
                rest = known.join(new, ["timestamp_parsed", "station_name"], "left_anti")
                new = space.written(rest.select(*new.columns).unionByName(new), "merged")
            write_by_day(new, path)

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def repair_hours(clean: DataFrame, path: str, days: list) -> None:
    """Compute some days again from the clean table: readings later than the watermark
    are missing in the stream and found here."""
    chosen = stream_hourly(clean.where(F.col("curated_date").isin(days)))
    dated = chosen.withColumn("curated_date", F.to_date("timestamp_parsed"))
    write_by_day(dated.select(*schemas.columns(schemas.HOURLY)), path)


def merge_hours(spark: SparkSession, clean_path: str, path: str, checkpoint: str, every: str | None = None,
                max_files: int | None = None) -> StreamingQuery:
    """Keep sum and count of each hour current while the clean table gets new files.

    Sums merge, so a reading of any age enters its hour: there is no watermark that could
    lose it and no state that grows. Only the days of a batch are read and written. A row
    tells the last batch it holds, so a batch that runs again after a failure adds nothing
    to the rows it had reached. As for any stream of files, a reading counts once for each
    file that holds it.
    """
    def put(batch: DataFrame, number: int) -> None:
        with Workspace(spark, "hours") as space:
            known = batch.where(F.col("station_name").isNotNull() & F.col("timestamp_parsed").isNotNull())
            new = space.written(known.groupBy(
                F.date_trunc("hour", "timestamp_parsed").alias("timestamp_parsed"), "station_name").agg(
                F.coalesce(F.sum("aqi"), F.lit(0)).alias("total"), F.count("aqi").alias("readings")).withColumns(
                {"batch": F.lit(number).cast("long"), "curated_date": F.to_date("timestamp_parsed")}), "new")
            days = [r[0] for r in new.select("curated_date").distinct().collect()]     # bounded by the calendar
            if not days:
                return
            if exists(spark, path):
                stored = spark.read.schema(schemas.HOURS).parquet(path).where(F.col("curated_date").isin(days))
                key = ["timestamp_parsed", "station_name", "curated_date"]
                both = new.select(*key, *[F.col(c).alias(f"_{c}") for c in MERGED]).join(stored, key, "full_outer")
                fresh = F.col("_batch").isNotNull() & (F.coalesce("batch", F.lit(-1)) < F.col("_batch"))
                merged = {c: F.when(fresh, F.coalesce(c, F.lit(0)) + F.col(f"_{c}")).otherwise(F.col(c))
                          for c in ("total", "readings")}
                merged["batch"] = F.when(fresh, F.col("_batch")).otherwise(F.col("batch"))
                new = space.written(both.withColumns(merged).select(*new.columns), "merged")
            write_by_day(new, path)

    writer = stream_clean(spark, clean_path, max_files).writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_merged_hours(spark: SparkSession, path: str) -> DataFrame:
    """Mean index of each hour; an hour without an index has a null mean."""
    hours = spark.read.schema(schemas.HOURS).parquet(path)
    mean = F.when(F.col("readings") > 0, F.col("total") / F.col("readings"))
    return hours.select("timestamp_parsed", "station_name", mean.alias("aqi"))


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HOURLY).parquet(path)
