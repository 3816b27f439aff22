"""The batch pipeline over new raw files only.

A ledger keeps path, time and size of every raw file that was taken in. A run lists the raw
folder, reads the files that the ledger does not have, merges their readings into the days
they fall on, and rebuilds the features of the days these readings reach. Model,
predictions and alerts follow from the feature table as in a full run, so after any number
of runs all tables equal those of one full run (``timed_only``) over all files.

The ledger is written last. A run that fails before takes the same files in again under the
same number, which changes nothing: merges are the same in any order and number, and
quarantine is written by run. A file that was written over is a new file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumelake.plans.pipeline import Places, raise_alerts, train_and_score
from plumelake.session import Workspace, use_utc
from plumelake.sources import schemas
from plumelake.sources.readers import folder_values, exists, raw_files, read_raw
from plumelake.streaming.chain import absorb


_WITH_RUN = "path string, modified timestamp, size long, run int"


def _runs(spark: SparkSession, places: Places) -> list[int]:
    """Numbers of the runs that ended well."""
    found = sorted(int(v) for (v,) in folder_values(spark, places.ledger, ["run"]))
    return [n for n in found if exists(spark, f"{places.ledger}/run={n}/_SUCCESS")]


def ledger(spark: SparkSession, places: Places) -> DataFrame:
    """The raw files taken in so far, with the run that did it."""
    columns = [*schemas.columns(schemas.LEDGER), "run"]
    runs = _runs(spark, places)
    if not runs:
        return spark.createDataFrame([], schemas.LEDGER).withColumn("run", F.lit(0)).select(*columns)
    table = spark.read.schema(_WITH_RUN).parquet(places.ledger)
    return table.where(F.col("run").isin(runs)).select(*columns)


def new_files(spark: SparkSession, raw_path: str, places: Places) -> DataFrame:
    """The raw files that are not in the ledger, or have changed since."""
    return raw_files(spark, raw_path).join(
        ledger(spark, places), schemas.columns(schemas.LEDGER), "left_anti")


def take_in(spark: SparkSession, raw_path: str, places: Places, scale: int | None = None) -> dict[str, int]:
    """Bring quarantine, clean table and features up to date with the new raw files."""
    use_utc(spark)
    with Workspace(spark, "increment") as space:
        files = space.written(new_files(spark, raw_path, places), "files")
        paths = [r[0] for r in files.select("path").collect()]      # Spark lists files on the driver
        if not paths:
            return {"files": 0, "read": 0, "quarantined": 0, "new": 0, "days": 0}
        run = max(_runs(spark, places), default=-1) + 1
        days, counts = absorb(space, read_raw(spark, paths), run, places, scale)
        files.coalesce(1).write.mode("overwrite").parquet(f"{places.ledger}/run={run}")
    return {"files": len(paths), **counts, "days": len(days)}


def run_incremental(spark: SparkSession, raw_path: str, out_path: str, now: str, scale: int | None = None,
                    split_method: str = "hash", region: str = "", signature: str = "") -> dict:
    """``run_batch`` over the raw files that came since the last run. Without new files
    model and predictions stay, and only the alerts follow the time."""
    places = Places(out_path)
    result = take_in(spark, raw_path, places, scale)
    if result["days"]:
        result |= train_and_score(spark, places, now, split_method)
    if exists(spark, places.predictions):
        result |= raise_alerts(spark, places, now, region=region, signature=signature)
    return result
