"""Sinks and table registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumelake.sources import schemas
from plumelake.sources.readers import exists


def _write_partitioned(df: DataFrame, path: str, keys: list[str], touched_only: bool) -> None:
    """Parquet by ``keys``, overwriting everything or only the partitions in ``df``.

    The rebalance hint gathers each partition into files of the advisory size and
    lets adaptive execution cut a hot one into several tasks, where a plain
    ``repartition(keys)`` would leave it to a single task.
    """
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_clean(df: DataFrame, path: str, touched_only: bool = False) -> None:
    """The clean table, or only its days in ``df``. The key filter of what is written over
    is dropped before, so a stream asks the readings themselves until it has a new one."""
    spark, keys = df.sparkSession, key_path(path)
    if exists(spark, keys):
        if touched_only:
            for (day,) in df.where(F.col("curated_date").isNotNull()).select("curated_date").distinct().collect():
                remove(spark, f"{keys}/curated_date={day}")       # bounded by the calendar
        else:
            remove(spark, keys)
    put_clean(df, path, touched_only)


def put_clean(df: DataFrame, path: str, touched_only: bool = False) -> None:
    """``write_clean`` for a caller that keeps the key filter current."""
    _write_partitioned(df, path, schemas.CLEAN_PARTITIONS, touched_only)


def key_path(clean_path: str) -> str:
    return f"{clean_path.rstrip('/')}-keys"


def append_clean(df: DataFrame, path: str) -> None:
    """New files in the folders of the days of ``df``; what is there stays."""
    df.hint("rebalance", *[F.col(k) for k in schemas.CLEAN_PARTITIONS]).write.mode("append").partitionBy(
        *schemas.CLEAN_PARTITIONS).parquet(path)


def write_features(df: DataFrame, path: str, touched_only: bool = False) -> None:
    _write_partitioned(df, path, schemas.FEATURE_PARTITIONS, touched_only)


def write_predictions(df: DataFrame, path: str, touched_only: bool = False) -> None:
    _write_partitioned(df, path, schemas.PREDICTION_PARTITIONS, touched_only)


def write_by_day(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Tables of a stream: the days in ``df`` replace what was there of them."""
    _write_partitioned(df, path, ["curated_date", *(keys or [])], touched_only=True)


def replace_days(df: DataFrame, path: str, days: list, keys: list[str] | None = None) -> None:
    """Write ``df``, all rows that some days have now, over what was there of them.

    Dynamic overwrite leaves a partition alone that has no rows any more; its folder is
    deleted here. A second run after a failure gives the same. ``df`` should be stored: it
    is read twice. Only the folders to delete come to the driver.
    """
    spark, by = df.sparkSession, ["curated_date", *(keys or [])]
    write_by_day(df, path, keys)
    if not exists(spark, path):
        return
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder")
    stored = spark.read.schema(df.schema).parquet(path).where(F.col("curated_date").isin(days)).select(*by, folder)
    for row in stored.distinct().join(df.select(*by).distinct(), by, "left_anti").select("_folder").distinct().collect():
        remove(spark, spark.sparkContext._jvm.java.net.URI(row[0]))


def remove(spark: SparkSession, path) -> None:
    """Delete a folder, by its path or URI, with all it holds."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """The report extract as CSV, timestamps as ``yyyy-MM-dd HH:mm:ss[.SSS]``."""
    extract = df.select(*schemas.columns(schemas.EXTRACT))
    write_csv(extract.withColumn("timestamp_parsed", F.col("timestamp_parsed").cast("string")), path)


def write_raw_json(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Raw readings as JSON lines; null fields are left out, as in the intake."""
    writer = df.write.mode("overwrite")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.json(path)


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                   keys: list[str]) -> DataFrame:
    """A catalog table over existing Parquet files, with its partitions found again."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema_ddl(schema)}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def register_days(spark: SparkSession, name: str, days: list) -> None:
    """Bring the partitions of a registered table by year, month and day up to date for
    some days only: folders that are there are added, days without a folder are dropped.
    The catalog is asked about these days, the other folders are not listed."""
    path = table_location(spark, name)
    for day in days:
        values = (str(day.year), str(day.month), str(day.day))
        spec = ", ".join(f"{k}='{v}'" for k, v in zip(schemas.CLEAN_PARTITIONS, values))
        folder = "/".join(f"{k}={v}" for k, v in zip(schemas.CLEAN_PARTITIONS, values))
        if exists(spark, f"{path}/{folder}"):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.sql(f"REFRESH TABLE {name}")


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0]


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows, in no particular order."""
    return df.limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """The columns of a table with type and whether they may be null, in order."""
    rows = [(n, f.name, f.dataType.simpleString(), f.nullable) for n, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")
