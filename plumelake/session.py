"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "plumelake", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time, adaptive execution and room for compiled code: the
    feature job alone has more generated classes than the default cache of 100, and
    would compile them again in every stage.

    Partition counts, memory and executors are left to the cluster; pass them
    in ``conf`` for a local run.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Calendar columns (hour, date, day of week) are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run below the shared folder of the cluster.

    The shared folder is ``spark.checkpoint.dir``. Only a local session may go
    without it, because executors on other machines cannot see a local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="plumelake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


class Workspace:
    """Intermediate tables of one run, deleted when it ends, whether well or not.

    ``with Workspace(spark, "run") as space: table = space.written(df, "name")``
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = shared_folder(spark, purpose)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: for intermediate
    results with several readers. Survives the loss of executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
