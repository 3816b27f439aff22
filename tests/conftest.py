import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumelake.session import build_session  # noqa: E402
from plumelake.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def raw_of(spark):
    """Raw readings from dicts; missing fields are null."""
    def make(*rows):
        base = {"station_id": "s", "station_name": "Station s", "latitude": 6.0, "longitude": -75.0,
                "aqi": 2, "co": 1.0, "no2": 1.0, "o3": 1.0, "pm25": 10.0, "pm10": 20.0,
                "timestamp": "2024-01-01T00:00:00"}
        names = schemas.columns(schemas.RAW)
        return spark.createDataFrame([tuple({**base, **r}[c] for c in names) for r in rows], schemas.RAW)
    return make


@pytest.fixture(scope="session")
def clean_of(spark):
    """Clean readings as (station, second of 2024 or None, aqi, pm25)."""
    from pyspark.sql import functions as F
    from plumelake.operators.curate import shape_clean

    def make(*rows):
        df = spark.createDataFrame([(*r,) for r in rows],
                                   "station_id string, sec double, aqi int, pm25 double")
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        micros = F.unix_micros(start) + F.round(F.col("sec") * 1_000_000).cast("bigint")
        return shape_clean(df.withColumns({
            "timestamp_parsed": F.timestamp_micros(micros),
            "station_name": F.concat(F.lit("Station "), "station_id"),
            "latitude": F.lit(6.0), "longitude": F.lit(-75.0), "co": F.lit(1.0), "no2": F.lit(1.0),
            "o3": F.lit(1.0), "pm10": F.col("pm25") * 2}))
    return make
