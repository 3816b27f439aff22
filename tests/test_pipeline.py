import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators.alerts import alerts
from plumelake.plans.pipeline import Places, run_batch
from plumelake.session import shared_folder
from plumelake.sources import readers

NOW = "2024-01-05 00:00:00"


@pytest.mark.parametrize("concatenated", [False, True])
def test_batch_from_raw_files_to_messages(spark, raw_of, tmp_path, concatenated):
    draw = random.Random(5)
    given = [{"station_id": s, "station_name": f"Station {s}", "aqi": q,
              "pm25": q * 20 + draw.randrange(1000) / 100,
              "timestamp": f"2024-01-{1 + h // 24:02d}T{h % 24:02d}:00:00"}
             for s in "ab" for h in range(96) for q in [draw.choice([1, 2, 3, 4, 5])]]
    faulty = [{"timestamp": "bad"}, {"pm25": None}]
    raw = str(tmp_path / "raw")
    df = raw_of(*given, *given[:5], *faulty)
    if concatenated:
        (df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1)
         .agg(F.array_join(F.collect_list("value"), "").alias("value")).write.text(raw))
    else:
        df.write.json(raw)
    result = run_batch(spark, raw, str(tmp_path / "out"), NOW)
    n = len(given)
    assert (result["read"], result["clean"], result["featured"]) == (n + 7, n + 1, n + 1)
    # without the first reading of each station; the one without a time has no hour
    assert result["scored"] == result["train"] + result["test"] == n - 2
    assert result["tn"] + result["fp"] + result["fn"] + result["tp"] == result["test"]
    assert 0.5 < result["auc"] <= 1.0

    places = Places(str(tmp_path / "out"))
    assert spark.read.parquet(places.quarantine).count() == 2
    pred = readers.read_predictions(spark, places.predictions)
    assert pred.count() == result["scored"]
    assert result["alerts"] == alerts(pred, NOW).count() > 0
    messages = spark.read.parquet(places.messages)
    assert messages.agg(F.sum("alert_count")).first()[0] == result["alerts"]
    # a second run replaces everything
    assert run_batch(spark, raw, str(tmp_path / "out"), NOW) == result


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(f"{base}/x-")
