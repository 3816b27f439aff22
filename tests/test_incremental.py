"""Incremental runs against one full run."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from plumelake.plans import incremental as inc
from plumelake.plans.pipeline import Places, run_batch
from plumelake.sources import readers, schemas

NOW = "2024-01-05 00:00:00"


def deliveries():
    draw = random.Random(4)
    given = [{"station_id": s, "station_name": f"Station {s}", "aqi": draw.choice([None, 1, 2, 3, 4, 5]),
              "pm25": draw.randrange(1, 20000) / 100, "timestamp": f"2024-01-{1 + h // 24:02d}T{h % 24:02d}:00:00"}
             for s in "ab" for h in range(96)]
    draw.shuffle(given)
    faulty = [{"timestamp": "bad"}, {"pm25": None}, {"station_id": None}]
    again = [{**given[5], "pm25": 0.5}, given[70]]
    return [given[:90] + faulty[:1], given[90:120], again + given[120:] + faulty[1:]]


def tables(spark, places):
    clean, feats = readers.read_clean(spark, places.clean), readers.read_features(spark, places.features)
    pred = readers.read_predictions(spark, places.predictions).drop("source_file")
    order = ["station_id", "timestamp_parsed"]
    return [rows(df, *order) for df in (clean, feats, pred)]


def test_deliveries_equal_a_full_run(spark, raw_of, tmp_path):
    raw, places = str(tmp_path / "raw"), Places(str(tmp_path / "one"))
    taken = []
    for n, part in enumerate(deliveries()):
        raw_of(*part).coalesce(1).write.mode("append").json(f"{raw}/d{n}")
        result = inc.run_incremental(spark, raw, places.out, NOW, scale=2)
        taken.append((result["files"], result["read"]))
    assert taken == [(1, 91), (1, 30), (1, 76)]
    full = run_batch(spark, f"{raw}/*", str(tmp_path / "all"), NOW, scale=2, timed_only=True)
    assert tables(spark, places) == tables(spark, Places(str(tmp_path / "all")))
    assert {k: result[k] for k in ("scored", "train", "auc", "alerts")} == {k: full[k] for k in ("scored", "train", "auc", "alerts")}
    bad = spark.read.parquet(places.quarantine)
    want = spark.read.parquet(Places(str(tmp_path / "all")).quarantine)
    assert rows(bad.groupBy("reason").count(), "reason") == rows(want.groupBy("reason").count(), "reason")

    before = inc.ledger(spark, places).count()
    idle = inc.run_incremental(spark, raw, places.out, "2024-03-01 00:00:00", scale=2)
    assert idle["files"] == idle["read"] == idle["alerts"] == 0 and "auc" not in idle
    assert inc.ledger(spark, places).count() == before == 3


def test_a_run_that_fails_is_made_up_for(spark, raw_of, tmp_path, monkeypatch):
    """It fails after the readings are merged: the next run takes the same files in again."""
    raw, places = str(tmp_path / "raw"), Places(str(tmp_path / "out"))
    first, second, third = deliveries()
    raw_of(*first).write.json(f"{raw}/d0")
    inc.take_in(spark, raw, places)
    raw_of(*second).write.json(f"{raw}/d1")
    real = inc.absorb

    def breaks(*args):
        real(*args)
        raise RuntimeError("gone")
    monkeypatch.setattr(inc, "absorb", breaks)
    with pytest.raises(RuntimeError):
        inc.take_in(spark, raw, places)
    monkeypatch.setattr(inc, "absorb", real)
    raw_of(*third).write.json(f"{raw}/d2")
    assert inc.take_in(spark, raw, places)["read"] == len(second) + len(third)
    assert inc.take_in(spark, raw, places)["files"] == 0
    clean = readers.read_clean(spark, places.clean)
    assert clean.count() == clean.select("station_id", "timestamp_parsed").distinct().count() == 192
    assert spark.read.parquet(places.quarantine).count() == 3


def test_a_file_that_is_written_over_is_new(spark, raw_of, tmp_path):
    raw, places = tmp_path / "raw", Places(str(tmp_path / "out"))
    line = '{"station_id":"a","pm25":1.0,"timestamp":"2024-01-01T0%d:00:00"}\n'
    raw.mkdir()
    (raw / "x.json").write_text(line % 1)
    inc.take_in(spark, str(raw), places)
    (raw / "x.json").write_text(line % 1 + line % 2)
    assert inc.new_files(spark, str(raw), places).count() == 1
    assert inc.take_in(spark, str(raw), places)["read"] == 2
    assert readers.read_clean(spark, places.clean).count() == 2
    assert schemas.columns(schemas.LEDGER) == ["path", "modified", "size"]
    assert inc.ledger(spark, places).agg(F.max("run")).first()[0] == 1
