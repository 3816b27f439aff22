import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators.curate import curate
from plumelake.operators.features import features
from plumelake.operators import alerts as al, model as ml, reports as rp
from plumelake.sources import readers, schemas, writers
from plumelake.streaming import features as sf, hourly as sh, intake, scoring

NOW = "2024-01-05 00:00:00"


def deliver(df, folder, name):
    """One delivery of raw files into a folder that a stream watches."""
    df.coalesce(1).write.mode("append").json(f"{folder}/{name}")


def curated(spark, raw, out):
    intake.follow_clean(spark, f"{raw}/*", f"{out}/clean", f"{out}/c1").awaitTermination()


def readings(seed, n=60, days=4):
    draw = random.Random(seed)
    return [{"station_id": draw.choice("ab"), "aqi": draw.choice([None, 1, 2, 3, 4, 5]),
             "pm25": draw.randrange(1, 20000) / 100,
             "timestamp": f"2024-01-{draw.randrange(1, days + 1):02d}T{draw.randrange(24):02d}:{draw.randrange(60):02d}:00"}
            for _ in range(n)]


def test_intake_in_several_deliveries_equals_batch(spark, raw_of, tmp_path):
    given = readings(1)
    faulty = [{"timestamp": "bad"}, {"pm25": None}, {"station_id": None}]
    repeat = [{**given[0], "pm25": 999.0}]
    raw, out = str(tmp_path / "raw"), str(tmp_path)
    deliver(raw_of(*given[:30], *faulty), raw, "one")
    curated(spark, raw, out)
    deliver(raw_of(*given[30:], *repeat), raw, "two")
    curated(spark, raw, out)
    got = readers.read_clean(spark, f"{out}/clean")
    want = curate(raw_of(*given, *faulty))[0].where("timestamp_parsed is not null")
    assert rows(got, *got.columns) == rows(want, *want.columns)

    bad = intake.stream_quarantine(readers.stream_raw(spark, f"{raw}/*"))
    intake.append_parquet(bad, f"{out}/bad", f"{out}/c2").awaitTermination()
    assert sorted(r[0] for r in rows(spark.read.parquet(f"{out}/bad").select("reason"))) == [
        "bad timestamp", "no pm25", "no station"]


def test_late_readings_and_batch_repair(spark, raw_of, tmp_path):
    """A late reading enters its day; a batch run may write over streamed days, and the
    stream goes on after it."""
    at = lambda h, **more: {"timestamp": f"2024-01-01T{h:02d}:00:00", **more}
    raw, out = str(tmp_path / "raw"), str(tmp_path)
    for i, h in enumerate([12, 15, 16, 10]):
        deliver(raw_of(at(h)), raw, f"d{i}")
        curated(spark, raw, out)
    hours = lambda: [r[0] for r in rows(readers.read_clean(spark, f"{out}/clean").select(
        F.hour("timestamp_parsed").alias("h")), "h")]
    assert hours() == [10, 12, 15, 16]
    again, _ = curate(readers.read_raw(spark, f"{raw}/*"))
    writers.write_clean(again.where("hour(timestamp_parsed) > 10"), f"{out}/clean", touched_only=True)
    assert hours() == [12, 15, 16]
    deliver(raw_of(at(9), at(12, pm25=1.0)), raw, "d9")
    curated(spark, raw, out)
    assert hours() == [9, 12, 15, 16]
    assert [r[0] for r in rows(readers.read_clean(spark, f"{out}/clean").where("hour(timestamp_parsed) = 12").select("pm25"))] == [1.0]


def test_chain_equals_batch_and_leaves_nothing_behind(spark, raw_of, tmp_path):
    from pathlib import Path
    from plumelake.streaming.chain import run_stream
    given, fixed = readings(3), {
        "weights": {c: 0.5 for c in ml.INPUTS}, "means": {c: 1.0 for c in ml.INPUTS}, "stds": {c: 2.0 for c in ml.INPUTS}, "bias": 0.1}
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    for n, part in enumerate((given[:25], given[25:], given[10:40])):
        deliver(raw_of(*part), raw, f"d{n}")
        run_stream(spark, f"{raw}/*", out, str(tmp_path / "c"), fixed, "t", NOW).awaitTermination()
    want = ml.score_with(ml.training_frame(features(curate(raw_of(*given))[0])), **fixed, run_ts="t")
    got = readers.read_predictions(spark, f"{out}/predictions").drop("source_file")
    order = ["station_id", "timestamp_parsed"]
    assert rows(got, *order) == rows(want, *order)
    found = spark.read.parquet(f"{out}/alerts")
    assert found.count() == al.alerts(want, NOW).count()
    assert len(list(Path(f"{out}/days").glob("curated_date=*"))) == 4
    assert set(shared.iterdir()) == before


def test_alerts_are_withdrawn_with_their_prediction(spark, raw_of, tmp_path):
    """Late readings lower a prediction: its alert goes, with the folder of its day, and the
    change is listed. A second run of a batch lists the same."""
    from pathlib import Path
    from plumelake.plans.pipeline import Places
    from plumelake.streaming.chain import read_by_batch, run_stream, update
    fixed = {"weights": {c: float(c == "pm25_prom_6h") for c in ml.INPUTS}, "means": {c: 40.0 for c in ml.INPUTS},
             "stds": {c: 1.0 for c in ml.INPUTS}, "bias": 0.0}
    raw, places = str(tmp_path / "raw"), Places(str(tmp_path / "out"))
    def step(name, *given):
        deliver(raw_of(*given), raw, name)
        run_stream(spark, f"{raw}/*", places.out, str(tmp_path / "c"), fixed, "t", NOW).awaitTermination()
        return sorted((r.station_id, r.timestamp_parsed.day) for r in spark.read.parquet(places.alerts).collect()
                      ) if list(Path(places.alerts).glob("curated_date=*")) else []
    high = lambda t, s="a": {"station_id": s, "timestamp": f"2024-01-{t}:00:00", "pm25": 90.0}
    low = lambda t: {"station_id": "a", "timestamp": f"2024-01-{t}:30:00", "pm25": 1.0}     # noqa: E731
    assert step("one", high("04T10"), high("04T11"), high("04T12", "b"), high("04T13", "b")) == [("a", 4), ("b", 4)]
    assert step("two", *[low(f"04T{h:02d}") for h in (6, 7, 8, 9, 10)]) == [("b", 4)]
    assert step("three", *[dict(low(f"04T{h:02d}"), station_id="b") for h in (8, 9, 10, 11, 12)]) == []
    changes = {(r.batch, r.station_id, r.change) for r in read_by_batch(spark, places.alert_changes).collect()}
    assert {c for c in changes if c[2] != "kept"} == {(0, "a", "raised"), (0, "b", "raised"), (1, "a", "withdrawn"),
                                                      (2, "b", "withdrawn")}
    stages = {(r.batch, r.stage): r.n for r in read_by_batch(spark, places.stages).collect()}
    assert [stages[b, "withdrawn"] for b in range(3)] == [0, 1, 1] and stages[1, "read"] == 5
    again = readers.read_raw(spark, f"{raw}/three")
    update(spark, again, 2, places, fixed, "t", NOW)
    assert {(r.batch, r.station_id, r.change) for r in read_by_batch(spark, places.alert_changes).collect()} == changes
    assert not list(Path(places.alerts).glob("curated_date=*"))


def test_an_alert_outlasts_its_window(spark, clean_of):
    """Not its age but its prediction withdraws an alert."""
    feats = features(clean_of(*[("a", h * 3600.0, 3, 90.0) for h in range(30)]), "range")
    fixed = {"weights": {c: 1.0 for c in ml.INPUTS}, "means": {c: 0.0 for c in ml.INPUTS},
             "stds": {c: 1.0 for c in ml.INPUTS}, "bias": 0.0}
    scored = ml.score_with(ml.training_frame(feats), **fixed, run_ts="t")
    first = al.alerts(scored, "2024-01-02 00:00:00")
    later = al.standing_alerts(scored, first, "2024-01-20 00:00:00")
    assert later.count() == first.count() == 29
    assert al.standing_alerts(scored.where("false"), first, "2024-01-02 00:00:00").count() == 0


def test_hourly_stream_equals_batch(spark, clean_of, tmp_path):
    draw = random.Random(2)
    given = [(draw.choice("ab"), float(draw.randrange(4 * 3600)), draw.choice([None, 1, 3, 5]), 1.0) for _ in range(60)]
    src, out = str(tmp_path / "clean"), str(tmp_path / "hourly")
    for part in (given[:20], given[20:40], given[40:]):
        clean_of(*part).write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(src)
        sh.write_hourly(sh.stream_hourly(readers.stream_clean(spark, src), "2 days"), out,
                        str(tmp_path / "c")).awaitTermination()
    got, want = sh.read_hourly(spark, out), rp.hourly(clean_of(*given))
    order = ["timestamp_parsed", "station_name"]
    assert rows(got.select(*order, "aqi"), *order) == rows(want.select(*order, "aqi"), *order)
    from pathlib import Path
    assert len(list(Path(out).glob("curated_date=*"))) == 1       # three batches of one day
    sh.repair_hours(clean_of(*given[:20]), out, [got.first()["curated_date"]])
    assert rows(sh.read_hourly(spark, out).select(*order, "aqi"), *order) == rows(
        rp.hourly(clean_of(*given[:20])).select(*order, "aqi"), *order)


@pytest.mark.parametrize("seed", [3, 4])
def test_features_follow_late_files(spark, clean_of, tmp_path, seed):
    """The earliest readings come last, and stations have gaps of several days."""
    draw = random.Random(seed)
    day = 86400
    given = [(draw.choice("abc"), float(draw.choice([0, 1, 2, 6, 11]) * day + draw.randrange(day)),
              draw.choice([None, 1, 2, 3, 4, 5]), draw.randrange(1, 9000) / 100) for _ in range(90)]
    given.sort(key=lambda r: -r[1])
    middle, early, late = given[30:55], given[55:], given[:30]
    clean, feats = str(tmp_path / "clean"), str(tmp_path / "features")
    for part in (middle, late, early[:15], early[15:]):
        clean_of(*part).write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(clean)
        sf.stream_features(spark, clean, feats, str(tmp_path / "days"), str(tmp_path / "c"), scale=2,
                           ).awaitTermination()
    got = readers.read_features(spark, feats)
    want = features(clean_of(*given), scale=2, drop_null_time=True)
    assert rows(got, *got.columns) == rows(want, *want.columns)


def test_only_touched_days_are_rewritten(spark, clean_of, tmp_path):
    day = 86400.0
    clean, feats = str(tmp_path / "clean"), tmp_path / "features"
    def step(*part):
        clean_of(*part).write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(clean)
        sf.stream_features(spark, clean, str(feats), str(tmp_path / "days"), str(tmp_path / "c")).awaitTermination()
        return {p.parent.name: p.name for p in feats.rglob("*.parquet")}
    first = step(*[("a", i * day, 2, 1.0) for i in range(6)])
    second = step(("a", 2 * day + 60, 5, 9.0))
    changed = {k for k in second if second[k] != first.get(k)}
    assert changed == {"curated_date=2024-01-03", "curated_date=2024-01-04"}


@pytest.fixture(scope="module")
def scored(spark, clean_of):
    draw = random.Random(9)
    given = [(s, i * 3600.0, draw.choice([1, 2, 3, 4, 5]), draw.randrange(1, 20000) / 100)
             for s in "ab" for i in range(96)]
    frame = ml.training_frame(features(clean_of(*given), "range"))
    return given, ml.fit(frame)


def test_scores_of_a_stream_equal_batch(spark, clean_of, scored, tmp_path):
    given, model = scored
    feats = features(clean_of(*given), "range")
    path = str(tmp_path / "features")
    writers.write_features(feats, path)
    stream = scoring.stream_score(readers.stream_features(spark, path), model, "run")
    intake.append_parquet(stream, str(tmp_path / "pred"), str(tmp_path / "c"), ["station_id"]).awaitTermination()
    got = readers.read_predictions(spark, str(tmp_path / "pred")).drop("source_file")
    want = ml.score(model, ml.training_frame(feats), "run")
    order = ["station_id", "timestamp_parsed"]
    assert rows(got, *order) == rows(want, *order)


def test_alerts_repeat_or_come_once(spark, clean_of, scored, tmp_path):
    given, model = scored
    pred = ml.score(model, ml.training_frame(features(clean_of(*given), "range")), "run")
    path = str(tmp_path / "pred")
    want = al.alerts(pred, NOW, threshold=0.5)
    n = want.count()
    assert n > 0
    def run(mode):
        stream = scoring.stream_alerts(readers.stream_predictions(spark, path), NOW, mode, threshold=0.5, watermark="40 days")
        out = str(tmp_path / mode)
        intake.append_parquet(stream, out, str(tmp_path / f"c-{mode}")).awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    for _ in range(2):   # the same predictions are written again
        pred.write.mode("append").partitionBy("station_id").parquet(path)
        repeated, once = run("reference"), run("once")
    assert repeated.count() == 2 * n
    order = ["station_id", "timestamp_parsed"]
    assert rows(once.drop("source_file"), *order) == rows(want, *order)
    with pytest.raises(ValueError):
        scoring.stream_alerts(pred, NOW, mode="x")


def files_of(path):
    from pathlib import Path
    return {p for p in Path(path).rglob("*.parquet")}


def test_days_without_known_keys_are_appended(spark, raw_of, tmp_path):
    """New keys leave the files of a day alone; a known or possibly known key, a filter that
    is missing and one that was written around do not lose or repeat a reading."""
    from pathlib import Path
    from plumelake.sources.writers import key_path, remove
    raw, out = str(tmp_path / "raw"), str(tmp_path)
    at = lambda t, **more: {"timestamp": f"2024-01-{t}", **more}     # noqa: E731
    def step(name, *given):
        deliver(raw_of(*given), raw, name)
        curated(spark, raw, out)
        return files_of(f"{out}/clean")
    first = step("one", at("01T00:10:00"), at("02T00:10:00"))
    second = step("two", at("01T00:11:00"), at("01T00:10:00", station_id="b"))
    assert first < second and len(second) == len(first) + 1
    third = step("three", at("01T00:10:30"), at("02T05:00:00"))     # the minute is known, the key is not
    assert not {f for f in first if "day=1/" in str(f)} & third and {f for f in first if "day=2/" in str(f)} <= third
    step("four", at("01T00:10:00", pm25=1.0))                       # a known key
    keys = lambda: sorted((r.station_id, str(r.timestamp_parsed), r.pm25)     # noqa: E731
                          for r in readers.read_clean(spark, f"{out}/clean").collect())
    want = [("b", "2024-01-01 00:10:00", 10.0), ("s", "2024-01-01 00:10:00", 1.0), ("s", "2024-01-01 00:10:30", 10.0),
            ("s", "2024-01-01 00:11:00", 10.0), ("s", "2024-01-02 00:10:00", 10.0), ("s", "2024-01-02 05:00:00", 10.0)]
    assert keys() == want
    remove(spark, key_path(f"{out}/clean"))
    step("five", at("01T00:11:00"), at("03T00:00:00"))
    assert keys() == [*want, ("s", "2024-01-03 00:00:00", 10.0)]
    # Another writer adds a reading; the stream hears of it again.
    writers.write_clean(curate(raw_of(at("03T00:00:00"), at("03T09:00:00")))[0], f"{out}/clean", touched_only=True)
    assert not (Path(key_path(f"{out}/clean")) / "curated_date=2024-01-03").exists()
    step("six", at("03T09:00:00"))
    assert keys() == [*want, ("s", "2024-01-03 00:00:00", 10.0), ("s", "2024-01-03 09:00:00", 10.0)]


def test_neighbours_are_found_without_reading_all_days(spark, tmp_path, monkeypatch):
    """What a batch reads of the station days depends on the gap, not on the age."""
    from datetime import date, timedelta
    from plumelake.session import Workspace
    start, path = date(2020, 1, 1), str(tmp_path / "days")
    day = lambda n: start + timedelta(days=n)       # noqa: E731
    known = [("a", day(n)) for n in range(0, 400, 1)] + [("b", day(n)) for n in (3, 380, 399)] + [("c", day(399))]
    everything = spark.createDataFrame(known, schemas.STATION_DAY)
    with Workspace(spark, "t") as space:
        sf.note_days(space, everything, path)
        read, original = [], sf._station_days
        monkeypatch.setattr(sf, "_station_days", lambda s, p, days: (read.append(len(days)), original(s, p, days))[1])
        keys = spark.createDataFrame([(s, day(399)) for s in "abc"], schemas.STATION_DAY)
        found = sf.neighbours(space, keys, path, "before", back=True)
        assert {(r.station_id, r.other) for r in found.collect()} == {("a", day(398)), ("b", day(380))}
        assert sum(read) < 60
        keys = spark.createDataFrame([("a", day(5)), ("b", day(3)), ("c", day(399))], schemas.STATION_DAY)
        found = sf.neighbours(space, keys, path, "after", back=False)
        assert {(r.station_id, r.other) for r in found.collect()} == {("a", day(6)), ("b", day(380))}
        assert sf.neighbours(space, keys.where("false"), path, "none", back=True).count() == 0
        ends = {r.station_id: (r.first, r.last) for r in sf._frontier(spark, path).collect()}
        assert ends == {"a": (day(0), day(399)), "b": (day(3), day(399)), "c": (day(399), day(399))}


def test_late_hours_merge_without_a_watermark(spark, clean_of, tmp_path):
    """Readings of any age enter their hour, and a batch that runs again adds nothing."""
    from plumelake.session import Workspace
    draw = random.Random(8)
    given = [(draw.choice("ab"), float(draw.randrange(40 * 86400)), draw.choice([None, 1, 3, 5]), 1.0) for _ in range(80)]
    given.sort(key=lambda r: -r[1])
    src, out, ckpt = (str(tmp_path / n) for n in ("clean", "hours", "c"))
    for part in (given[:30], given[30:60], given[60:]):
        clean_of(*part).write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(src)
        sh.merge_hours(spark, src, out, ckpt).awaitTermination()
    order = ["timestamp_parsed", "station_name"]
    want = rows(rp.hourly(clean_of(*given)).select(*order, "aqi"), *order)
    assert rows(sh.read_merged_hours(spark, out), *order) == want
    # The last batch fails after its tables are written, and runs again.
    from pathlib import Path
    last = sorted(Path(ckpt, "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    sh.merge_hours(spark, src, out, ckpt).awaitTermination()
    assert rows(sh.read_merged_hours(spark, out), *order) == want
