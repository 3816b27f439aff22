import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators import reports as rp
from plumelake.sources import readers, schemas, writers

DAY = 86400.0
NAN = float("nan")


def test_kpis(clean_of):
    df = clean_of(("a", 0.0, 5, 10.04), ("a", 1.0, 4, NAN), ("b", 2.0, 3, 99.96), ("b", 3.0, None, 1.0))
    assert rows(rp.kpis(df)) == [(4, 5, 4.0, 100.0, 2, 50.0)]
    assert rp.kpis(df.limit(0)).count() == 0
    assert rows(rp.kpis(df, danger=3).select("n_alertas")) == [(3,)]


def test_hourly_has_only_hours_with_data(clean_of):
    df = clean_of(("a", 0.0, 1, 1.0), ("a", 3599.9, 2, 1.0), ("a", 10 * 3600.0, 4, 1.0), ("b", 5.0, None, 1.0),
                  ("a", None, 5, 1.0))
    got = rows(rp.hourly(df).select("station_name", F.hour("timestamp_parsed"), "aqi"), "station_name", "timestamp_parsed")
    assert got == [("Station a", 0, 1.5), ("Station a", 10, 4.0), ("Station b", 0, None)]


def test_null_group_keys_are_left_out(clean_of):
    df = clean_of(("a", 0.0, 1, 1.0), ("a", 1.0, None, NAN), ("b", 2.0, 2, 2.0))
    gone = df.withColumn("station_name", F.when(F.col("station_id") == "a", F.col("station_name")))
    assert rows(rp.station_summary(gone)) == [("Station a", 6.0, -75.0, 1.0, 1.0, 1)]
    assert rows(rp.station_list(gone)) == [("Station a",)]
    assert rows(rp.category_counts(gone.withColumn("aqi_category", F.lit(None).cast("string")))) == []


def test_categories_rarest_first(clean_of):
    df = clean_of(*[("a", float(i), q, 1.0) for i, q in enumerate([1, 1, 2, 3, 3, 9])])
    assert rows(rp.category_counts(df)) == [
        ("Desconocida", 1), ("Moderada", 1), ("Buena", 2), ("Insalubre sensibles", 2)]


def test_span_and_stations(clean_of):
    df = clean_of(("b", 0.0, 1, 1.0), ("a", 2 * DAY + 60, 1, 1.0), ("a", None, 1, 1.0))
    assert rows(rp.date_span(df)) == [
        (dt.date(2024, 1, 1), dt.date(2024, 1, 3), df.agg(F.max("timestamp_parsed")).first()[0])]
    assert rows(rp.station_list(df)) == [("Station a",), ("Station b",)]


def test_worst_ties_and_nulls(clean_of):
    df = clean_of(*[("a", float(i), 5, 50.0) for i in range(12)], ("b", 0.0, 5, 60.0), ("b", 1.0, None, 999.0))
    got = rp.worst(df)
    assert got.columns == list(rp.DISPLAY_NAMES.values())
    assert [r["PM2.5"] for r in got.collect()] == [60.0] + [50.0] * 9
    seconds = [r["Fecha y hora"].second for r in got.collect()[1:]]
    assert seconds == list(range(9))
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def test_selection_is_closed_and_needs_both_ends(clean_of):
    df = clean_of(("a", 0.0, 1, 1.0), ("a", 2 * DAY - 0.5, 1, 2.0), ("a", 2 * DAY, 1, 3.0), ("b", DAY, 1, 4.0), ("a", None, 1, 5.0))
    pick = lambda *a: [r[0] for r in rows(rp.select_readings(df, *a).select("pm25"), "pm25")]
    assert pick(["Station a"], "2024-01-01", "2024-01-02") == [1.0, 2.0]
    assert pick(["Station a"], "2024-01-01", None) == [1.0, 2.0, 3.0, 5.0]
    assert pick(None, dt.date(2024, 1, 2), dt.date(2024, 1, 2)) == [2.0, 4.0]


def test_selection_reaches_files_and_folders(spark, clean_of, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean(clean_of(*[("a", i * DAY, 1, 1.0) for i in range(6)]), path)
    df = rp.select_readings(readers.read_clean(spark, path), None, "2024-01-02", "2024-01-03")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp_parsed), GreaterThanOrEqual(timestamp_parsed" in plan
    assert "PartitionFilters: [isnotnull(year" in plan and "make_date" in plan.split("PartitionFilters")[1]


def test_last_days(clean_of):
    df = clean_of(("a", 0.0, 1, 1.0), ("a", 3 * DAY, 1, 2.0), ("a", 10 * DAY, 1, 3.0), ("a", 10 * DAY + 1, 1, 4.0))
    got = rp.last_days(df, "2024-01-11 00:00:00")
    assert got.columns == schemas.columns(schemas.EXTRACT)
    assert [r[0] for r in rows(got.select("pm25"), "pm25")] == [2.0, 3.0]


def test_report_panels(clean_of):
    panels = rp.report(clean_of(("a", 0.0, 4, 1.0), ("b", DAY, 1, 2.0)), ["Station a"])
    assert {k: v.count() for k, v in panels.items()} == {
        "kpis": 1, "hourly": 1, "stations": 1, "categories": 1, "worst": 1, "station_list": 2, "date_span": 1}


def test_latest(clean_of):
    df = clean_of(*[("a", float(i), i % 5, 1.0) for i in range(15)], ("b", 14.0, 1, 1.0))
    got = rp.latest(df, ["station_name", "aqi"], 3)
    assert rows(got) == [("Station a", 4), ("Station b", 1), ("Station a", 3)]
