from pyspark.sql import functions as F

from helpers import rows
from plumelake.functions.times import clock_text, tolerant_time
from plumelake.operators.curate import clean_nulls, curate, dedup, quarantine
from plumelake.sources import schemas

NAN = float("nan")


def test_required_fields_null_or_nan(raw_of):
    df = raw_of({}, {"pm25": None}, {"pm25": NAN}, {"station_id": None}, {"timestamp": None}, {"aqi": None})
    assert clean_nulls(df).count() == 2


def test_categories(raw_of):
    df = raw_of(*[{"aqi": a, "timestamp": f"2024-01-01T00:00:0{i}"}
                  for i, a in enumerate([0, 1, 2, 3, 4, 5, 6, None])])
    got = dict(rows(curate(df)[0].select(F.coalesce("aqi", F.lit(-1)), "aqi_category")))
    assert got == {0: "Desconocida", 1: "Buena", 2: "Moderada", 3: "Insalubre sensibles",
                   4: "Insalubre", 5: "Peligrosa", 6: "Desconocida", -1: "Desconocida"}


def test_bad_time_stays_with_null_time_and_is_quarantined(raw_of):
    clean, bad = curate(raw_of({"timestamp": "bad"}, {"pm25": None}, {"station_id": None}))
    assert clean.columns == schemas.columns(schemas.CLEAN)
    assert rows(clean.select("timestamp_parsed", "curated_date", "year", "month", "day")) == [(None,) * 5]
    assert sorted(r[0] for r in rows(bad.select("reason"))) == ["bad timestamp", "no pm25", "no station"]


def test_calendar_text_has_no_leading_zero(raw_of):
    clean, bad = curate(raw_of({"timestamp": "2024-03-07T05:06:07"}))
    assert rows(clean.select("year", "month", "day", F.col("curated_date").cast("string"))) == [
        ("2024", "3", "7", "2024-03-07")]
    assert bad.count() == 0


def test_dedup_keeps_first_by_order_whatever_the_layout(raw_of):
    df = raw_of({"pm25": 3.0}, {"pm25": 1.0}, {"pm25": 2.0}).withColumn(
        "seen", F.when(F.col("pm25") == 2.0, 0).otherwise(1)).repartition(3)
    assert rows(dedup(df, order=["seen"]).select("pm25")) == [(2.0,)]
    assert rows(dedup(df.drop("seen")).select("pm25")) == [(1.0,)]
    once = dedup(df, order=["seen"])
    assert rows(dedup(once, order=["seen"])) == rows(once)


def test_dedup_limits_rows_before_the_shuffle(raw_of):
    plan = dedup(raw_of({}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_uses_the_text_not_the_moment(raw_of):
    df = raw_of({}, {"timestamp": "2024-01-01 00:00:00"})
    assert curate(df)[0].count() == 2


def test_tolerant_time(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01 00:00:00.25",), ("x",), (None,)], "t string")
    got = [r[0] for r in rows(df.select(clock_text(tolerant_time("t"))))]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 00:00:00.250000", None, None]


def test_quarantine_without_corrupt_column(raw_of):
    assert quarantine(raw_of({"timestamp": None})).first()["reason"] == "no timestamp"


def test_empty(spark):
    clean, bad = curate(spark.createDataFrame([], schemas.RAW))
    assert clean.count() == 0 and bad.count() == 0
