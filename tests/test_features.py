import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators.features import FEATURE_SPECS, calendar, features, label
from plumelake.operators.rolling import RollingSpec, rolling, trend
from plumelake.sources import schemas

METHODS = ["range", "bucket"]
DAY, HOUR = 86400, 3600


def brute(readings, seconds, pick, fn):
    """Frame value per reading by looking at every other reading."""
    out = []
    for s, t, *v in readings:
        sec = None if t is None else math.floor(t)
        frame = [pick(r) for r in readings if r[0] == s and (
            (sec is None and r[1] is None) or
            (sec is not None and r[1] is not None and sec - seconds <= math.floor(r[1]) <= sec))]
        frame = [x for x in frame if x is not None]
        out.append(fn(frame) if frame else None)
    return out


def random_readings(seed, n=150, stations=("a", "b"), span=5 * DAY):
    draw = random.Random(seed)
    got = []
    for _ in range(n):
        t = None if draw.random() < 0.03 else float(draw.randrange(span))
        got.append((draw.choice(stations), t, draw.choice([None, 0, 1, 2, 3, 4, 5, 6]),
                    draw.randrange(1, 50000) / 100))
    return got


@pytest.mark.parametrize("method", METHODS)
def test_frame_edges_and_peers(clean_of, method):
    at = [0.0, 0.0, 3600.0, 3601.0, 21600.0, 86400.0, 86401.0]
    df = clean_of(*[("s", t, i, float(i)) for i, t in enumerate(at)])
    got = rolling(df, [("h", "count", "pm25", HOUR), ("six", "count", "pm25", 6 * HOUR),
                       ("day", "count", "pm25", DAY)], method=method)
    assert [r[0] for r in rows(got.select("h"), "pm25")] == [2, 2, 3, 2, 1, 1, 2]
    assert [r[0] for r in rows(got.select("six"), "pm25")] == [2, 2, 3, 4, 5, 1, 2]
    assert [r[0] for r in rows(got.select("day"), "pm25")] == [2, 2, 3, 4, 5, 6, 5]


@pytest.mark.parametrize("seed", range(3))
def test_bucket_equals_brute_force(clean_of, seed):
    readings = random_readings(seed)
    specs = [("mean_day", "avg", "pm25", DAY), ("mean_six", "avg", "pm25", 6 * HOUR),
             ("max_day", "max", "aqi", DAY), ("min_h", "min", "aqi", HOUR),
             ("sum_odd", "sum", "aqi", 5000), ("n_odd", "count", "aqi", 5000)]
    got = rolling(clean_of(*readings), specs, scale=2)
    have = sorted(((r["station_id"], r["pm25"], r["aqi"]), [r[s[0]] for s in specs])
                  for r in got.withColumn("aqi", F.coalesce("aqi", F.lit(-1))).collect())
    # whole cents, as the operator adds them
    cents = lambda v: sum(round(x * 100) for x in v) / (len(v) * 100.0)
    want_columns = [
        brute(readings, DAY, lambda r: r[3], cents), brute(readings, 6 * HOUR, lambda r: r[3], cents),
        brute(readings, DAY, lambda r: r[2], max), brute(readings, HOUR, lambda r: r[2], min),
        brute(readings, 5000, lambda r: r[2], sum), brute(readings, 5000, lambda r: r[2], len)]
    want_columns[5] = [x or 0 for x in want_columns[5]]
    want = sorted(((r[0], r[3], -1 if r[2] is None else r[2]), list(w))
                  for r, w in zip(readings, zip(*want_columns)))
    assert have == want


@pytest.mark.parametrize("seed", range(2))
def test_both_forms_give_the_same_features(clean_of, seed):
    df = clean_of(*random_readings(seed + 10, n=250))
    a, b = features(df, "range", scale=2), features(df, "bucket", scale=2)
    assert rows(a, *a.columns) == rows(b, *b.columns)


def test_plain_double_means_agree_closely(clean_of):
    df = clean_of(*random_readings(5))
    a = rows(features(df, "range"), "station_id", "pm25", "aqi")
    b = rows(features(df, "bucket"), "station_id", "pm25", "aqi")
    for x, y in zip(a, b, strict=True):
        for u, v in zip(x, y):
            assert u == v or math.isclose(u, v, rel_tol=1e-12)


def test_one_hot_second_and_hot_day(clean_of):
    """A third of all readings in one second, another third on one day."""
    draw = random.Random(3)
    hot = [("a", 7200.0 + i / 1000, draw.randrange(1, 6), draw.randrange(100) / 4) for i in range(300)]
    day = [("a", float(draw.randrange(DAY)), draw.randrange(1, 6), draw.randrange(100) / 4) for _ in range(300)]
    rest = random_readings(4, n=300, stations=tuple("abcdef"))
    df = clean_of(*hot, *day, *rest)
    a, b = features(df, "range", scale=2), features(df, "bucket", scale=2)
    assert rows(a, *a.columns) == rows(b, *b.columns)


@pytest.mark.parametrize("method", METHODS)
def test_trend_first_reading_nulls_and_long_gaps(clean_of, method):
    df = clean_of(("a", 0.0, 2, 1.0), ("b", 5.0, 1, 2.0), ("b", 6.0, None, 3.0), ("b", 7.0, 4, 4.0),
                  ("c", 0.0, 1, 5.0), ("c", 3.0 * DAY, 5, 6.0), ("c", 9.5 * DAY, 2, 7.0))
    got = rows(trend(df, method=method).select("tendencia_aqi"), "pm25")
    assert [r[0] for r in got] == [None, None, None, None, None, 4, -3]


@pytest.mark.parametrize("method", METHODS)
def test_trend_keeps_fractions_of_a_second(clean_of, method):
    df = clean_of(("a", 1.75, 5, 3.0), ("a", 1.25, 1, 1.0), ("a", 1.5, 3, 2.0), ("a", 2.0, 2, 4.0))
    assert [r[0] for r in rows(trend(df, method=method).select("tendencia_aqi"), "pm25")] == [None, 2, 2, -3]


def test_null_times_come_first_and_are_peers(clean_of):
    df = clean_of(("a", None, 1, 1.0), ("a", None, 3, 2.0), ("a", 10.0, 5, 3.0))
    for method in METHODS:
        got = rows(features(df, method).select("aqi_prom_24h", "aqi_max_24h", "hora_dia"), "pm25")
        assert got == [(2.0, 3, None), (2.0, 3, None), (5.0, 5, 0)]
    assert features(df, drop_null_time=True).count() == 1


def test_calendar_and_label(clean_of):
    # 2024-01-01 is a Monday
    df = clean_of(("a", 0.0, 2, 1.0), ("a", 5.0 * DAY + 13 * HOUR, 3, 2.0), ("a", 6.0 * DAY, None, 3.0))
    got = rows(label(calendar(df)).select("hora_dia", "dia_semana", "es_fin_semana", "contaminacion_alta"), "pm25")
    assert got == [(0, 2, 0, 0), (13, 7, 1, 1), (0, 1, 1, None)]


def test_label_from_a_later_reading(clean_of):
    at = [(0.0, 1), (3600.0, 5), (3601.0, 2), (4 * DAY + 0.0, 4), (None, 5)]
    df = clean_of(*[("a", t, q, float(i)) for i, (t, q) in enumerate(at)])
    got = [r[0] for r in rows(label(df, horizon=HOUR).select("contaminacion_alta"), "pm25")]
    assert got == [1, 1, 1, None, None]


def test_feature_columns_and_types(clean_of):
    got = features(clean_of(("a", 0.0, 1, 1.0), ("a", 1.0, None, 1.0)))
    assert got.columns == schemas.columns(schemas.FEATURES)
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.FEATURES]
    assert got.count() == 2
    assert features(clean_of(("a", 0.0, None, 1.0))).count() == 0   # no mean of the index


def test_empty_input(spark):
    empty = spark.createDataFrame([], schemas.CLEAN)
    for method in METHODS:
        assert features(empty, method).count() == 0


def test_bits_do_not_depend_on_the_amount_of_data(clean_of):
    """Means of one station are the same next to a dense day of another station."""
    own = [("a", float(n * 977 % 90_000), 1 + n % 5, n / 7) for n in range(60)]
    dense = [("dense", float(n * 13 % 86_400), 1 + n % 5, n / 3) for n in range(3000)]
    sparse = [(f"s{n}", 40.0 * n, 2, n / 9) for n in range(200)]

    def of_a(df):
        return rows(features(df).where("station_id = 'a'").select(
            "timestamp_parsed", "pm25", "pm25_prom_24h", "pm25_prom_6h", "aqi_prom_24h"), "timestamp_parsed", "pm25")
    assert of_a(clean_of(*own)) == of_a(clean_of(*own, *dense, *sparse))


def test_bucket_plan_shuffles_aggregated_cells(clean_of):
    plan = rolling(clean_of(("a", 0.0, 1, 1.0)), FEATURE_SPECS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Readings, cells, visits and results; cells again (reused when it runs), and three times
    # the blocks, one row per station and hour.
    assert plan.count("Exchange hashpartitioning") == 8


def test_unknown_arguments(clean_of):
    df = clean_of(("a", 0.0, 1, 1.0))
    with pytest.raises(ValueError):
        rolling(df, [RollingSpec("x", "median", "pm25", 10)])
    with pytest.raises(ValueError):
        rolling(df, [RollingSpec("x", "avg", "pm25", 10)], method="other")
