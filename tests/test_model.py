import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators import model as ml
from plumelake.operators.features import features
from plumelake.sources import schemas

RUN = "2024-02-01T00:00:00"


@pytest.fixture(scope="module")
def frame(spark, clean_of):
    draw = random.Random(1)
    readings = []
    for s in "abc":
        for i in range(200):
            q = draw.choice([1, 1, 2, 2, 3, 4, 5, None])
            readings.append((s, i * 1800.0, q, round(10.0 * (q or 1) + draw.random() * 30, 2)))
    df = ml.training_frame(features(clean_of(*readings), "range"))
    return spark.createDataFrame(df.collect(), df.schema).repartition(3).persist()


@pytest.fixture(scope="module")
def model(frame):
    return ml.fit(ml.split(frame, method="hash")[0])


def test_training_frame_drops_first_reading_and_missing_index(clean_of):
    df = features(clean_of(("a", 0.0, 1, 1.0), ("b", 0.0, 1, 1.0), ("b", 1.0, 3, 1.0), ("b", 2.0, None, 1.0)))
    got = ml.training_frame(df)
    assert rows(got.select("station_id", *ml.INPUTS, ml.LABEL)) == [("b", 1.0, 2.0, 2.0, 0.0, 2.0, 1.0)]
    assert {dict(got.dtypes)[c] for c in [*ml.INPUTS, ml.LABEL]} == {"double"}


def test_hash_split_does_not_depend_on_layout(frame):
    a_train, a_test = ml.split(frame, method="hash")
    b_train, b_test = ml.split(frame.coalesce(1).orderBy("pm25"), method="hash")
    key = ["station_id", "timestamp_parsed"]
    assert rows(a_train.select(*key), *key) == rows(b_train.select(*key), *key)
    assert a_train.count() + a_test.count() == frame.count()
    assert 0.7 < a_train.count() / frame.count() < 0.9
    train, test = ml.split(frame)
    assert train.count() + test.count() == frame.count()
    with pytest.raises(ValueError):
        ml.split(frame, method="x")


def test_scaler_stats_equal_the_scaler(frame, model):
    train, _ = ml.split(frame, method="hash")
    got = {r["feature"]: (r["mean"], r["std"]) for r in ml.scaler_stats(train).collect()}
    scaler = model.stages[1]
    for i, c in enumerate(ml.INPUTS):
        assert got[c] == pytest.approx((scaler.mean[i], scaler.std[i]), rel=1e-12)


def test_parameters(model):
    lr = model.stages[2]
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam()) == (100, 0.01, 0.0)
    assert model.stages[0].getInputCols() == ml.INPUTS


def test_score_columns_and_state(frame, model):
    got = ml.score(model, frame, RUN)
    assert got.columns == schemas.columns(schemas.PREDICTIONS)
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.PREDICTIONS]
    assert got.count() == frame.count()
    assert got.where("(estado_predicho = 'PELIGROSO') <> (contaminacion_alta_pred = 1.0)").count() == 0
    assert got.where("(probabilidad_alerta > 0.5) <> (contaminacion_alta_pred = 1.0)").count() == 0
    assert rows(got.select("prediction_timestamp").distinct()) == [(RUN,)]


def test_expression_scoring_equals_the_model(frame, model):
    a = ml.score(model, frame, RUN)
    b = ml.score_with(frame, **ml.model_coefficients(model), run_ts=RUN)
    key = ["station_id", "timestamp_parsed"]
    for x, y in zip(rows(a, *key), rows(b, *key), strict=True):
        x, y = list(x), list(y)
        i = a.columns.index("probabilidad_alerta")
        assert x.pop(i) == pytest.approx(y.pop(i), abs=1e-12)
        assert x == y


def test_constant_input_is_scaled_to_zero(frame):
    stuck = frame.withColumn("hora_dia", F.lit(3.0))
    m = ml.fit(stuck)
    a, b = ml.score(m, stuck, RUN), ml.score_with(stuck, **ml.model_coefficients(m), run_ts=RUN)
    key = ["station_id", "timestamp_parsed"]
    for x, y in zip(rows(a.select("probabilidad_alerta", *key), *key),
                    rows(b.select("probabilidad_alerta", *key), *key), strict=True):
        assert x[0] == pytest.approx(y[0], abs=1e-12)


def test_saved_model_scores_the_same(frame, model, tmp_path):
    path = str(tmp_path / "model")
    ml.save_model(model, path)
    ml.save_model(model, path)   # overwrites
    a, b = ml.score(model, frame, RUN), ml.score(ml.load_model(path), frame, RUN)
    assert rows(a, *a.columns) == rows(b, *b.columns)


def test_metrics_equal_the_evaluators(frame, model):
    scored = ml.score(model, frame, RUN)
    got = ml.metrics(scored).first()
    raw = model.transform(frame)
    for name in ("accuracy", "f1"):
        want = MulticlassClassificationEvaluator(labelCol=ml.LABEL, metricName=name).evaluate(raw)
        assert got[name] == pytest.approx(want, abs=1e-12)
    want = BinaryClassificationEvaluator(labelCol=ml.LABEL, numBins=0).evaluate(raw)
    assert ml.auc(scored).first()["auc"] == pytest.approx(want, abs=1e-12)
    assert ml.auc(scored, parts=3).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_published_matrix(spark):
    counts = spark.createDataFrame(
        [(0.0, 0.0, 208), (0.0, 1.0, 40), (1.0, 0.0, 64), (1.0, 1.0, 122)],
        f"{ml.REAL} double, {ml.PREDICTED} double, count long")
    got = ml.metrics_of_counts(counts).first()
    assert (round(got["accuracy"], 4), round(got["f1"], 4), round(got["recall"], 3)) == (0.7604, 0.7576, 0.656)
    full = counts.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    assert rows(ml.confusion(full)) == [tuple(r) for r in counts.collect()]


def test_auc_with_ties_one_class_and_nothing(spark):
    def auc(*pairs):
        df = spark.createDataFrame([(float(r), p) for r, p in pairs], f"{ml.REAL} double, {ml.PROBABILITY} double")
        return ml.auc(df).first()["auc"]
    assert auc((1, 0.9), (0, 0.1)) == 1.0
    assert auc((1, 0.5), (0, 0.5), (1, 0.5)) == 0.5
    assert auc((1, 0.2), (0, 0.5), (1, 0.8), (0, 0.1)) == 0.75
    assert auc((1, 0.2)) is None
    empty = spark.createDataFrame([], f"{ml.REAL} double, {ml.PREDICTED} double, {ml.PROBABILITY} double")
    assert ml.auc(empty).first()["auc"] is None
    assert ml.metrics(empty).first()["accuracy"] is None


def test_class_balance(frame):
    got = dict(rows(ml.class_balance(frame)))
    assert sum(got.values()) == frame.count() and set(got) == {0.0, 1.0}
