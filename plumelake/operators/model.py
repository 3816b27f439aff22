"""Training, scoring and evaluation of the high-pollution classifier."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumelake.functions.air import predicted_state
from plumelake.functions.numbers import hash_percent, ratio
from plumelake.functions.times import epoch_second
from plumelake.operators.rolling import STATION, TIME
from plumelake.session import Workspace
from plumelake.sources import schemas

# The model inputs in vector order, and the label.
INPUTS = ["pm25_prom_6h", "aqi_prom_24h", "tendencia_aqi", "hora_dia", "dia_semana"]
LABEL = "contaminacion_alta"


def training_frame(feats: DataFrame) -> DataFrame:
    """Inputs and label as doubles, rows with any of them missing removed."""
    as_double = {c: F.col(c).cast("double") for c in [*INPUTS, LABEL]}
    return feats.withColumns(as_double).dropna(subset=[*INPUTS, LABEL])


def split(df: DataFrame, ratio: float = 0.8, method: str = "random",
          seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows.

    ``random`` draws per row and depends on the layout of the rows. ``hash``
    puts a reading on the same side in every run and on every cluster: it looks
    only at station and second, to a hundredth of the ratio.
    """
    if method == "random":
        train, test = df.randomSplit([ratio, 1 - ratio], seed=seed)
        return train, test
    if method != "hash":
        raise ValueError(f"unknown method {method!r}")
    in_train = split_bucket() < round(100 * ratio)
    return df.where(in_train), df.where(~in_train)


def split_bucket() -> Column:
    return hash_percent(STATION, epoch_second(TIME))


def scaler_stats(train: DataFrame) -> DataFrame:
    """Mean and sample deviation of each input: what the scaler subtracts and
    divides by. One row per input, from one pass."""
    stats = train.agg(*[
        F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"),
                 F.stddev_samp(c).alias("std")).alias(c)
        for c in INPUTS])
    return stats.select(F.inline(F.array(*INPUTS)))


def build_pipeline(reg: float = 0.01, max_iter: int = 100, tol: float = 1e-6) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=INPUTS, outputCol="features_vec"),
        StandardScaler(inputCol="features_vec", outputCol="features_scaled",
                       withMean=True, withStd=True),
        LogisticRegression(featuresCol="features_scaled", labelCol=LABEL, maxIter=max_iter,
                           regParam=reg, elasticNetParam=0.0, tol=tol),
    ])


def fit(train: DataFrame, reg: float = 0.01, max_iter: int = 100, tol: float = 1e-6) -> PipelineModel:
    """Standardise and fit. Only label and inputs travel through the iterations.

    The model is stored and read back. That drops its training summary, which holds
    the session, and Spark cannot ship that to tasks once a session has counted rows
    with ``observe``.
    """
    with Workspace(train.sparkSession, "model") as space:
        save_model(build_pipeline(reg, max_iter, tol).fit(train.select(*INPUTS, LABEL)), space.path)
        return load_model(space.path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_coefficients(model: PipelineModel) -> dict:
    """The few numbers of a fitted model, as arguments for ``score_with``."""
    scaler, regression = model.stages[1], model.stages[2]
    return {
        "weights": dict(zip(INPUTS, regression.coefficients.toArray().tolist())),
        "means": dict(zip(INPUTS, scaler.mean.toArray().tolist())),
        "stds": dict(zip(INPUTS, scaler.std.toArray().tolist())),
        "bias": float(regression.intercept),
    }


def _prediction_columns(scored: DataFrame, run_ts: str) -> DataFrame:
    named = scored.withColumns({
        "contaminacion_alta_real": F.col(LABEL),
        "contaminacion_alta_pred": F.col("prediction"),
        "estado_predicho": predicted_state("prediction"),
        "prediction_timestamp": F.lit(run_ts),
    })
    return named.select(*schemas.columns(schemas.PREDICTIONS))


def score(model: PipelineModel, df: DataFrame, run_ts: str) -> DataFrame:
    """Predictions of a fitted model for a training frame, batch or stream."""
    scored = model.transform(df)
    return _prediction_columns(
        scored.withColumn("probabilidad_alerta", vector_to_array("probability")[1]), run_ts)


def margin(weights: Mapping[str, float], means: Mapping[str, float],
           stds: Mapping[str, float], bias: float) -> Column:
    """The linear part of the model, terms added in input order."""
    total = F.lit(0.0)
    for c in INPUTS:
        # The scaler maps an input without spread to zero.
        if stds[c] != 0.0:
            standard = (F.col(c) - F.lit(float(means[c]))) / F.lit(float(stds[c]))
            total = total + F.lit(float(weights[c])) * standard
    return total + F.lit(float(bias))


def score_with(df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float],
               stds: Mapping[str, float], bias: float, run_ts: str = "") -> DataFrame:
    """The same predictions as ``score`` as plain column arithmetic, which runs
    inside generated code and needs no model object."""
    z = margin(weights, means, stds, bias)
    scored = df.withColumn("_margin", z).withColumns({
        "prediction": (F.col("_margin") > 0).cast("double"),
        "probabilidad_alerta": F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin"))),
    })
    return _prediction_columns(scored, run_ts)


# --- evaluation -------------------------------------------------------------

REAL, PREDICTED, PROBABILITY = (
    "contaminacion_alta_real", "contaminacion_alta_pred", "probabilidad_alerta")


def class_balance(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("count"))


def confusion(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy(REAL, PREDICTED).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(REAL, PREDICTED)
    )


def metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, F1 weighted by class support, and recall of the high class, from
    the four counts of the confusion matrix. One row."""
    return metrics_of_counts(scored.groupBy(REAL, PREDICTED).agg(F.count(F.lit(1)).alias("count")))


def metrics_of_counts(counts: DataFrame) -> DataFrame:
    def total(real: float, predicted: float) -> Column:
        hit = (F.col(REAL) == real) & (F.col(PREDICTED) == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).cast("bigint")

    four = counts.agg(total(0.0, 0.0).alias("tn"), total(0.0, 1.0).alias("fp"),
                      total(1.0, 0.0).alias("fn"), total(1.0, 1.0).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rows = tn + fp + fn + tp

    def f1(hits: Column, wrong: Column) -> Column:
        return F.coalesce(ratio(2 * hits, 2 * hits + wrong), F.lit(0.0))

    weighted = f1(tn, fp + fn) * (tn + fp) + f1(tp, fp + fn) * (fn + tp)
    return four.select(
        "tn", "fp", "fn", "tp",
        ratio(tn + tp, rows).alias("accuracy"),
        ratio(weighted, rows).alias("f1"),
        ratio(tp, fn + tp).alias("recall"),
    )


def auc(scored: DataFrame, by: str = PROBABILITY, real: str = REAL,
        parts: int | None = None) -> DataFrame:
    """Area under the ROC curve, exact: the share of (positive, negative) pairs in
    the right order, ties counting half. One row.

    Counts per distinct score come first. Scores are then cut into ``parts``
    ranges of about equal size (by default one per shuffle task, which a cluster sets
    with its data), so that the running count of negatives is taken per range and
    needs no global sort; the totals of the ranges are one small row each. The cut
    points only decide the balance, the result is exact for any of them. The distinct
    scores are stored once in the shared folder, since they are read three times, and
    deleted with the one row of the result known.
    """
    spark = scored.sparkSession
    with Workspace(spark, "auc") as space:
        row = _auc(space, scored, by, real, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
        return spark.createDataFrame([tuple(row.first())], "auc double")


def _auc(space: Workspace, scored: DataFrame, by: str, real: str, parts: int) -> DataFrame:
    pos = F.count_if(F.col(real) == 1.0).cast("decimal(38,0)")
    neg = F.count_if(F.col(real) == 0.0).cast("decimal(38,0)")
    scores = scored.groupBy(F.col(by).alias("_s")).agg(pos.alias("_pos"), neg.alias("_neg"))
    scores = space.written(scores, "scores")
    cuts = sorted(set(scores.approxQuantile(
        "_s", [i / parts for i in range(1, parts)], min(0.001, 0.25 / parts))))
    if cuts:
        ranged = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_s",
                            outputCol="_range", handleInvalid="keep").transform(scores)
    else:
        ranged = scores.withColumn("_range", F.lit(0.0))

    totals = ranged.groupBy("_range").agg(F.sum("_neg").cast("decimal(38,0)").alias("_n"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0))
                           .cast("decimal(38,0)").alias("_base"))
    inside = Window.partitionBy("_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0)).cast("decimal(38,0)")
    placed = (
        ranged.withColumn("_below", below)
        .join(F.broadcast(totals), "_range")
        .withColumn("_twice", 2 * (F.col("_below") + F.col("_base")) + F.col("_neg"))
    )
    right = F.sum((F.col("_pos") * F.col("_twice")).cast("decimal(38,0)"))
    ways = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return placed.agg(F.try_divide(right.cast("double"), 2.0 * ways).alias("auc"))
