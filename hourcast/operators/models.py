"""Forecasting operators on Spark ML.

The reference trains a single-machine sequence network; here the same task -- predict the next
``horizon`` hours of the target from the recent past -- is a *direct multi-horizon regression*:
one training row per (anchor hour, step h) with the anchor's recent values, the step and the
target hour's calendar parts as features. The rows are built with equi-joins on
(series, position) and trained with Spark ML regressors, so training data and fitting are
distributed. A seasonal-naive forecast (same hour of the last observed day) is the baseline.
"""

from __future__ import annotations

import time

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions import timefeat as tf
from hourcast.functions.numeric import round_scaled
from hourcast.operators.series import ordinal
from hourcast.session import cut_lineage

HORIZON = 168
DEFAULT_LAGS = (0, 1, 2, 23)
SEED = 0
FIT_TASKS = 8
FIT_TASK_ROWS = 100_000


def _lag_name(k: int) -> str:
    return f"lag_{k}"


def anchor_features(df: DataFrame, keys, time_col: str, target: str, lags=DEFAULT_LAGS) -> DataFrame:
    """Per row (a possible anchor): position and the target ``k`` rows earlier for each lag."""
    return _with_lags(ordinal(df.select(*keys, time_col, target), list(keys), time_col), list(keys), time_col, target, lags)


def _with_lags(p: DataFrame, keys, time_col: str, target: str, lags, carry=()) -> DataFrame:
    """All lags in one exchange: each value is sent to the positions that look back at it, and they gather theirs."""
    ks = sorted({0, *lags})
    sent = p.select(*keys, time_col, *carry, F.col(target).alias("_v"), "pos", F.explode(F.array(*[F.lit(k) for k in ks])).alias("_k"))
    here = F.col("_k") == 0
    out = sent.groupBy(*keys, (F.col("pos") + F.col("_k")).alias("pos")).agg(
        *[F.max(F.when(here, F.col(c))).alias(c) for c in (time_col, *carry)],
        *[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(_lag_name(k)) for k in ks])
    return out.filter(F.col(time_col).isNotNull())


def horizon_steps(anchors: DataFrame, horizon: int, time_col: str) -> DataFrame:
    """Fan each anchor out to steps 1..horizon (a generator, not a join) with the target time."""
    return _target_calendar(_steps(anchors, horizon, time_col))


def _steps(anchors: DataFrame, horizon: int, time_col: str) -> DataFrame:
    h = anchors.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return h.withColumn("target_time", F.col(time_col) + F.make_dt_interval(F.lit(0), F.col("h")))


def _target_calendar(h: DataFrame) -> DataFrame:
    hour = F.hour("target_time")
    return h.withColumns({
        "target_hour": hour,
        "target_hour_sin": F.sin(hour * F.lit(2 * 3.141592653589793 / 24)),
        "target_hour_cos": F.cos(hour * F.lit(2 * 3.141592653589793 / 24)),
        "target_weekday": tf.weekday_index("target_time"),
    })


def training_rows(df: DataFrame, keys, time_col: str, target: str, horizon: int = HORIZON,
                  lags=DEFAULT_LAGS, anchor_stride: int = 1) -> DataFrame:
    """(anchor, h) rows with the label = target observed exactly at anchor + h hours (gap-safe).

    ``anchor_stride`` > 1 keeps every k-th anchor (by position) to bound the fan-out; every kept
    anchor still gets all ``horizon`` steps.
    """
    keys = list(keys)
    a = anchor_features(df, keys, time_col, target, lags).dropna(subset=[_lag_name(k) for k in lags])
    if anchor_stride > 1:
        a = a.filter((F.col("pos") % anchor_stride) == 0)
    return labelled_steps(a, df, keys, time_col, target, horizon)


def bounded_anchors(anchors: DataFrame, horizon: int = HORIZON, limit: int | None = None) -> DataFrame:
    """All anchors; those (by hash) whose ``horizon`` steps make at most about ``limit`` rows where a caller asks for that. No query does."""
    every = 1 if limit is None else -(-anchors.count() * horizon // limit)
    return anchors if every <= 1 else anchors.filter(F.pmod(F.xxhash64(*anchors.columns), F.lit(every)) == 0)


def labelled_steps(anchors: DataFrame, df: DataFrame, keys, time_col: str, target: str, horizon: int = HORIZON) -> DataFrame:
    """(anchor, h) rows of ``anchors`` with the label = target observed exactly at anchor + h hours.

    Calendar parts are added to the joined rows: they need not pass the exchange, where there are ``horizon`` rows an anchor.
    """
    keys = list(keys)
    label = df.select(*keys, F.col(time_col).alias("target_time"), F.col(target).alias("label"))
    return _target_calendar(_steps(anchors, horizon, time_col).join(label, keys + ["target_time"]))


def bounded_rows(rows: DataFrame, limit: int) -> DataFrame:
    """At most about ``limit`` rows, by hash of the whole row, for a caller that asks for them. No query does: fits use all rows.

    The rows are kept before they are filtered: above a projection, the planner would write the condition anew for each set
    of its renamed columns (2 to their number).
    """
    rows = cut_lineage(rows)
    every = -(-rows.count() // limit)
    return rows if every <= 1 else rows.filter(F.pmod(F.xxhash64(*rows.columns), F.lit(every)) == 0)


def fit_rows(rows: DataFrame) -> DataFrame:
    """All rows of a fit, kept, in ``FIT_TASKS`` partitions or one for each ``FIT_TASK_ROWS`` rows, if that is more.

    Boosting and forests run over a thousand stages on them, each with a task for every partition: small inputs go into few
    partitions, and large ones into so many that a task's share stays bounded.
    """
    rows = cut_lineage(rows)
    want = -(-rows.count() // FIT_TASK_ROWS)
    if rows.rdd.getNumPartitions() < want:
        return cut_lineage(rows.repartition(max(FIT_TASKS, want)))
    return rows.coalesce(max(FIT_TASKS, want))


def before_and_after(rows: DataFrame, cut) -> tuple[DataFrame, DataFrame]:
    """(anchor, h) rows whose target lies up to ``cut`` (train), and those after it (validation): no label is in both."""
    t = F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")
    return rows.filter(F.col("target_time") <= t), rows.filter(F.col("target_time") > t)


def step_ahead(df: DataFrame, keys, time_col: str, target: str, last: int, lags=DEFAULT_LAGS) -> DataFrame:
    """One row for each of the last ``last`` hours of each series, with the features of the row before it.

    Lags come from the full series and no label is needed, so every one of these hours can be predicted.
    """
    keys = list(keys)
    p = ordinal(df.select(*keys, time_col, target), keys, time_col, length_col="n")
    p = p.filter(F.col("pos") > F.col("n") - (last + max(lags) + 1))
    a = _with_lags(p, keys, time_col, target, lags, carry=("n",))
    at = p.filter(F.col("pos") > F.col("n") - last).select(*keys, (F.col("pos") - 1).alias("pos"), F.col(time_col).alias("target_time"))
    rows = a.drop("n").join(at, keys + ["pos"])
    hours = F.expr(f"timestampdiff(HOUR, `{time_col}`, target_time)").cast("int")
    return _target_calendar(rows.withColumn("h", hours))


def feature_columns(lags=DEFAULT_LAGS) -> list[str]:
    return [_lag_name(k) for k in lags] + ["h", "target_hour_sin", "target_hour_cos", "target_weekday"]


def regressors(seed: int = SEED, n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 5) -> dict:
    """M6: the model family (tree ensembles + a linear baseline), fixed seed."""
    return {
        "LinearRegression": LinearRegression(featuresCol="features", labelCol="label"),
        "DecisionTree": DecisionTreeRegressor(featuresCol="features", labelCol="label", maxDepth=max_depth, seed=seed),
        "RandomForest": RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=n_estimators,
                                              maxDepth=max_depth, seed=seed),
        "GBT": GBTRegressor(featuresCol="features", labelCol="label", maxIter=n_estimators,
                            stepSize=learning_rate, maxDepth=max_depth, seed=seed),
    }


def fit_models(train: DataFrame, features, models: dict) -> dict:
    """M6: fit each model in a pipeline with the assembler; returns {name: (model, seconds)}."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    out = {}
    for name, est in models.items():
        t0 = time.time()
        out[name] = (Pipeline(stages=[asm, est]).fit(train), time.time() - t0)
    return out


def boosted_with_stop(train: DataFrame, val: DataFrame, features, max_iter: int = 100, tolerance: float = 0.01,
                      learning_rate: float = 0.1, max_depth: int = 5, seed: int = SEED):
    """M6 with a validation stop: boosting ends when one more tree no longer lowers the error on ``val`` by ``tolerance``
    (relative), and the model keeps the trees up to the best error. Returns the fitted pipeline; its last stage has ``getNumTrees``.
    """
    rows = train.withColumn("_held", F.lit(False)).unionByName(val.withColumn("_held", F.lit(True)))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, stepSize=learning_rate, maxDepth=max_depth,
                       seed=seed, validationIndicatorCol="_held", validationTol=tolerance)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), gbt]).fit(rows)


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """sqrt(mean((y - p)^2)) over all cells, as a one-row frame."""
    d = F.col(label) - F.col(prediction)
    return pred.agg(F.sqrt(F.avg(d * d)).alias("RMSE"), F.count(F.lit(1)).alias("n"))


def evaluate_models(fitted: dict, val: DataFrame) -> DataFrame:
    """M9: one row per model (Model, RMSE, Training_Time seconds), lowest RMSE first."""
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    rows = [(name, float(ev.evaluate(m.transform(val))), float(sec)) for name, (m, sec) in fitted.items()]
    spark = val.sparkSession
    return spark.createDataFrame(rows, "Model string, RMSE double, Training_Time double").orderBy("RMSE")


def top_models(report: DataFrame, n: int = 3) -> DataFrame:
    """O3: the n best models by RMSE (a top-k: the limit is the feature)."""
    return report.orderBy("RMSE").limit(n)


def last_anchor(df: DataFrame, keys, time_col: str, target: str, lags=DEFAULT_LAGS) -> DataFrame:
    """The newest row of each series with its lag features (forecast origin).

    Only the last ``max(lags) + 1`` rows of each series are kept before the lag joins, so the
    work does not grow with the history length.
    """
    keys = list(keys)
    p = ordinal(df.select(*keys, time_col, target), keys, time_col, length_col="n")
    tail = p.filter(F.col("pos") > F.col("n") - (max(lags) + 1))
    return _with_lags(tail, keys, time_col, target, lags, carry=("n",)).filter(F.col("pos") == F.col("n")).drop("n")


def forecast(model, df: DataFrame, keys, time_col: str, target: str, horizon: int = HORIZON,
             lags=DEFAULT_LAGS, digits: int = 1) -> DataFrame:
    """M8: ``horizon`` hourly predictions per series from its last observation, stamped hour by
    hour from that observation (year, month, day, hour, day_of_week, pred_Temperature)."""
    keys = list(keys)
    steps = horizon_steps(last_anchor(df, keys, time_col, target, lags), horizon, time_col)
    pred = model.transform(steps)
    t = F.col("target_time")
    return pred.select(*keys, "h", F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"),
                       F.hour(t).alias("hour"), tf.weekday_name(t).alias("day_of_week"),
                       round_scaled("prediction", digits).cast("float").alias("pred_Temperature"))


def seasonal_naive(df: DataFrame, keys, time_col: str, target: str, origin: DataFrame,
                   horizon: int = HORIZON, period: int = 24) -> DataFrame:
    """Baseline: the value at target time minus ``period * ceil(h / period)`` hours, i.e. the same
    hour of the last observed period before the origin (null when that hour is missing).

    ``origin`` holds one row per series with the forecast origin in ``time_col``.
    """
    keys = list(keys)
    o = origin.select(*keys, time_col).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    o = o.withColumn("target_time", F.col(time_col) + F.make_dt_interval(F.lit(0), F.col("h")))
    back = F.lit(period) * F.ceil(F.col("h") / F.lit(period))
    o = o.withColumn("_src", F.col("target_time") - F.make_dt_interval(F.lit(0), back.cast("int")))
    src = df.select(*keys, F.col(time_col).alias("_src"), F.col(target).alias("prediction"))
    return o.join(src, keys + ["_src"], "left").drop("_src")


def backtest_origin(df: DataFrame, keys, time_col: str, horizon: int = HORIZON) -> DataFrame:
    """Per series, the origin ``horizon`` hours before its last observation (for a backtest)."""
    keys = list(keys)
    return df.groupBy(*keys).agg((F.max(time_col) - F.make_dt_interval(F.lit(0), F.lit(horizon))).alias(time_col))


def with_actuals(pred: DataFrame, df: DataFrame, keys, time_col: str, target: str) -> DataFrame:
    keys = list(keys)
    act = df.select(*keys, F.col(time_col).alias("target_time"), F.col(target).alias("label"))
    return pred.join(act, keys + ["target_time"])
