"""Direct forecast from whole windows by least squares (M8, W4): all horizon steps from one solve.

A sample is the last ``seq_len`` values of a series and the next ``horizon`` ones. Tasks multiply their samples (X'X,
X'Y) and the products are added up by an aggregate with partial sums; only the summed moments, whose size the window
sets, reach the driver, where one linear system gives the weights of every step. Nothing is iterated and nothing is drawn at
random, so the same rows give the same forecast. Every sample is used: there is no bound on the rows of the fit.

``ridge`` is the penalty on the weights as a share of the mean variance of the window's values; it keeps the system
regular when there are fewer samples than weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.series import ordinal
from hourcast.operators.split import HORIZON, SEQ_LEN, sliding_samples

RIDGE = 1.0


@dataclass
class WindowModel:
    weights: np.ndarray  # (seq_len, horizon)
    intercept: np.ndarray  # (horizon,)
    samples: int

    @property
    def seq_len(self) -> int:
        return self.weights.shape[0]

    @property
    def horizon(self) -> int:
        return self.weights.shape[1]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def moments(samples: DataFrame, seq_len: int, horizon: int) -> np.ndarray:
    """Z'Z of Z = (1, x, y), the rows of 1 and x only. Samples with a missing value are left out."""
    def whole(c: str, size: int):  # a collected list has no nulls: it is shorter
        return (F.size(c) == size) & ~F.exists(c, lambda v: v.isNull() | F.isnan(v))

    complete = whole("x", seq_len) & whole("y", horizon)
    rows = samples.select("x", "y").where(complete)

    def multiply(batches):
        total = np.zeros((seq_len + 1, seq_len + 1 + horizon))
        for b in batches:
            if b.num_rows:
                x, y = _matrix(b.column("x"), seq_len), _matrix(b.column("y"), horizon)
                z = np.hstack([np.ones((len(x), 1)), x, y])
                total += z[:, :seq_len + 1].T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(seq_len + 1)), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "v"])

    sums = (rows.mapInArrow(multiply, "i bigint, v array<double>").select("i", array_to_vector("v").alias("v"))
            .groupBy("i").agg(Summarizer.sum(F.col("v")).alias("v")).select("i", vector_to_array("v").alias("v")))
    out = np.zeros((seq_len + 1, seq_len + 1 + horizon))
    for r in sums.collect():  # seq_len + 1 rows
        out[r["i"]] = r["v"]
    return out


def fit(samples: DataFrame, seq_len: int = SEQ_LEN, horizon: int = HORIZON, ridge: float = RIDGE) -> WindowModel:
    """Weights from samples with ``x`` (seq_len values) and ``y`` (horizon values)."""
    z = moments(samples, seq_len, horizon)
    n = z[0, 0]
    if not n:
        raise ValueError("no complete sample to fit")
    mean = z[0, 1:] / n
    xx = z[1:, 1:seq_len + 1] / n - np.outer(mean[:seq_len], mean[:seq_len])
    xy = z[1:, seq_len + 1:] / n - np.outer(mean[:seq_len], mean[seq_len:])
    weights = np.linalg.lstsq(xx + ridge * np.trace(xx) / seq_len * np.eye(seq_len), xy, rcond=None)[0]
    return WindowModel(weights, mean[seq_len:] - mean[:seq_len] @ weights, int(n))


def training_samples(df: DataFrame, keys, time_col: str, target: str, seq_len: int = SEQ_LEN, horizon: int = HORIZON) -> DataFrame:
    """W4 samples of the target alone: x (seq_len values) and y (horizon values)."""
    s = sliding_samples(df, keys, time_col, [target], target, seq_len, horizon, dtype="double")
    return s.withColumn("x", F.flatten("x"))


def last_windows(df: DataFrame, keys, time_col: str, target: str, seq_len: int = SEQ_LEN) -> DataFrame:
    """(keys, origin, x): the last ``seq_len`` values of each series that has as many; origin is its last time."""
    keys = list(keys)
    p = ordinal(df.select(*keys, time_col, target), keys, time_col, length_col="n").where(F.col("pos") > F.col("n") - seq_len)
    # seq_len rows for each series
    w = p.groupBy(*keys).agg(F.max(time_col).alias("origin"), F.array_sort(F.collect_list(F.struct("pos", F.col(target).cast("double").alias("v")))).alias("w"))
    return w.where(F.size("w") == seq_len).select(*keys, "origin", F.transform("w", lambda e: e["v"]).alias("x"))


def predict(model: WindowModel, windows: DataFrame) -> DataFrame:
    """``windows`` without x, and a row for each step: h from 1, target_time and prediction (null if the window has a gap)."""
    known = windows.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # sized by the window

    @F.arrow_udf("array<double>")
    def run(x: pa.Array) -> pa.Array:
        weights, intercept = known.value
        y = _matrix(x, weights.shape[0]) @ weights + intercept
        return pa.array([None if np.isnan(r).any() else r.tolist() for r in y], pa.list_(pa.float64()))

    steps = F.sequence(F.lit(1), F.lit(model.horizon))
    out = windows.withColumn("_y", run("x")).drop("x").select("*", F.explode(steps).alias("h"))
    hours = F.make_dt_interval(F.lit(0), F.col("h"))
    return out.withColumns({"target_time": F.col("origin") + hours, "prediction": F.element_at("_y", F.col("h"))}).drop("_y")


def forecast(df: DataFrame, keys, time_col: str, target: str, seq_len: int = SEQ_LEN, horizon: int = HORIZON, ridge: float = RIDGE) -> DataFrame:
    """M8: fit on every window of the history, predict the ``horizon`` hours after each series' last observation."""
    model = fit(training_samples(df, keys, time_col, target, seq_len, horizon), seq_len, horizon, ridge)
    return predict(model, last_windows(df, keys, time_col, target, seq_len))


def backtest(df: DataFrame, keys, time_col: str, target: str, seq_len: int = SEQ_LEN, horizon: int = HORIZON, ridge: float = RIDGE) -> DataFrame:
    """The forecast of each series' last ``horizon`` rows from the rows before them: a step is a row, with its label."""
    keys = list(keys)
    p = ordinal(df.select(*keys, time_col, target), keys, time_col, length_col="n")
    before = p.where(F.col("pos") <= F.col("n") - horizon).select(*keys, time_col, target)
    held = p.where(F.col("pos") > F.col("n") - horizon).select(*keys, (F.col("pos") - F.col("n") + horizon).cast("int").alias("h"), F.col(time_col).alias("actual_time"),
                                                              F.col(target).cast("double").alias("label"))
    return forecast(before, keys, time_col, target, seq_len, horizon, ridge).drop("target_time").join(held, keys + ["h"])
