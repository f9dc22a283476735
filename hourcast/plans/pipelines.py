"""The reference's three entry chains as Spark plans.

1. ``hourly_load``     text landing -> parse -> merge into the day lake (S1, S9, S3)
2. ``training_data``   lake -> clean -> select -> derive -> split -> save -> scale -> encode -> samples
3. ``day_advice``      newest forecast -> per-day summary, band, tips, styles (S13, A6, F21-F23, J3)

Each is a chain of ``DataFrame -> DataFrame`` operators; fits (tests, scaler, encoders) are the
only actions, and they yield schema-sized tables. The cleaned frame is checkpointed once in the
shared checkpoint folder because several fits read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions import advice as adv
from hourcast.operators import advise, clean, encode, features, split
from hourcast.operators import models as md
from hourcast.operators import significance as st
from hourcast.operators.series import ordinal
from hourcast.schema import FIXED_EXCLUDE_COLUMNS, LEADING_COLUMNS, numeric_columns
from hourcast.session import cut_lineage
from hourcast.sources import files, lake, text


def hourly_load(spark: SparkSession, landing_text: str, root: str, overlap_hours: int = 0) -> DataFrame:
    """Entry 1: parse the landed text and merge it into the day lake; returns the rejects."""
    parsed, rejects = text.read_observation_text(spark, landing_text)
    lake.incremental_load(spark, parsed.drop("hour"), root, overlap_hours=overlap_hours)
    return rejects


def clean_observations(df: DataFrame) -> DataFrame:
    """Entry 2, first steps: '-' -> 'Other' and impossible negatives -> 0."""
    return clean.clamp_negative(clean.replace_missing_token(df))


def training_data(df: DataFrame, keys=("StationID",), time_col: str = "ObservationTime", target: str = "Temperature",
                  seq_len: int = 336, horizon: int = 168, split_root: str | None = None, run_ts: str | None = None,
                  with_samples: bool = True, scale_cyclic: bool = False, high_corr: float | None = None,
                  one_hot_type: str = "double") -> dict[str, DataFrame]:
    """Entry 2: the full preparation chain. Returns the encoded train / val / latest frames and,
    with ``with_samples``, the sliding samples of the train frame. ``scale_cyclic`` scales the sine
    and cosine columns too; ``high_corr`` adds the tree pipeline's correlation rule to the selection
    and ``one_hot_type='int'`` is its encoding."""
    keys = list(keys)
    cleaned = cut_lineage(clean_observations(df))
    # series keys and the time column stay (windows need them); the fixed list drops the rest
    protect = list(LEADING_COLUMNS) + keys + [time_col]
    selected, _dropped = st.feature_selection(cleaned, target, FIXED_EXCLUDE_COLUMNS, protect, high_corr=high_corr)
    derived = cut_lineage(features.add_features(selected, keys, time_col, target))  # three frames and two fits read it
    parts = split.tail_split_frames(derived, keys, time_col, seq_len, horizon)
    if split_root:
        files.write_splits(parts, split_root, run_ts)              # unscaled splits, as the source saves them
    parts = {k: clean.drop_time_parts(v) for k, v in parts.items()}
    cyc = [c for c in parts["train"].columns if c.endswith("_sin") or c.endswith("_cos")]
    to_scale = numeric_columns(parts["train"].schema, exclude=tuple([target] + ([] if scale_cyclic else cyc)))
    scaler = encode.fit_robust_scaler(parts["train"], to_scale)
    scaled = {k: encode.apply_robust_scaler(v, scaler) for k, v in parts.items()}
    cats = [c for c in scaled["train"].columns if dict(scaled["train"].dtypes)[c] == "string" and c not in keys]
    tr, others, _fitted = encode.encode_splits(scaled["train"], {"val": scaled["val"], "latest": scaled["latest"]}, cats, one_hot_type)
    out = {"train": tr, **others}
    if with_samples:
        feats = [c for c in tr.columns if c not in keys + [time_col] and dict(tr.dtypes)[c] != "string"]
        out["samples"] = split.sliding_samples(tr, keys, time_col, feats, target, seq_len, horizon)
    return out


def next_hour_rows(frame: DataFrame, keys=("StationID",), time_col: str = "ObservationTime", target: str = "Temperature") -> tuple[DataFrame, list[str]]:
    """A prepared frame as tree-model rows: its numeric columns as features, the next row's target as label."""
    keys = list(keys)
    types = dict(frame.dtypes)
    feats = [c for c in frame.columns if c not in keys + [time_col] and types[c] != "string" and not types[c].startswith("timestamp")]
    p = ordinal(frame, keys, time_col)
    nxt = p.select(*keys, (F.col("pos") - 1).alias("pos"), F.col(target).cast("double").alias("label"))
    names = {c: f"f{i}" for i, c in enumerate(feats)}  # model columns: category values may hold any character
    rows = p.join(nxt, keys + ["pos"]).select(*keys, time_col, "label", *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(n) for c, n in names.items()])
    return rows, list(names.values())


def train_and_score(df: DataFrame, models: dict, keys=("StationID",), time_col: str = "ObservationTime", target: str = "Temperature",
                    seq_len: int = 336, horizon: int = 168, high_corr: float | None = None) -> tuple[dict, DataFrame, DataFrame]:
    """Entry 2 to the end: prepare, fit on the prepared train frame, score and predict the validation frame.

    Returns the fitted models, the report (Model, RMSE, Training_Time) and every validation row's prediction by
    the best model. Fits and scoring use all rows.
    """
    parts = training_data(df, keys, time_col, target, seq_len, horizon, with_samples=False, high_corr=high_corr, one_hot_type="int")
    train, feats = next_hour_rows(cut_lineage(parts["train"]), keys, time_col, target)
    val, _ = next_hour_rows(cut_lineage(parts["val"].select(*parts["train"].columns)), keys, time_col, target)
    val = cut_lineage(val)  # every model is scored on it
    fitted = md.fit_models(md.fit_rows(train.select(*feats, "label")), feats, models)
    report = md.evaluate_models(fitted, val)
    best = report.first()["Model"]
    return fitted, report, fitted[best][0].transform(val).select(*keys, time_col, "label", "prediction")


def day_advice(spark: SparkSession, forecast_root: str) -> DataFrame:
    """Entry 3: newest forecast -> advice for every (series, day) with styles as rows."""
    fc = files.latest_forecast(spark, forecast_root)
    a = advise.daily_advice(fc)
    return advise.style_items(a, adv.band_dimension(spark)).join(
        a.select("StationID", "date", "avg_temp", "min_temp", "max_temp", "temp_difference", "activity_tip", "layering_tip"),
        ["StationID", "date"])


def sample_count(samples: DataFrame, keys=("StationID",)) -> DataFrame:
    return samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"))
