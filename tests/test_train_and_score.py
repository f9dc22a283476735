"""The training chain to its end: the correlation selection and the whole model family."""

import statistics
import time

from hourcast.operators import models as md
from hourcast.operators import significance as st
from hourcast.plans import adapters as ad
from hourcast.plans import pipelines as pl
from hourcast.plans import q_pipelines as qp
from tests.conftest import SF_SMALL


def test_high_corr_drops_the_copy_that_is_farther_from_the_target(spark):
    rows = [(float(i % 37) + (i * 7) % 11 / 10, float(i % 37), float((i * 7) % 11 * 3 + i % 37), "xy"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "Temperature double, near double, far double, kind string")
    df = df.withColumn("near_copy", df["near"] * 2 + 1)
    loose, dropped = st.feature_selection(df, "Temperature", [], ["Temperature"])
    tight, more = st.feature_selection(df, "Temperature", [], ["Temperature"], high_corr=0.95)
    assert {"near", "near_copy"} <= set(loose.columns)
    assert set(more) - set(dropped) == {"near_copy"} and "near" in tight.columns


def test_chain_runs_to_its_end(spark):
    """The real chain on 1,000 observations: selection at full width, all four models, every validation row predicted."""
    t0 = time.time()
    obs = ad.obs_wide(spark, SF_SMALL).drop("event_id")
    fitted, report, scored = pl.train_and_score(obs, md.regressors(n_estimators=5), seq_len=48, horizon=24, high_corr=0.95)
    assert set(fitted) == set(md.regressors()) and report.count() == 4
    rows = scored.collect()
    assert len(rows) == 4 * 71 and all(r.prediction == r.prediction for r in rows)
    spread = statistics.pstdev(r.label for r in rows)
    assert report.first()["RMSE"] < 2 * spread
    assert time.time() - t0 < 180


def test_query_uses_all_models_and_the_selection(spark, monkeypatch):
    asked = {}

    def chain(obs, models, **kw):
        asked.update(kw, models=set(models))
        return None, None, obs.limit(1).select("StationID", "ObservationTime")

    monkeypatch.setattr(pl, "train_and_score", chain)
    monkeypatch.setattr(qp, "state_tag", lambda *a: "test-of-arguments")
    qp.q_pipeline_train_and_score(spark, SF_SMALL)
    assert asked == {"models": set(md.regressors()), "high_corr": 0.95}
