import datetime as dt

import pytest

from claimscope.operators import governance as gv

STATE_SCHEMA = ("model_name string, approved_run_id string, last_training_data_month date, "
                "approved_feature_signature string, approved_model_signature string, approved_model_type string")
METRIC_SCHEMA = "run_id string, metric_name string, metric_value double"
CHAMPION = {"pr_auc": 0.70, "precision": 0.60, "recall": 0.65, "f1_score": 0.62}
CHALLENGER = {"pr_auc": 0.72, "precision": 0.61, "recall": 0.66, "f1_score": 0.63}
TEST_GATE = {"min_pr_auc_improvement": 0.01, "min_recall_change": 0.0, "min_f1_change": 0.0,
             "min_precision_change": 0.0}


def gate(spark, challenger, approved="champion-run", champion=CHAMPION):
    rows = [("challenger-run", k, v) for k, v in challenger.items()]
    rows += [("champion-run", k, v) for k, v in champion.items()]
    metrics = spark.createDataFrame(rows, METRIC_SCHEMA)
    state = spark.createDataFrame([("key", approved, None, None, None, None)], STATE_SCHEMA)
    ch = spark.createDataFrame([("key", "challenger-run")], "state_key string, challenger_run_id string")
    return gv.promotion_gate(ch, state, metrics, TEST_GATE).first()


def test_challenger_passes(spark):
    r = gate(spark, CHALLENGER)
    assert r.eligible and "satisfied all" in r.reason.lower()


def test_one_regression_fails(spark):
    r = gate(spark, {**CHALLENGER, "precision": 0.59})
    assert not r.eligible and "precision" in r.reason and r.gate_status == "FAIL"


def test_exact_threshold_is_eligible(spark):
    # 0.71 - 0.70 is 0.010000000000000009 in doubles
    assert gate(spark, {"pr_auc": 0.71, "precision": 0.60, "recall": 0.65, "f1_score": 0.62}).eligible


def test_no_champion_bootstraps(spark):
    r = gate(spark, CHALLENGER, approved=None)
    assert r.eligible and "bootstrap" in r.reason.lower()


def test_missing_challenger_metric_is_an_error_row(spark):
    r = gate(spark, {"pr_auc": 0.72, "precision": 0.61, "recall": 0.66})
    assert not r.eligible and r.gate_status == "ERROR" and "Challenger metrics are missing: f1_score" in r.reason


# --- retraining decision matrix ---------------------------------------------------
def decision(spark, current_month=dt.date(2026, 10, 1), fsig="feature-v1", msig="model-v1",
             last_month=dt.date(2026, 10, 1), dq="PASS", alerts=0, pdrift="PASS", perf="PASS", missing=()):
    state = spark.createDataFrame([("key", "run-1", last_month, "feature-v1", "model-v1", "xgboost")], STATE_SCHEMA)
    if last_month is None:
        state = state.where("false")
    cand = spark.createDataFrame([("key", current_month, fsig, msig, "xgboost")],
                                 "state_key string, current_data_month date, current_feature_signature string, "
                                 "current_model_signature string, current_model_type string")
    ts = dt.datetime(2026, 10, 2)
    dqf = spark.createDataFrame([(ts, dq)], "monitoring_timestamp timestamp, monitoring_status string")
    fdf = spark.createDataFrame([(ts, "ALERT" if alerts else "PASS")], "monitoring_timestamp timestamp, monitoring_status string")
    pdf = spark.createDataFrame([(ts, pdrift)], "check_date timestamp, status string")
    pff = spark.createDataFrame([(ts, perf, "xgboost", "xgboost:1", "run-1")],
                                "evaluation_timestamp timestamp, monitoring_status string, model_name string, "
                                "model_version string, run_id string")
    frames = {"data_quality": dqf, "feature_drift": fdf, "prediction_drift": pdf, "performance": pff}
    for m in missing:
        frames[m] = frames[m].where("false")
    return gv.retraining_decision(state, cand, frames["data_quality"], frames["feature_drift"],
                                  frames["prediction_drift"], frames["performance"]).first()


def test_no_trigger(spark):
    assert decision(spark).should_retrain is False


@pytest.mark.parametrize("kw", [{"last_month": dt.date(2026, 9, 1)}, {"fsig": "feature-v2"}, {"msig": "model-v2"},
                                {"dq": "ALERT"}, {"alerts": 1}, {"pdrift": "ALERT"}, {"perf": "ALERT"},
                                {"last_month": None}])
def test_each_trigger(spark, kw):
    assert decision(spark, **kw).should_retrain is True


@pytest.mark.parametrize("m", ["data_quality", "feature_drift", "prediction_drift", "performance"])
def test_missing_monitor_is_insufficient_not_retraining(spark, m):
    r = decision(spark, missing=(m,))
    assert r.should_retrain is False
    assert "INSUFFICIENT_DATA" in (r.data_quality_status, r.feature_drift_status, r.prediction_drift_status,
                                   r.performance_status)


def test_missing_monitor_does_not_mask_other_trigger(spark):
    r = decision(spark, missing=("performance",), fsig="feature-v2")
    assert r.should_retrain is True and r.retrain_reasons == "feature_set_changed"


# --- ledger ---------------------------------------------------------------------
LEDGER = ("event_id string, state_key string, event_time timestamp, event_type string, "
          + ", ".join(f"from_{c} string" for c in ("model_resource", "run_id", "model_type", "feature_signature",
                                                    "model_signature"))
          + ", from_data_month date, from_training_timestamp timestamp, "
          + ", ".join(f"to_{c} string" for c in ("model_resource", "run_id", "model_type", "feature_signature",
                                                  "model_signature"))
          + ", to_data_month date, to_training_timestamp timestamp")


def _ev(eid, t, kind, frm, to):
    T = dt.datetime(2026, 1, t)
    f = (None,) * 7 if frm is None else (f"res/{frm}", f"run-{frm}", "xgboost", "fs", "ms", dt.date(2026, 1, 1), T)
    return (eid, "key", T, kind, *f, f"res/{to}", f"run-{to}", "xgboost", "fs", "ms", dt.date(2026, 1, 1), T)


def test_ledger_fold_a_b_a(spark):
    led = spark.createDataFrame([_ev("e1", 1, "PROMOTION", None, "A"), _ev("e2", 2, "PROMOTION", "A", "B"),
                                 _ev("e3", 3, "ROLLBACK", "B", "A")], LEDGER)
    act = gv.active_model(led).first()
    assert act.run_id == "run-A" and act.last_event_type == "ROLLBACK"
    state = spark.createDataFrame([("key", "res/A", "run-A", "APPROVED")],
                                  "model_name string, approved_model_resource string, approved_run_id string, "
                                  "candidate_status string")
    prev = gv.previous_model(led, state).first()
    assert prev.event_id == "e3" and prev.run_id == "run-B" and prev.snapshot_complete
    elig = {r.event_id: r for r in gv.rollback_eligibility(led, state).collect()}
    assert not elig["e1"].eligible and elig["e1"].reason == "Target is already the active approved model"
    assert elig["e2"].eligible


def test_incomplete_previous_snapshot_is_flagged(spark):
    led = spark.createDataFrame([_ev("e1", 1, "PROMOTION", None, "A")], LEDGER)
    state = spark.createDataFrame([("key", "res/A", "run-A", None)],
                                  "model_name string, approved_model_resource string, approved_run_id string, "
                                  "candidate_status string")
    prev = gv.previous_model(led, state).first()
    assert prev.snapshot_complete is False and "complete approval snapshot" in prev.problem


def test_equal_event_times_break_by_event_id(spark):
    led = spark.createDataFrame([_ev("e1", 1, "PROMOTION", None, "A"), _ev("e2", 1, "PROMOTION", "A", "B")], LEDGER)
    assert gv.active_model(led).first().run_id == "run-B"
