import datetime as dt

from claimscope.operators import performance as pe

CONF = ("model_name string, model_version string, run_id string, evaluated_cases long, confirmed_fraud_cases long, "
        "confirmed_normal_cases long, true_positive long, false_positive long, true_negative long, false_negative long")
MET = "run_id string, metric_name string, metric_value double"


def test_replay_exported_degradation_row(spark):
    # 50 investigated: TP 1, FP 4, TN 41, FN 4 vs training .25 / .2 / .2222...
    conf = spark.createDataFrame([("xgboost", "xgboost:1", "r", 50, 5, 45, 1, 4, 41, 4)], CONF)
    met = spark.createDataFrame([("r", "precision", 0.25), ("r", "recall", 0.2), ("r", "f1_score", 0.2222222222222222)], MET)
    r = pe.performance_degradation(conf, met, dt.datetime(2026, 10, 20)).first()
    assert (r.precision, r.recall, r.f1_score) == (0.2, 0.2, 0.20000000000000004)
    assert r.precision_change == -0.19999999999999996 and r.recall_change == 0.0
    assert r.f1_change == -0.09999999999999977  # just above -0.10: F1 does not alert
    assert r.monitoring_status == "ALERT" and r.alert_reason == "precision_degradation"
    assert r.fraud_yield == 0.1


def test_fifteen_cases_are_insufficient(spark):
    conf = spark.createDataFrame([("random_forest", "random_forest:test-model-001", "t", 15, 3, 12, 2, 1, 11, 1)], CONF)
    met = spark.createDataFrame([("t", "precision", 0.5)], MET)
    r = pe.performance_degradation(conf, met, dt.datetime(2026, 9, 1)).first()
    assert r.monitoring_status == "INSUFFICIENT_DATA" and r.precision is None and r.baseline_precision is None


def test_missing_baseline(spark):
    conf = spark.createDataFrame([("m", "m:1", "r", 30, 5, 25, 1, 4, 21, 4)], CONF)
    met = spark.createDataFrame([("r", "precision", 0.5), ("r", "recall", 0.5)], MET)
    r = pe.performance_degradation(conf, met, dt.datetime(2026, 9, 1)).first()
    assert r.monitoring_status == "INSUFFICIENT_BASELINE"


def test_zero_denominators_are_zero(spark):
    conf = spark.createDataFrame([("m", "m:1", "r", 25, 0, 25, 0, 0, 25, 0)], CONF)
    met = spark.createDataFrame([("r", "precision", 0.5), ("r", "recall", 0.5), ("r", "f1_score", 0.5)], MET)
    r = pe.performance_degradation(conf, met, dt.datetime(2026, 9, 1)).first()
    assert (r.precision, r.recall, r.f1_score) == (0.0, 0.0, 0.0)
    assert r.alert_reason == "precision_degradation,recall_degradation,f1_degradation"
