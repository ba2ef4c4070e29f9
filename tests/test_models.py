import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimscope.operators import models as mdl


def _brute_ap_auc(scores, labels):
    order = sorted(set(scores), reverse=True)
    P = sum(labels)
    N = len(labels) - P
    ap = auc = 0.0
    tp = fp = 0
    for t in order:
        pos = sum(1 for s, y in zip(scores, labels) if s == t and y == 1)
        neg = sum(1 for s, y in zip(scores, labels) if s == t and y == 0)
        ptp, pfp = tp, fp
        tp += pos
        fp += neg
        ap += (pos / P) * tp / (tp + fp)
        auc += (fp / N - pfp / N) * (tp / P + ptp / P) / 2
    return ap, auc


def test_ap_and_roc_auc_with_ties_match_brute_force(spark):
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 1), rnd.randint(0, 1), "r" + str(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "fraud_score double, actual_fraud int, run string")
    got = {r.run: r for r in mdl.classification_metrics(df, group_by=["run"]).collect()}
    for run in ("r0", "r1"):
        sub = [(s, y) for s, y, g in rows if g == run]
        ap, auc = _brute_ap_auc([s for s, _ in sub], [y for _, y in sub])
        assert got[run].average_precision == pytest.approx(ap, abs=1e-12)
        assert got[run].roc_auc == pytest.approx(auc, abs=1e-12)


def test_threshold_sweep(spark):
    df = spark.createDataFrame([(0.1, 0), (0.35, 1), (0.45, 0), (0.9, 1)], "fraud_score double, actual_fraud int")
    r = {x.threshold: x for x in mdl.threshold_sweep(df).collect()}
    assert r[0.3].predicted_count == 3 and r[0.3].precision == pytest.approx(2 / 3) and r[0.3].recall == 1.0
    assert r[0.5].predicted_count == 1 and r[0.5].precision == 1.0 and r[0.5].recall == 0.5


def test_standardise_zero_std(spark):
    tr = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "provider_id string, x double, c double")
    _, te = mdl.standardise(tr, tr, ["x", "c"])
    got = {r.provider_id: (r.x, r.c) for r in te.collect()}
    assert got == {"a": (-1.0, 0.0), "b": (1.0, 0.0)}


def test_isolation_forest_properties(spark):
    rng = np.random.default_rng(0)
    normal = rng.normal(0, 1, size=(300, 3))
    outliers = rng.normal(8, 1, size=(10, 3))
    X = np.vstack([normal, outliers])
    rows = [(f"p{i:03d}", *map(float, x)) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "provider_id string, a double, b double, c double")
    params = {**mdl.IF_PARAMS, "n_estimators": 50}
    out = mdl.isolation_forest(df, df, ["a", "b", "c"], params)
    res = {r.provider_id: r for r in out.collect()}
    scores = np.array([res[f"p{i:03d}"].fraud_score for i in range(len(X))])
    assert ((scores > 0) & (scores < 1)).all()
    assert scores[300:].min() > np.quantile(scores[:300], 0.9)       # outliers score highest
    flagged = sum(r.suspicious_flag for r in res.values())
    assert 20 <= flagged <= 40                                        # ~ contamination 0.10 of 310
    again = {r.provider_id: r.fraud_score for r in mdl.isolation_forest(df, df, ["a", "b", "c"], params).collect()}
    assert again == {k: v.fraud_score for k, v in res.items()}         # deterministic


def test_random_forest_beats_chance(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        y = int(i % 4 == 0)
        rows.append((f"p{i}", float(rng.normal(y * 2.0, 1.0)), float(rng.normal(0, 1)), y))
    df = spark.createDataFrame(rows, "provider_id string, f1 double, f2 double, fraud_label int")
    model = mdl.train_random_forest(df, ["f1", "f2"], {**mdl.RF_PARAMS, "n_estimators": 20})
    from claimscope.operators.scoring import score
    s = score(df.select("provider_id", "f1", "f2"), model, ["f1", "f2"]).join(df, "provider_id")
    m = mdl.classification_metrics(s.withColumnRenamed("fraud_label", "actual_fraud")).first()
    assert m.roc_auc > 0.8
    imp = mdl.feature_importance(model, ["f1", "f2"], spark).collect()
    assert imp[0].feature == "f1"
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9 and F is not None


def test_training_tasks_follow_the_rows_not_the_shuffle_partitions(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("string").alias("provider_id"))
    was = spark.conf.get("spark.sql.shuffle.partitions")

    def tasks(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        d = mdl._training_layout(df)
        try:
            assert d.count() == 1000
            return d.rdd.getNumPartitions()
        finally:
            d.unpersist()
    try:
        assert tasks("200") == tasks("64") == 8    # a pass over a small table is a few tasks on any cluster
        assert tasks("4") == 4
        monkeypatch.setattr(mdl, "TRAINING_ROWS", 50)
        assert tasks("200") == 20                  # and grows with the table
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
