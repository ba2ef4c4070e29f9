"""Registered training / evaluation queries."""

from __future__ import annotations

import hashlib
import os

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..operators import features as fe
from ..operators import models as mdl
from ..operators import performance as pe
from ..operators import scoring as sc
from ..sources import adapters as ad
from ..session import ensure_checkpoint_dir
from . import features as pf
from . import monitoring as pm
from . import performance as pp
from .catalog import ctes, register

MATCHED = ctes(**pp.BASE)


def _train_test(spark, sf_dir, cols):
    feats = pf.fixture_features(spark, sf_dir)
    return feats.where("dataset_split = 'TRAIN'"), feats.where("dataset_split = 'TEST'")


@register("t1_training_readiness", ctes(**pf.FEATURE_CTES) + """
SELECT w.dataset_split, COALESCE(row_count, 0) AS row_count, COALESCE(positive_count, 0) AS positive_count,
  COALESCE(negative_count, 0) AS negative_count, COALESCE(null_feature_values, 0) AS null_feature_values,
  CASE WHEN COALESCE(row_count, 0) = 0 OR COALESCE(positive_count, 0) = 0 OR COALESCE(negative_count, 0) = 0
         OR COALESCE(null_feature_values, 0) > 0 THEN 'NOT_READY' ELSE 'READY' END AS status,
  CASE WHEN COALESCE(row_count, 0) = 0 THEN 'split is empty'
       WHEN COALESCE(positive_count, 0) = 0 OR COALESCE(negative_count, 0) = 0 THEN 'only one class present'
       WHEN COALESCE(null_feature_values, 0) > 0 THEN 'NULL feature values' END AS reason
FROM (VALUES ('TRAIN'), ('TEST')) w(dataset_split) LEFT JOIN (
  SELECT dataset_split, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE fraud_label = 1) AS positive_count,
    COUNT(*) FILTER (WHERE fraud_label = 0) AS negative_count, """ + pm._null_sql(fe.RF_FEATURES)
          + " AS null_feature_values FROM features GROUP BY dataset_split) a USING (dataset_split)")
def q_t1(spark, sf_dir):
    return mdl.training_readiness(pf.fixture_features(spark, sf_dir), fe.RF_FEATURES)


def _saved(spark, sf_dir, name, model_class, fit):
    """The model of a data directory: fitted by the first query that needs it, loaded from the shared folder by the others."""
    key = hashlib.sha256(f"{name}:{os.path.abspath(sf_dir) if '://' not in sf_dir else sf_dir}".encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/claimscope/models/{spark.sparkContext.applicationId}/{name}-{key}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        fit().write().overwrite().save(path)
    return model_class.load(path)


def _forest(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, fe.RF_FEATURES)
    return _saved(spark, sf_dir, "random_forest", RandomForestClassificationModel, lambda: mdl.train_random_forest(train, fe.RF_FEATURES)), test


def _boosted(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, fe.XGB_FEATURES)
    return _saved(spark, sf_dir, "boosted_trees", GBTClassificationModel, lambda: mdl.train_gbt(train, fe.XGB_FEATURES)), test


def _scores(test, model, cols):
    return sc.score(sc.batch_input(test, cols, split=None), model, cols)


@register("t2_random_forest_scores")
def q_t2(spark, sf_dir):
    model, test = _forest(spark, sf_dir)
    return _scores(test, model, fe.RF_FEATURES)


@register("t3_gbt_scores")
def q_t3(spark, sf_dir):
    model, test = _boosted(spark, sf_dir)
    return _scores(test, model, fe.XGB_FEATURES)


# C2 scores registered models: a step that knows only their path loads them
@register("c2_score")
def q_c2(spark, sf_dir):
    forest, test = _forest(spark, sf_dir)
    boosted, test_boosted = _boosted(spark, sf_dir)
    return (_scores(test, forest, fe.RF_FEATURES).withColumn("model_name", F.lit("random_forest"))
            .unionByName(_scores(test_boosted, boosted, fe.XGB_FEATURES).withColumn("model_name", F.lit("xgboost"))))


@register("t4_standardise", ctes(**pf.FEATURE_CTES) + ", st AS (SELECT " + ", ".join(
    f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in pm.IF_FEATURES)
    + " FROM features WHERE dataset_split = 'TRAIN')\nSELECT provider_id, " + ", ".join(
    f"ROUND(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS {c}" for c in pm.IF_FEATURES)
    + " FROM features CROSS JOIN st WHERE dataset_split = 'TEST'")
def q_t4(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, pm.IF_FEATURES)
    cols = pm.IF_FEATURES
    _, te = mdl.standardise(train.select("provider_id", *cols), test.select("provider_id", *cols), cols)
    return round_doubles(te, 6)


@register("t5_isolation_forest")
def q_t5(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, pm.IF_FEATURES)
    return mdl.isolation_forest(train, test, pm.IF_FEATURES)


CLS_SQL = MATCHED + """,
per AS (SELECT model_name, model_version, run_id, fraud_score AS s, SUM(actual_fraud) AS pos,
          COUNT(*) - SUM(actual_fraud) AS neg FROM matched GROUP BY 1, 2, 3, 4),
cum AS (SELECT *, SUM(pos) OVER w AS cum_pos, SUM(neg) OVER w AS cum_neg,
          SUM(pos) OVER (PARTITION BY model_name, model_version, run_id) AS P,
          SUM(neg) OVER (PARTITION BY model_name, model_version, run_id) AS N
        FROM per WINDOW w AS (PARTITION BY model_name, model_version, run_id ORDER BY s DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
curve AS (SELECT model_name, model_version, run_id,
   SUM(CASE WHEN P = 0 THEN NULL ELSE pos / P END * cum_pos / (cum_pos + cum_neg)) AS average_precision,
   SUM((CASE WHEN N = 0 THEN NULL ELSE cum_neg / N END - CASE WHEN N = 0 THEN NULL ELSE (cum_neg - neg) / N END)
       * (CASE WHEN P = 0 THEN NULL ELSE cum_pos / P END + CASE WHEN P = 0 THEN NULL ELSE (cum_pos - pos) / P END) / 2.0) AS roc_auc
  FROM cum GROUP BY 1, 2, 3),
cm AS (SELECT model_name, model_version, run_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE actual_fraud = 1) AS positives,
   COUNT(*) FILTER (WHERE fraud_score >= 0.5 AND actual_fraud = 1) AS tp,
   COUNT(*) FILTER (WHERE fraud_score >= 0.5 AND actual_fraud <> 1) AS fp,
   COUNT(*) FILTER (WHERE fraud_score < 0.5 AND actual_fraud = 1) AS fn FROM matched GROUP BY 1, 2, 3),
cm2 AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
   CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM cm)
SELECT model_name, model_version, run_id, n, positives, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
  ROUND(CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END, 9) AS f1_score,
  ROUND(average_precision, 9) AS average_precision, ROUND(roc_auc, 9) AS roc_auc
FROM cm2 LEFT JOIN curve USING (model_name, model_version, run_id)
"""


@register("t6_classification_metrics", CLS_SQL)
def q_t6(spark, sf_dir):
    m = pe.matched_cases(ad.raw_predictions(spark, sf_dir), ad.feedback(spark, sf_dir))
    return round_doubles(mdl.classification_metrics(m, group_by=pe.RUN_KEYS), 9)


@register("t7_threshold_sweep", MATCHED + " SELECT model_name, model_version, run_id, threshold, predicted_count, "
          "ROUND(p, 9) AS precision, ROUND(r, 9) AS recall, "
          "ROUND(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END, 9) AS f1_score FROM ("
          "SELECT *, CASE WHEN predicted_count > 0 THEN tp / predicted_count ELSE 0.0 END AS p, "
          "CASE WHEN pos > 0 THEN tp / pos ELSE 0.0 END AS r FROM ("
          "SELECT model_name, model_version, run_id, CAST(t.threshold AS DOUBLE) AS threshold, COUNT(*) FILTER (WHERE fraud_score >= t.threshold) AS predicted_count, "
          "COUNT(*) FILTER (WHERE fraud_score >= t.threshold AND actual_fraud = 1) AS tp, "
          "COUNT(*) FILTER (WHERE actual_fraud = 1) AS pos "
          "FROM matched CROSS JOIN (VALUES (0.2), (0.3), (0.4), (0.5)) t(threshold) GROUP BY 1, 2, 3, 4))")
def q_t7(spark, sf_dir):
    m = pe.matched_cases(ad.raw_predictions(spark, sf_dir), ad.feedback(spark, sf_dir))
    return round_doubles(mdl.threshold_sweep(m, group_by=pe.RUN_KEYS), 9)


@register("t8_feature_importance")
def q_t8(spark, sf_dir):
    model, _ = _forest(spark, sf_dir)
    return mdl.feature_importance(model, fe.RF_FEATURES, spark)


@register("t9_anomaly_metrics", ctes(preds=ad.RAW_PREDICTIONS_SQL) + """
SELECT run_id, COUNT(*) AS provider_count, COUNT(*) FILTER (WHERE fraud_score >= 0.5) AS flagged_provider_count,
  ROUND(AVG(fraud_score), 6) AS mean_anomaly_score, MAX(fraud_score) AS max_anomaly_score,
  COUNT(*) FILTER (WHERE fraud_score >= 0.5) / COUNT(*) AS alert_rate,
  ROUND(quantile_cont(fraud_score, 0.95), 6) AS p95_anomaly_score
FROM preds WHERE model_name = 'isolation_forest' GROUP BY run_id""")
def q_t9(spark, sf_dir):
    p = ad.raw_predictions(spark, sf_dir).where("model_name = 'isolation_forest'").withColumn(
        "suspicious_flag", F.when(F.col("fraud_score") >= 0.5, 1).otherwise(0))
    out = mdl.anomaly_metrics(p, group_by=["run_id"])
    return round_doubles(out, 6, ["mean_anomaly_score", "p95_anomaly_score"])


@register("t10_experiment_record", ctes(runs=ad.EXPERIMENT_RUNS_SQL) + """
SELECT substr(sha256(experiment_name), 1, 16) AS experiment_id,
  model_type || '-' || strftime(data_month, '%Y%m%d') || '-' || strftime(created_at, '%Y%m%d%H%M%S') AS run_id,
  experiment_name, model_type, data_month, created_at, source_run_id
FROM (SELECT experiment_name, model_type, CAST(date_trunc('month', training_end) AS DATE) AS data_month, created_at,
        run_id AS source_run_id FROM runs)""")
def q_t10(spark, sf_dir):
    runs = ad.experiment_runs(spark, sf_dir).select(
        "experiment_name", "model_type", F.trunc("training_end", "month").alias("data_month"), "created_at",
        F.col("run_id").alias("source_run_id"))
    return mdl.experiment_record(runs)
