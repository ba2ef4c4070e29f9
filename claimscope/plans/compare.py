"""Registered model-comparison / experiment-tracking queries."""

from __future__ import annotations

from ..functions.columns import pct2_expr, round_doubles
from ..operators import compare as cp
from ..operators import scoring as sc
from ..sources import adapters as ad
from . import scoring as ps
from .catalog import ctes, register

TYPES = ["xgboost", "random_forest"]
MODELS = ["isolation_forest", "xgboost", "random_forest"]
X2_NAMES = ["alert_rate", "mean_score", "precision", "recall", "f1_score", "provider_count"]
X3_NAMES = ["alert_rate", "mean_score", "precision", "recall"]
RUNS = dict(runs=ad.EXPERIMENT_RUNS_SQL)
CUR = dict(preds=ad.RAW_PREDICTIONS_SQL, cur=ps.CURATED_SQL)
LATEST_RUNS_SQL = ("SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_type ORDER BY created_at DESC, "
                   "run_id DESC) AS rn FROM runs WHERE model_type IN ({types})) WHERE rn = 1")
LATEST_PRED_RUNS_SQL = ("SELECT model_name, run_id FROM (SELECT model_name, run_id, ROW_NUMBER() OVER (PARTITION BY "
                        "model_name ORDER BY MAX(created_at) DESC, run_id DESC) AS rn FROM cur WHERE model_name IN "
                        "({models}) GROUP BY 1, 2) WHERE rn = 1")


def _q(xs):
    return ", ".join(f"'{x}'" for x in xs)


def _lp_sql(models):
    return dict(lr=LATEST_PRED_RUNS_SQL.format(models=_q(models)),
                lp="SELECT p.* FROM cur p JOIN lr USING (model_name, run_id)")


def curated(spark, sf_dir):
    return ps.curated(spark, sf_dir)


RUN_COLS = ["experiment_id", "run_id", "experiment_name", "owner", "model_type", "feature_version", "dataset_version",
            "git_commit", "training_start", "training_end", "status", "created_at"]


@register("x1_latest_runs", ctes(**RUNS, lr=LATEST_RUNS_SQL.format(types=_q(MODELS)))
          + "SELECT " + ", ".join(RUN_COLS) + " FROM lr")
def q_x1(spark, sf_dir):
    return cp.latest_runs(ad.experiment_runs(spark, sf_dir))


@register("x2_latest_metrics", ctes(**RUNS, metrics=ad.EXPERIMENT_METRICS_SQL, lr=LATEST_RUNS_SQL.format(types=_q(TYPES)))
          + f"SELECT r.model_type, m.metric_name, ROUND(m.metric_value, 4) AS metric_value FROM lr r "
            f"JOIN metrics m ON r.run_id = m.run_id WHERE m.metric_name IN ({_q(X2_NAMES)})")
def q_x2(spark, sf_dir):
    return cp.latest_metrics(ad.experiment_runs(spark, sf_dir), ad.experiment_metrics(spark, sf_dir), TYPES, X2_NAMES)


@register("x3_metric_pivot", ctes(**RUNS, metrics=ad.EXPERIMENT_METRICS_SQL, lr=LATEST_RUNS_SQL.format(types=_q(TYPES)))
          + "SELECT metric_name, " + ", ".join(f"ROUND(MAX(CASE WHEN model_type = '{t}' THEN metric_value END), 4) AS {t}"
                                                for t in TYPES)
          + f" FROM (SELECT r.model_type, m.metric_name, m.metric_value FROM lr r JOIN metrics m ON r.run_id = m.run_id) "
            f"WHERE metric_name IN ({_q(X3_NAMES)}) GROUP BY metric_name")
def q_x3(spark, sf_dir):
    return cp.metric_pivot(ad.experiment_runs(spark, sf_dir), ad.experiment_metrics(spark, sf_dir), TYPES, X3_NAMES)


@register("x4_tier_share", ctes(**CUR, **_lp_sql(MODELS)) + f"""
SELECT c.model_name, risk_category, provider_count, {pct2_expr('provider_count', 't', 'duck')} AS provider_pct
FROM (SELECT model_name, risk_category, COUNT(*) AS provider_count FROM lp GROUP BY 1, 2) c
JOIN (SELECT model_name, COUNT(*) AS t FROM lp GROUP BY 1) USING (model_name)""")
def q_x4(spark, sf_dir):
    return cp.tier_share(curated(spark, sf_dir), MODELS)


@register("x5_rank_matrix", ctes(**CUR, **_lp_sql(MODELS)) + "SELECT provider_id, " + ", ".join(
    f"MAX(CASE WHEN model_name = '{m}' THEN risk_rank END) AS {m}_rank" for m in MODELS) + ", " + ", ".join(
    f"MAX(CASE WHEN model_name = '{m}' THEN fraud_score END) AS {m}_score" for m in MODELS)
    + ", CAST(LEAST(" + ", ".join(f"MAX(CASE WHEN model_name = '{m}' THEN risk_rank END)" for m in MODELS)
    + ") AS BIGINT) AS best_rank FROM lp GROUP BY provider_id HAVING " + " OR ".join(
    f"MAX(CASE WHEN model_name = '{m}' THEN risk_rank END) <= 20" for m in MODELS))
def q_x5(spark, sf_dir):
    return cp.rank_matrix(curated(spark, sf_dir), MODELS, 20)


@register("x6_topk_overlap", ctes(**CUR, **_lp_sql(TYPES)) + """
SELECT COUNT(*) AS common_top_20_providers FROM (SELECT provider_id FROM lp WHERE model_name = 'xgboost' AND risk_rank <= 20)
JOIN (SELECT provider_id FROM lp WHERE model_name = 'random_forest' AND risk_rank <= 20) USING (provider_id)""")
def q_x6(spark, sf_dir):
    return cp.topk_overlap(curated(spark, sf_dir), "xgboost", "random_forest", 20)


@register("x7_score_on_confirmed", ctes(**CUR, **_lp_sql(TYPES), fb=ad.FEEDBACK_SQL) + """
SELECT model_name, COUNT(*) AS confirmed_fraud_scored, ROUND(AVG(fraud_score), 4) AS avg_fraud_score,
  COUNT(*) FILTER (WHERE risk_category = 'HIGH') AS high_risk_count
FROM lp JOIN (SELECT DISTINCT provider_id FROM fb WHERE confirmed_fraud) USING (provider_id) GROUP BY model_name""")
def q_x7(spark, sf_dir):
    return cp.score_on_confirmed(curated(spark, sf_dir), ad.feedback(spark, sf_dir), TYPES)


@register("x8_disagreement", ctes(**CUR, **_lp_sql(["isolation_forest", "xgboost"])) + """
SELECT i.provider_id, i.fraud_score AS isolation_forest_score, i.risk_rank AS isolation_forest_rank,
  i.risk_category AS isolation_forest_risk, x.fraud_score AS xgboost_score, x.risk_rank AS xgboost_rank,
  x.risk_category AS xgboost_risk
FROM (SELECT * FROM lp WHERE model_name = 'isolation_forest') i JOIN (SELECT * FROM lp WHERE model_name = 'xgboost') x
  USING (provider_id)
WHERE i.risk_rank > 50 AND x.risk_category = 'HIGH'""")
def q_x8(spark, sf_dir):
    return cp.disagreement(curated(spark, sf_dir), "isolation_forest", "xgboost", 50)


@register("x9_run_history", ctes(**RUNS) + "SELECT " + ", ".join(RUN_COLS) + " FROM runs WHERE model_type = 'xgboost'")
def q_x9(spark, sf_dir):
    return cp.run_history(ad.experiment_runs(spark, sf_dir), "xgboost")


@register("x9_recent_runs", ctes(**RUNS) + "SELECT " + ", ".join(RUN_COLS)
          + " FROM runs ORDER BY created_at DESC, run_id DESC LIMIT 10")
def q_x9b(spark, sf_dir):
    return cp.run_history(ad.experiment_runs(spark, sf_dir), None, 10)


@register("x9_metric_history", ctes(metrics=ad.EXPERIMENT_METRICS_SQL)
          + "SELECT run_id, metric_name, ROUND(metric_value, 6) AS metric_value, created_at FROM metrics "
            "WHERE experiment_id = 'exp-xgboost'")
def q_x9c(spark, sf_dir):
    return round_doubles(cp.metric_history(ad.experiment_metrics(spark, sf_dir), "exp-xgboost"), 6)


@register("x10_latest_top_predictions", ctes(**CUR, **_lp_sql(["random_forest"])) + """
SELECT provider_id, fraud_score, risk_rank, risk_category FROM lp ORDER BY risk_rank, provider_id LIMIT 20""")
def q_x10(spark, sf_dir):
    return cp.latest_top_predictions(curated(spark, sf_dir), "random_forest", 20)


@register("x11_resolve_run", ctes(**RUNS) + """
SELECT experiment_id, run_id FROM runs WHERE model_type = 'random_forest' AND status = 'SUCCEEDED'
ORDER BY created_at DESC, run_id DESC LIMIT 1""")
def q_x11(spark, sf_dir):
    return cp.resolve_run(ad.experiment_runs(spark, sf_dir), "random_forest")


@register("x12_metric_rows", ctes(preds=ad.RAW_PREDICTIONS_SQL) + """
SELECT run_id, metric_name, ROUND(metric_value, 6) AS metric_value FROM (
  SELECT run_id, CAST(COUNT(fraud_score) AS DOUBLE) AS scored_rows,
    CAST(COUNT(*) FILTER (WHERE fraud_score >= 0.5) AS DOUBLE) AS at_or_above_threshold,
    CAST(COUNT(*) FILTER (WHERE fraud_score < 0.5) AS DOUBLE) AS below_threshold,
    MIN(fraud_score) AS min_score, MAX(fraud_score) AS max_score, AVG(fraud_score) AS avg_score
  FROM preds GROUP BY run_id)
UNPIVOT (metric_value FOR metric_name IN (scored_rows, at_or_above_threshold, below_threshold, min_score, max_score, avg_score))""")
def q_x12(spark, sf_dir):
    wide = sc.score_distribution(ad.raw_predictions(spark, sf_dir), ["run_id"])
    return round_doubles(cp.metric_rows(wide, ["run_id"]), 6)
