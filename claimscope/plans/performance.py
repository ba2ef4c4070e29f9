"""Registered production-performance queries (P1-P5) and source checks."""

from __future__ import annotations

from ..functions.columns import round_doubles
from ..functions.ranking import materialize
from ..operators import performance as pe
from ..sources import adapters as ad
from .catalog import ctes, register

EVAL_TS = "2024-02-01 00:00:00"
CAP = 15
WIDE_CAP = 40  # above the floor of 20 cases, so that a status is judged

MATCHED_SQL = """
SELECT p.model_name, p.model_version, p.run_id, p.provider_id, p.fraud_score,
  CASE WHEN p.fraud_score >= 0.5 THEN 1 ELSE 0 END AS predicted_fraud,
  CASE WHEN f.investigation_result = 'CONFIRMED_FRAUD' THEN 1 ELSE 0 END AS actual_fraud,
  f.investigation_result, f.confirmed_fraud, f.fraud_amount
FROM preds p JOIN fb f ON p.provider_id = f.provider_id AND p.run_id = f.run_id AND p.model_version = f.model_version
WHERE f.model_name = p.model_name AND f.investigation_result IN ('CONFIRMED_FRAUD', 'CONFIRMED_NORMAL')
"""
CONF_SQL = """
SELECT model_name, model_version, run_id, COUNT(*) AS evaluated_cases,
  COUNT(*) FILTER (WHERE actual_fraud = 1) AS confirmed_fraud_cases, COUNT(*) FILTER (WHERE actual_fraud = 0) AS confirmed_normal_cases,
  COUNT(*) FILTER (WHERE predicted_fraud = 1 AND actual_fraud = 1) AS true_positive,
  COUNT(*) FILTER (WHERE predicted_fraud = 1 AND actual_fraud = 0) AS false_positive,
  COUNT(*) FILTER (WHERE predicted_fraud = 0 AND actual_fraud = 0) AS true_negative,
  COUNT(*) FILTER (WHERE predicted_fraud = 0 AND actual_fraud = 1) AS false_negative
FROM {src} GROUP BY 1, 2, 3
"""
BASE = dict(preds=ad.RAW_PREDICTIONS_SQL, fb=ad.FEEDBACK_SQL, matched=MATCHED_SQL)


def _matched(spark, sf_dir):
    return pe.matched_cases(ad.raw_predictions(spark, sf_dir), ad.feedback(spark, sf_dir))


@register("p1_approved_version", ctes(preds=ad.RAW_PREDICTIONS_SQL, fb=ad.FEEDBACK_SQL, state=ad.TRAINING_STATE_SQL) + """,
s AS (SELECT model_name AS state_key, approved_model_type AS s_model, approved_run_id AS s_run,
        CASE WHEN approved_model_resource IS NOT NULL THEN approved_model_type || ':' ||
             regexp_extract(regexp_replace(approved_model_resource, '/+$', ''), '([^/]+)$', 1) END AS s_expected FROM state),
per AS (SELECT s.state_key, p.model_name, p.run_id, p.model_version, MAX(f.created_at) AS latest_feedback_timestamp
  FROM preds p JOIN s ON p.model_name = s.s_model AND p.run_id = s.s_run
  JOIN fb f ON p.provider_id = f.provider_id AND p.run_id = f.run_id AND p.model_version = f.model_version
  WHERE f.model_name = s.s_model AND f.investigation_result IN ('CONFIRMED_FRAUD', 'CONFIRMED_NORMAL')
    AND (s.s_expected IS NULL OR p.model_version = s.s_expected)
  GROUP BY 1, 2, 3, 4)
SELECT state_key, model_name, run_id, model_version, latest_feedback_timestamp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY state_key ORDER BY latest_feedback_timestamp DESC, model_version DESC) AS rn FROM per)
WHERE rn = 1""")
def q_p1(spark, sf_dir):
    return pe.approved_version(ad.training_state(spark, sf_dir), ad.raw_predictions(spark, sf_dir),
                               ad.feedback(spark, sf_dir))


@register("p2_confusion", ctes(**BASE) + CONF_SQL.format(src="matched"))
def q_p2(spark, sf_dir):
    return pe.confusion(_matched(spark, sf_dir))


@register("p3_investigation_summary", ctes(fb=ad.FEEDBACK_SQL) + """
SELECT model_name, model_version, run_id, COUNT(*) AS providers_reviewed,
  COUNT(*) FILTER (WHERE confirmed_fraud) AS confirmed_fraud, COUNT(*) FILTER (WHERE NOT confirmed_fraud) AS confirmed_normal,
  CAST(COUNT(*) FILTER (WHERE confirmed_fraud) AS DOUBLE) / COUNT(*) AS fraud_yield,
  CAST(SUM(CASE WHEN confirmed_fraud THEN COALESCE(fraud_amount, 0) ELSE 0 END) AS DECIMAL(18,2)) AS confirmed_fraud_amount
FROM fb WHERE investigation_result IN ('CONFIRMED_FRAUD', 'CONFIRMED_NORMAL') GROUP BY 1, 2, 3""")
def q_p3(spark, sf_dir):
    return pe.investigation_summary(ad.feedback(spark, sf_dir))


PERF_SQL = """
SELECT TIMESTAMP '{ts}' AS evaluation_timestamp, CAST(TIMESTAMP '{ts}' AS DATE) AS evaluation_date,
  model_name, model_version, run_id, evaluated_cases, confirmed_fraud_cases, confirmed_normal_cases,
  true_positive, false_positive, true_negative, false_negative,
  CASE WHEN enough THEN ROUND(p, 9) END AS precision, CASE WHEN enough THEN ROUND(r, 9) END AS recall,
  CASE WHEN enough THEN ROUND(f1, 9) END AS f1_score,
  CASE WHEN enough THEN ROUND(confirmed_fraud_cases / evaluated_cases, 9) END AS fraud_yield,
  CASE WHEN enough THEN ROUND(bp, 9) END AS baseline_precision, CASE WHEN enough THEN ROUND(br, 9) END AS baseline_recall,
  CASE WHEN enough THEN ROUND(bf, 9) END AS baseline_f1,
  CASE WHEN enough THEN ROUND(pc, 9) END AS precision_change, CASE WHEN enough THEN ROUND(rc, 9) END AS recall_change,
  CASE WHEN enough THEN ROUND(fc, 9) END AS f1_change,
  CASE WHEN NOT enough THEN 'INSUFFICIENT_DATA' WHEN bp IS NULL OR br IS NULL OR bf IS NULL THEN 'INSUFFICIENT_BASELINE'
       WHEN why <> '' THEN 'ALERT' ELSE 'PASS' END AS monitoring_status,
  CASE WHEN NOT enough THEN 'Not enough completed investigation outcomes'
       WHEN bp IS NULL OR br IS NULL OR bf IS NULL THEN 'Training baseline metrics are missing'
       WHEN why <> '' THEN why END AS alert_reason
FROM (SELECT *, array_to_string(list_filter([
        CASE WHEN pc <= -0.1 THEN 'precision_degradation' END,
        CASE WHEN rc <= -0.15 THEN 'recall_degradation' END,
        CASE WHEN fc <= -0.1 THEN 'f1_degradation' END], lambda x: x IS NOT NULL), ',') AS why
  FROM (SELECT *, CASE WHEN bp IS NULL OR bp = 0 THEN NULL ELSE (p - bp) / bp END AS pc,
          CASE WHEN br IS NULL OR br = 0 THEN NULL ELSE (r - br) / br END AS rc,
          CASE WHEN bf IS NULL OR bf = 0 THEN NULL ELSE (f1 - bf) / bf END AS fc
    FROM (SELECT *, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f1
      FROM (SELECT c.*, evaluated_cases >= 20 AS enough,
              CASE WHEN true_positive + false_positive > 0 THEN true_positive / (true_positive + false_positive) ELSE 0.0 END AS p,
              CASE WHEN true_positive + false_negative > 0 THEN true_positive / (true_positive + false_negative) ELSE 0.0 END AS r,
              b.bp, b.br, b.bf
            FROM conf c LEFT JOIN (SELECT run_id,
                MAX(CASE WHEN metric_name = 'precision' THEN metric_value END) AS bp,
                MAX(CASE WHEN metric_name = 'recall' THEN metric_value END) AS br,
                MAX(CASE WHEN metric_name = 'f1_score' THEN metric_value END) AS bf
              FROM metrics WHERE metric_name IN ('precision', 'recall', 'f1_score') GROUP BY run_id) b USING (run_id)))))
"""


def _perf(spark, sf_dir, conf):
    out = pe.performance_degradation(conf, ad.experiment_metrics(spark, sf_dir), EVAL_TS)
    return round_doubles(out, 9)


COUNTS = ("evaluated_cases", "confirmed_fraud_cases", "confirmed_normal_cases", "true_positive", "false_positive",
          "true_negative", "false_negative")
ALL_RUNS_SQL = ("SELECT model_name, model_version, run_id, " + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in COUNTS)
                + " FROM (SELECT DISTINCT model_name, model_version, run_id FROM preds) LEFT JOIN matched_runs "
                  "USING (model_name, model_version, run_id)")


def _all_runs(spark, sf_dir):
    preds = materialize(ad.raw_predictions(spark, sf_dir))
    return pe.with_all_runs(pe.confusion(pe.matched_cases(preds, ad.feedback(spark, sf_dir))), preds)


P4_BASE = ctes(**BASE, matched_runs=CONF_SQL.format(src="matched"), conf=ALL_RUNS_SQL, metrics=ad.EXPERIMENT_METRICS_SQL)


@register("p4_performance_degradation", P4_BASE + PERF_SQL.format(ts=EVAL_TS))
def q_p4(spark, sf_dir):
    return _perf(spark, sf_dir, _all_runs(spark, sf_dir))


# percentage points next to the relative changes
@register("p4_point_changes", P4_BASE.rstrip() + ", perf AS (" + PERF_SQL.format(ts=EVAL_TS) + """)
SELECT model_name, model_version, run_id, monitoring_status, ROUND(precision - baseline_precision, 6) AS precision_point_change,
  ROUND(recall - baseline_recall, 6) AS recall_point_change, ROUND(f1_score - baseline_f1, 6) AS f1_score_point_change FROM perf""")
def q_p4_points(spark, sf_dir):
    out = pe.point_changes(_perf(spark, sf_dir, _all_runs(spark, sf_dir)))
    return round_doubles(out.select("model_name", "model_version", "run_id", "monitoring_status", "precision_point_change",
                                    "recall_point_change", "f1_score_point_change"), 6)


CAPPED_SQL = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name, model_version, run_id
  ORDER BY provider_id, fraud_score) AS rn FROM matched) WHERE rn <= {CAP}"""


@register("p5_capped_cases", ctes(**BASE) + CAPPED_SQL)
def q_p5(spark, sf_dir):
    return pe.capped_cases(_matched(spark, sf_dir), CAP)


@register("p5_capped_performance", ctes(**BASE, capped=CAPPED_SQL, conf=CONF_SQL.format(src="capped"),
                                        metrics=ad.EXPERIMENT_METRICS_SQL) + PERF_SQL.format(ts=EVAL_TS))
def q_p5perf(spark, sf_dir):
    return _perf(spark, sf_dir, pe.confusion(pe.capped_cases(_matched(spark, sf_dir), CAP)))


@register("p5_capped_performance_above_floor", ctes(**BASE, capped=CAPPED_SQL.replace(f"rn <= {CAP}", f"rn <= {WIDE_CAP}"),
                                                    conf=CONF_SQL.format(src="capped"),
                                                    metrics=ad.EXPERIMENT_METRICS_SQL) + PERF_SQL.format(ts=EVAL_TS))
def q_p5wide(spark, sf_dir):
    return _perf(spark, sf_dir, pe.confusion(pe.capped_cases(_matched(spark, sf_dir), WIDE_CAP)))
