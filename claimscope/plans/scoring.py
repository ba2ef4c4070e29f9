"""Registered scoring / curation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..operators import features as fe
from ..operators import monitoring as mo
from ..operators import scoring as sc
from ..sources import adapters as ad
from . import features as pf
from . import monitoring as pm
from .catalog import ctes, register

PRED_DATE = "2024-02-01"
CREATED = "2024-02-01 00:00:00"
LINEAGE = ["prediction_date", "experiment_id", "run_id", "model_name", "model_version", "created_at"]


def raw_output(spark, sf_dir):
    """Raw batch-job output: lineage + provider + score as text (parsed by C6)."""
    return ad.raw_predictions(spark, sf_dir).select(*LINEAGE, "provider_id",
                                                    F.col("fraud_score").cast("string").alias("prediction"))


def latest_run_classes(spark, sf_dir, model_type="isolation_forest"):
    """Raw classes of the latest run of ``model_type`` (run chosen from the run table)."""
    runs = ad.experiment_runs(spark, sf_dir).where(F.col("model_type") == model_type)
    latest = runs.agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))
    return ad.raw_classes(spark, sf_dir, model_type).join(F.broadcast(latest), "run_id", "left_semi")


LATEST_CLASSES_SQL = ("SELECT * FROM rawc WHERE run_id = (SELECT run_id FROM runs WHERE model_type = '{m}' "
                      "ORDER BY created_at DESC, run_id DESC LIMIT 1)")


# C1
@register("c1_batch_input", ctes(**pf.FEATURE_CTES) + "SELECT provider_id, " + ", ".join(
    f"ROUND(CAST({c} AS DOUBLE), 6) AS {c}" if c == "high_acuity_oe_ratio" else f"CAST({c} AS DOUBLE) AS {c}"
    for c in fe.RF_FEATURES) + " FROM features WHERE dataset_split = 'TEST'")
def q_c1(spark, sf_dir):
    return round_doubles(sc.batch_input(pf.fixture_features(spark, sf_dir), fe.RF_FEATURES), 6,
                         ["high_acuity_oe_ratio"])


# C3
C3_SQL = ctes(**pf.FEATURE_CTES, b=pm.BATCH_SQL, preds=ad.RAW_PREDICTIONS_SQL,
                                             runs=ad.EXPERIMENT_RUNS_SQL) + """,
raw AS (SELECT * FROM preds WHERE run_id = (SELECT run_id FROM runs WHERE model_type = 'xgboost'
        ORDER BY created_at DESC, run_id DESC LIMIT 1)),
bi AS (SELECT DISTINCT provider_id, TRUE AS i FROM b),
r AS (SELECT provider_id, COUNT(*) AS n,
        COUNT(*) FILTER (WHERE fraud_score IS NOT NULL AND (fraud_score < 0 OR fraud_score > 1)) AS oor,
        COUNT(*) FILTER (WHERE fraud_score IS NULL) AS nul FROM raw GROUP BY provider_id),
j AS (SELECT * FROM bi FULL OUTER JOIN r USING (provider_id)),
a AS (SELECT COUNT(*) FILTER (WHERE i) AS input_count, COALESCE(CAST(SUM(n) AS BIGINT), 0) AS predicted_count,
  COUNT(*) FILTER (WHERE i AND n IS NULL) AS missing_providers,
  COUNT(*) FILTER (WHERE i IS NULL AND provider_id IS NOT NULL) AS unexpected_providers,
  COALESCE(CAST(SUM(CASE WHEN provider_id IS NULL THEN n END) AS BIGINT), 0) AS lost_lineage_rows,
  COUNT(*) FILTER (WHERE n > 1 AND provider_id IS NOT NULL) AS duplicated_providers,
  COALESCE(CAST(SUM(oor) AS BIGINT), 0) AS out_of_range_scores, COALESCE(CAST(SUM(nul) AS BIGINT), 0) AS null_scores FROM j),
b2 AS (SELECT *, CASE WHEN predicted_count = 0 THEN 'zero successful prediction rows'
    WHEN predicted_count != input_count THEN 'prediction count does not match input count'
    WHEN lost_lineage_rows > 0 THEN 'output lost provider lineage'
    WHEN duplicated_providers > 0 THEN 'duplicate prediction for a provider'
    WHEN out_of_range_scores > 0 OR null_scores > 0 THEN 'prediction is not a probability'
    WHEN missing_providers > 0 OR unexpected_providers > 0 THEN 'provider lineage mismatch' END AS reason FROM a)
SELECT * EXCLUDE (reason), CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, reason FROM b2"""


@register("c3_prediction_completeness", C3_SQL)
def q_c3(spark, sf_dir):
    runs = ad.experiment_runs(spark, sf_dir).where("model_type = 'xgboost'")
    latest = runs.agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))
    raw = ad.raw_predictions(spark, sf_dir).join(F.broadcast(latest), "run_id", "left_semi")
    return sc.prediction_completeness(pm.batch_input(spark, sf_dir), raw)


def _latest_xgb_raw(spark, sf_dir):
    runs = ad.experiment_runs(spark, sf_dir).where("model_type = 'xgboost'")
    latest = runs.agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))
    return ad.raw_predictions(spark, sf_dir).join(F.broadcast(latest), "run_id", "left_semi")


@register("c3_completeness_failures", ctes(**pf.FEATURE_CTES, b=pm.BATCH_SQL, preds=ad.RAW_PREDICTIONS_SQL,
                                           runs=ad.EXPERIMENT_RUNS_SQL) + """,
raw AS (SELECT * FROM preds WHERE run_id = (SELECT run_id FROM runs WHERE model_type = 'xgboost'
        ORDER BY created_at DESC, run_id DESC LIMIT 1)),
bi AS (SELECT DISTINCT provider_id, TRUE AS i FROM b),
r AS (SELECT provider_id, COUNT(*) AS n FROM raw GROUP BY provider_id),
j AS (SELECT provider_id, CASE WHEN i AND n IS NULL THEN 'missing' WHEN i IS NULL THEN 'unexpected'
                               WHEN n > 1 THEN 'duplicated' END AS problem
      FROM bi FULL OUTER JOIN r USING (provider_id))
SELECT provider_id, problem FROM j WHERE problem IS NOT NULL ORDER BY problem, provider_id LIMIT 20""")
def q_c3f(spark, sf_dir):
    return sc.completeness_failures(pm.batch_input(spark, sf_dir), _latest_xgb_raw(spark, sf_dir), 20)


# C4
@register("c4_invalid_predictions", ctes(preds=ad.RAW_PREDICTIONS_SQL) + """
SELECT run_id, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE fraud_score IS NOT NULL AND COALESCE(isnan(TRY_CAST(CAST(fraud_score AS VARCHAR) AS DOUBLE)), TRUE)) AS invalid_predictions
FROM preds GROUP BY run_id""")
def q_c4(spark, sf_dir):
    return sc.invalid_predictions(raw_output(spark, sf_dir), group_by=["run_id"])


# C5
@register("c5_score_distribution", ctes(preds=ad.RAW_PREDICTIONS_SQL) + """
SELECT run_id, COUNT(fraud_score) AS scored_rows, COUNT(*) FILTER (WHERE fraud_score >= 0.5) AS at_or_above_threshold,
  COUNT(*) FILTER (WHERE fraud_score < 0.5) AS below_threshold, MIN(fraud_score) AS min_score,
  MAX(fraud_score) AS max_score, ROUND(AVG(fraud_score), 6) AS avg_score FROM preds GROUP BY run_id""")
def q_c5(spark, sf_dir):
    return round_doubles(sc.score_distribution(ad.raw_predictions(spark, sf_dir), ["run_id"]), 6, ["avg_score"])


# C6
CURATED_SQL = """
SELECT prediction_date, experiment_id, run_id, model_name, model_version, provider_id, fraud_score,
  CAST(ROW_NUMBER() OVER (PARTITION BY model_name, model_version, run_id ORDER BY fraud_score DESC, provider_id) AS BIGINT) AS risk_rank,
  CASE WHEN fraud_score >= 0.80 THEN 'HIGH' WHEN fraud_score >= 0.50 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
  CASE WHEN fraud_score >= 0.80 THEN 'Very high model fraud probability'
       WHEN fraud_score >= 0.50 THEN 'Elevated model fraud probability' ELSE 'Below investigation threshold' END AS reason,
  created_at
FROM preds WHERE fraud_score IS NOT NULL AND NOT isnan(fraud_score)
"""


def curated(spark, sf_dir):
    return sc.curate_predictions(raw_output(spark, sf_dir))


@register("c6_curate_predictions", ctes(preds=ad.RAW_PREDICTIONS_SQL) + CURATED_SQL)
def q_c6(spark, sf_dir):
    return curated(spark, sf_dir)


# C8 (SQL pieces shared with C7)
def reasons_sql(src, means_src, cols, zero_mean="zero", keep_cols=("provider_id",)):
    if zero_mean == "zero":
        ratio = lambda c: f"CASE WHEN m.mean_{c} != 0 THEN r.{c} / m.mean_{c} ELSE 0.0 END"
    else:
        ratio = lambda c: f"CASE WHEN m.mean_{c} = 0 THEN NULL ELSE r.{c} / m.mean_{c} END"
    rows = " UNION ALL ".join(f"SELECT r.provider_id, '{c}' AS feature_name, {i + 1} AS feature_order, {ratio(c)} AS ratio "
                              f"FROM {src} r CROSS JOIN {means_src} m" for i, c in enumerate(cols))
    drop = "WHERE ratio IS NOT NULL" if zero_mean == "drop" else ""
    keep = ", ".join(f"s.{k}" for k in keep_cols)
    return f"""SELECT {keep}, x.reason_1, x.reason_2, x.reason_3 FROM {src} s LEFT JOIN (
  SELECT provider_id, MAX(CASE WHEN rn = 1 THEN feature_name END) AS reason_1,
    MAX(CASE WHEN rn = 2 THEN feature_name END) AS reason_2, MAX(CASE WHEN rn = 3 THEN feature_name END) AS reason_3
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY provider_id ORDER BY ratio DESC NULLS LAST, feature_order) AS rn
        FROM ({rows}) {drop}) GROUP BY provider_id) x ON s.provider_id = x.provider_id"""


def means_sql(cols):
    return "SELECT " + ", ".join(f"AVG({c}) AS mean_{c}" for c in cols) + " FROM features WHERE dataset_split = 'TRAIN'"


def _reasons_spark(spark, sf_dir, cols, zero_mean):
    feats = pf.fixture_features(spark, sf_dir)
    batch = sc.batch_input(feats, cols)
    means = sc.train_means(feats.where("dataset_split = 'TRAIN'"), cols)
    return sc.reason_codes(batch, means, cols, 3, zero_mean).select("provider_id", "reason_1", "reason_2", "reason_3")


@register("c8_reason_codes", ctes(**pf.FEATURE_CTES, b=pm.BATCH_SQL, m=means_sql(pm.IF_FEATURES))
          + reasons_sql("b", "m", pm.IF_FEATURES, "zero"))
def q_c8(spark, sf_dir):
    return _reasons_spark(spark, sf_dir, pm.IF_FEATURES, "zero")


RF_BATCH_SQL = "SELECT provider_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in fe.RF_FEATURES) + \
    " FROM features WHERE dataset_split = 'TEST'"


@register("c8_reason_codes_drop_zero_mean", ctes(**pf.FEATURE_CTES, b=RF_BATCH_SQL, m=means_sql(fe.RF_FEATURES))
          + reasons_sql("b", "m", fe.RF_FEATURES, "drop"))
def q_c8b(spark, sf_dir):
    return _reasons_spark(spark, sf_dir, fe.RF_FEATURES, "drop")


# C7
def c7_sql(model: str, positive: str) -> str:
    yes, no = sc.CLASS_REASON[model]
    return ctes(**pf.FEATURE_CTES, b=pm.BATCH_SQL, m=means_sql(pm.IF_FEATURES), runs=ad.EXPERIMENT_RUNS_SQL,
                rawc=ad.raw_classes_sql(model)) + f""",
lr AS ({LATEST_CLASSES_SQL.format(m=model)}),
jf AS (SELECT CAST(lr.provider_id AS VARCHAR) AS provider_id,
         CAST(CASE WHEN TRY_CAST(lr.prediction AS INTEGER) = {int(positive)} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS fraud_score,
         b.* EXCLUDE (provider_id)
       FROM lr JOIN b ON CAST(lr.provider_id AS VARCHAR) = b.provider_id),
rc AS ({reasons_sql('jf', 'm', pm.IF_FEATURES, 'zero', ('provider_id', 'fraud_score'))}),
e AS (SELECT experiment_id, run_id, experiment_name FROM runs WHERE model_type = '{model}'
      ORDER BY created_at DESC, run_id DESC LIMIT 1)
SELECT DATE '{PRED_DATE}' AS prediction_date, rc.provider_id, e.experiment_id, e.run_id, '{model}' AS model_name,
  e.experiment_name, rc.fraud_score,
  CAST(ROW_NUMBER() OVER (ORDER BY rc.fraud_score DESC, rc.provider_id) AS BIGINT) AS risk_rank,
  CASE WHEN rc.fraud_score = 1.0 THEN 'HIGH' ELSE 'LOW' END AS risk_category,
  CASE WHEN rc.fraud_score = 1.0 THEN '{yes}' ELSE '{no}' END AS reason,
  TIMESTAMP '{CREATED}' AS created_at, rc.reason_1, rc.reason_2, rc.reason_3
FROM rc CROSS JOIN e
"""


C7_SQL = c7_sql("isolation_forest", "-1")


def curated_classes(spark, sf_dir, model="isolation_forest", positive="-1"):
    feats = pf.fixture_features(spark, sf_dir)
    batch = sc.batch_input(feats, pm.IF_FEATURES)
    means = sc.train_means(feats.where("dataset_split = 'TRAIN'"), pm.IF_FEATURES)
    return sc.curate_classes(latest_run_classes(spark, sf_dir, model), ad.experiment_runs(spark, sf_dir),
                             model, positive, batch, means, pm.IF_FEATURES, PRED_DATE, CREATED)


@register("c7_curate_classes_random_forest", c7_sql("random_forest", "1"))
def q_c7_rf(spark, sf_dir):
    return curated_classes(spark, sf_dir, "random_forest", "1")


@register("c7_curate_classes", C7_SQL)
def q_c7(spark, sf_dir):
    return curated_classes(spark, sf_dir)


# C9
@register("c9_anomaly_tiers", ctes(preds=ad.RAW_PREDICTIONS_SQL) + """
SELECT model_name, model_version, run_id, provider_id, fraud_score, suspicious_flag, risk_rank,
  CASE WHEN suspicious_flag = 1 THEN 'HIGH' WHEN risk_rank <= 50 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
FROM (SELECT model_name, model_version, run_id, provider_id, fraud_score, CASE WHEN fraud_score >= 0.5 THEN 1 ELSE 0 END AS suspicious_flag,
        CAST(ROW_NUMBER() OVER (PARTITION BY model_name, model_version, run_id ORDER BY fraud_score DESC, provider_id) AS BIGINT) AS risk_rank
      FROM preds WHERE model_name = 'isolation_forest')""")
def q_c9(spark, sf_dir):
    p = ad.raw_predictions(spark, sf_dir).where("model_name = 'isolation_forest'").select(
        "model_name", "model_version", "run_id", "provider_id", "fraud_score",
        F.when(F.col("fraud_score") >= 0.5, 1).otherwise(0).alias("suspicious_flag"))
    return sc.anomaly_tiers(p, 50)


# C10
@register("c10_prediction_summary", C7_SQL.replace("SELECT DATE '" + PRED_DATE + "' AS prediction_date",
                                                   ", c7 AS (SELECT DATE '" + PRED_DATE + "' AS prediction_date", 1)
          .rstrip() + ")\nSELECT experiment_id, run_id, model_name, COUNT(*) AS provider_count, "
          "COUNT(*) FILTER (WHERE risk_category = 'HIGH') AS high_risk_count, "
          "COUNT(*) FILTER (WHERE risk_category = 'LOW') AS low_risk_count, "
          "ROUND(AVG(fraud_score), 6) AS predicted_anomaly_rate FROM c7 GROUP BY 1, 2, 3")
def q_c10(spark, sf_dir):
    return round_doubles(sc.prediction_summary(curated_classes(spark, sf_dir)), 6)


# C11: parity of the current scored run against its baseline run (M6)
C11_SQL = pm._chain("preds", "scored", "now", "before").rstrip() + """,
a AS (SELECT provider_id, fraud_score FROM preds, now WHERE run_id = x.r),
b AS (SELECT provider_id, fraud_score FROM preds, before WHERE run_id = y.r),
j AS (SELECT a.fraud_score AS sa, b.fraud_score AS sb FROM a FULL OUTER JOIN b USING (provider_id)),
g AS (SELECT COUNT(*) FILTER (WHERE sa IS NOT NULL AND sb IS NOT NULL) AS matched_providers,
        COUNT(*) FILTER (WHERE sb IS NULL) AS only_in_a, COUNT(*) FILTER (WHERE sa IS NULL) AS only_in_b,
        MAX(ABS(sa - sb)) AS max_abs_difference, ROUND(AVG(ABS(sa - sb)), 6) AS mean_abs_difference,
        COUNT(*) FILTER (WHERE ABS(sa - sb) > 1e-6) AS providers_over_tolerance FROM j)
SELECT *, CASE WHEN only_in_a = 0 AND only_in_b = 0 AND COALESCE(max_abs_difference <= 1e-6, TRUE) THEN 'PASS'
               ELSE 'FAIL' END AS parity_status FROM g"""


@register("c11_score_parity", C11_SQL)
def q_c11(spark, sf_dir):
    preds = ad.raw_predictions(spark, sf_dir)
    runs = mo.resolve_score_runs(preds)
    pick = lambda role: preds.join(F.broadcast(runs.where(F.col("role") == role).select("run_id")), "run_id",
                                   "left_semi")
    return round_doubles(sc.score_parity(pick("CURRENT"), pick("BASELINE")), 6, ["mean_abs_difference"])


@register("c3_completeness_by_fingerprint", C3_SQL)
def q_c3_prints(spark, sf_dir):
    return sc.completeness_by_fingerprint(pm.batch_input(spark, sf_dir), _latest_xgb_raw(spark, sf_dir))


@register("c11_parity_by_fingerprint", C11_SQL)
def q_c11_prints(spark, sf_dir):
    preds = ad.raw_predictions(spark, sf_dir)
    runs = mo.resolve_score_runs(preds)
    a, b = (preds.join(F.broadcast(runs.where(F.col("role") == role).select("run_id")), "run_id", "left_semi") for role in ("CURRENT", "BASELINE"))
    return round_doubles(sc.parity_by_fingerprint(a, b), 6, ["mean_abs_difference"])
