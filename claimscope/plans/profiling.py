"""Registered validation/profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sketches as sk
from ..functions.columns import pct2_expr, round_doubles
from ..functions.ranking import materialize, tasks_for
from ..operators import features as fe
from ..operators import profiling as pr
from ..sources import adapters as ad
from ..sources.layout import buckets_for, write_bucketed
from . import features as pf
from .catalog import ctes, register

CL = ctes(claims=ad.CLAIMS_SQL)

# Cohort expectations of the exploratory checks.
COHORT_RULES = [("single_specialty", "provider_specialty", "Primary Care"),
                ("single_state", "provider_state", "TX"),
                ("all_eye_related", "is_eye_procedure", 1)]


def _pct(k, n):
    return pct2_expr(k, n, "duck")


@register("v1_load_counts", CL + """
SELECT COUNT(*) AS total_claims, COUNT(DISTINCT provider_id) AS total_providers,
       COUNT(DISTINCT member_id) AS total_members FROM claims""")
def q_v1(spark, sf_dir):
    return pr.load_counts(ad.claims(spark, sf_dir))


@register("v2_split_summary", ctes(claims=ad.CLAIMS_SQL, split=pf.FULL_SPLIT_SQL) + """
SELECT dataset_split, MIN(service_date) AS min_service_date, MAX(service_date) AS max_service_date,
  COUNT(*) AS claim_count, COUNT(DISTINCT provider_id) AS provider_count, COUNT(DISTINCT member_id) AS member_count
FROM split GROUP BY dataset_split""")
def q_v2(spark, sf_dir):
    return pr.split_summary(pf.full_split(spark, sf_dir))


@register("v3_cohort_rate", CL + f"""
SELECT total_claims, flag_claims, {_pct('flag_claims', 'n')} AS flag_pct FROM (
  SELECT COUNT(*) AS total_claims, CAST(SUM(is_eye_procedure) AS BIGINT) AS flag_claims,
         COUNT(is_eye_procedure) AS n FROM claims)""")
def q_v3(spark, sf_dir):
    return pr.cohort_rate(ad.claims(spark, sf_dir), "is_eye_procedure")


@register("v4_prefix_distribution", CL + """
SELECT SUBSTR(CAST(icd_code AS VARCHAR), 1, 1) AS prefix, COUNT(*) AS claim_count FROM claims GROUP BY 1""")
def q_v4(spark, sf_dir):
    return pr.prefix_distribution(ad.claims(spark, sf_dir), "icd_code", 1)


DIMS = ["provider_specialty", "provider_state", "provider_city"]


@register("v5_dimension_distribution", CL + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, COUNT(*) AS claim_count, "
    f"COUNT(DISTINCT provider_id) AS provider_count FROM claims GROUP BY {d}" for d in DIMS))
def q_v5(spark, sf_dir):
    return pr.dimension_distribution(ad.claims(spark, sf_dir), DIMS)


PRED_FB_SQL = """
SELECT p.provider_id, p.run_id, p.model_name, p.fraud_score, f.investigation_result, f.confirmed_fraud,
       f.fraud_amount, f.investigation_date
FROM preds p LEFT JOIN fb f ON p.provider_id = f.provider_id AND p.run_id = f.run_id
"""
PRED_FB_COLS = ["provider_id", "run_id", "model_name", "fraud_score", "investigation_result", "confirmed_fraud",
                "fraud_amount", "investigation_date"]


def preds_with_feedback(spark, sf_dir):
    p = ad.raw_predictions(spark, sf_dir)
    f = ad.feedback(spark, sf_dir).select("provider_id", "run_id", "investigation_result", "confirmed_fraud",
                                          "fraud_amount", "investigation_date")
    return p.join(f, ["provider_id", "run_id"], "left").select(*PRED_FB_COLS)


@register("v6_null_profile", ctes(preds=ad.RAW_PREDICTIONS_SQL, fb=ad.FEEDBACK_SQL, pf=PRED_FB_SQL) + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"{_pct(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)')} AS missing_pct FROM pf) WHERE missing_count > 0"
    for c in PRED_FB_COLS))
def q_v6(spark, sf_dir):
    return pr.null_profile(preds_with_feedback(spark, sf_dir))


@register("v7_duplicate_count", CL + """
SELECT COALESCE(CAST(SUM(c - 1) AS BIGINT), 0) AS duplicate_rows, COUNT(*) FILTER (WHERE c > 1) AS duplicated_keys
FROM (SELECT claim_id, COUNT(*) AS c FROM claims GROUP BY claim_id)""")
def q_v7(spark, sf_dir):
    return pr.duplicate_count(ad.claims(spark, sf_dir), "claim_id")


@register("v8_value_share", CL + f"""
SELECT cpt_code, claim_count, {_pct('claim_count', 'total')} AS claim_pct FROM
 (SELECT cpt_code, COUNT(*) AS claim_count FROM claims GROUP BY cpt_code)
 CROSS JOIN (SELECT COUNT(*) AS total FROM claims)""")
def q_v8(spark, sf_dir):
    return pr.value_share(ad.claims(spark, sf_dir), "cpt_code")


@register("v9_behaviour_metrics", CL + " UNION ALL ".join(
    f"SELECT '{label}' AS metric, {_pct(f'SUM({c})', 'COUNT(*)')} AS value_pct FROM claims"
    for c, label in pr.BEHAVIOUR_LABELS.items()))
def q_v9(spark, sf_dir):
    return pr.behaviour_metrics(ad.claims(spark, sf_dir))


SUMMARY_SQL = """
SELECT provider_id, provider_city, provider_state, COUNT(*) AS total_claims,
  COUNT(DISTINCT member_id) AS unique_members,
  CAST(SUM(is_high_acuity_em) AS BIGINT) AS high_acuity_claims, AVG(CAST(is_high_acuity_em AS DOUBLE)) AS high_acuity_pct,
  CAST(SUM(is_99214) AS BIGINT) AS claims_99214, AVG(CAST(is_99214 AS DOUBLE)) AS pct_99214,
  CAST(SUM(is_99215) AS BIGINT) AS claims_99215, AVG(CAST(is_99215 AS DOUBLE)) AS pct_99215,
  CAST(SUM(is_referral) AS BIGINT) AS referral_count, AVG(CAST(is_referral AS DOUBLE)) AS referral_rate,
  CAST(SUM(is_eye_procedure) AS BIGINT) AS eye_procedure_claims, AVG(CAST(is_eye_procedure AS DOUBLE)) AS eye_procedure_pct,
  CAST(SUM(total_billed_amt) AS DOUBLE) / COUNT(total_billed_amt) AS avg_billed_per_claim,
  CAST(SUM(total_allowed_amt) AS DOUBLE) / COUNT(total_allowed_amt) AS avg_allowed_per_claim,
  CAST(SUM(total_paid_amount) AS DOUBLE) / COUNT(total_paid_amount) AS avg_paid_per_claim,
  CAST(SUM(total_paid_amount) AS DECIMAL(18,2)) AS total_paid
FROM claims GROUP BY provider_id, provider_city, provider_state
"""
SUMMARY_COLS = ["provider_id", "provider_city", "provider_state", "total_claims", "unique_members",
                "high_acuity_claims", "high_acuity_pct", "claims_99214", "pct_99214", "claims_99215", "pct_99215",
                "referral_count", "referral_rate", "eye_procedure_claims", "eye_procedure_pct",
                "avg_billed_per_claim", "avg_allowed_per_claim", "avg_paid_per_claim", "total_paid"]


@register("v10_provider_summary", CL + SUMMARY_SQL)
def q_v10(spark, sf_dir):
    return pr.provider_summary(ad.claims(spark, sf_dir))


@register("v11_top_providers", ctes(claims=ad.CLAIMS_SQL, s=SUMMARY_SQL) + "SELECT " + ", ".join(
    f"{c} * 100 AS {c}" if c in pr.PCT_COLS else c for c in SUMMARY_COLS)
    + " FROM s ORDER BY high_acuity_pct DESC NULLS LAST, provider_id LIMIT 20")
def q_v11(spark, sf_dir):
    return pr.top_providers(pr.provider_summary(ad.claims(spark, sf_dir)), "high_acuity_pct", 20,
                            pct_cols=pr.PCT_COLS)


@register("v12_describe_features", ctes(claims=ad.CLAIMS_SQL, s=SUMMARY_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, COUNT({c}) AS count, ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std, ROUND(MIN(CAST({c} AS DOUBLE)), 6) AS min, "
    f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50, "
    f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, ROUND(MAX(CAST({c} AS DOUBLE)), 6) AS max FROM s"
    for c in pr.SUMMARY_FEATURES))
def q_v12(spark, sf_dir):
    return round_doubles(pr.describe_features(pr.provider_summary(ad.claims(spark, sf_dir)), pr.SUMMARY_FEATURES), 6)


SCORE_PCTS = (0.50, 0.75, 0.90, 0.95, 0.99)


@register("v12_describe_scores", ctes(preds=ad.RAW_PREDICTIONS_SQL) + "SELECT run_id, 'fraud_score' AS feature, "
          "COUNT(fraud_score) AS count, ROUND(AVG(fraud_score), 6) AS mean, ROUND(STDDEV_SAMP(fraud_score), 6) AS std, "
          "ROUND(MIN(fraud_score), 6) AS min, " + ", ".join(
              f"ROUND(quantile_cont(fraud_score, {q}), 6) AS p{int(round(q * 100))}" for q in SCORE_PCTS)
          + ", ROUND(MAX(fraud_score), 6) AS max FROM preds GROUP BY run_id")
def q_v12s(spark, sf_dir):
    out = pr.describe_features(ad.raw_predictions(spark, sf_dir), ["fraud_score"], SCORE_PCTS, group_by=["run_id"])
    return round_doubles(out, 6)


@register("v13_snapshot_uniqueness", pf.F5_SQL.replace("SELECT provider_id AS entity_id", ", f AS (SELECT provider_id AS entity_id", 1)
          .rstrip() + ")\nSELECT dataset_split, COUNT(*) AS provider_rows, COUNT(DISTINCT provider_id) AS providers, "
          "MIN(feature_timestamp) AS feature_timestamp FROM f GROUP BY dataset_split")
def q_v13(spark, sf_dir):
    return pr.snapshot_uniqueness(pf.median_features(spark, sf_dir))


@register("v14_cohort_assertions", CL + " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, '{c}' AS column_name, '{e}' AS expected, COUNT(DISTINCT {c}) AS distinct_values, "
    f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, "
    f"CASE WHEN COUNT(DISTINCT {c}) = 1 AND CAST(MIN({c}) AS VARCHAR) = '{e}' THEN 'PASS' ELSE 'WARNING' END AS status "
    f"FROM claims" for n, c, e in COHORT_RULES))
def q_v14(spark, sf_dir):
    return pr.cohort_assertions(ad.claims(spark, sf_dir), COHORT_RULES)


@register("v15_label_separability", CL + """, prov AS (
  SELECT provider_id, fraud_provider_label,
    AVG(CAST(is_high_acuity_em AS DOUBLE)) AS high_acuity_pct, AVG(CAST(is_99215 AS DOUBLE)) AS pct_99215,
    AVG(CAST(is_referral AS DOUBLE)) AS referral_rate, AVG(CAST(is_eye_procedure AS DOUBLE)) AS eye_procedure_pct,
    CAST(SUM(total_paid_amount) AS DOUBLE) / COUNT(total_paid_amount) AS avg_paid_per_claim,
    AVG(member_provider_distance) AS avg_member_provider_distance
  FROM claims GROUP BY provider_id, fraud_provider_label)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, fraud_provider_label, ROUND(MIN({c}), 6) AS min_value, ROUND(AVG({c}), 6) AS mean_value, "
    f"ROUND(MAX({c}), 6) AS max_value, COUNT(*) AS providers FROM prov GROUP BY fraud_provider_label"
    for c in pr.SEPARABILITY_FEATURES))
def q_v15(spark, sf_dir):
    return round_doubles(pr.label_separability(ad.claims(spark, sf_dir)), 6)


# distinct members per provider and month from daily sketches, next to the exact count
@register("v1_member_sketches", CL + """
SELECT provider_id, CAST(date_trunc('month', service_date) AS DATE) AS month, COUNT(DISTINCT member_id) AS unique_members, TRUE AS sketch_in_bound
FROM claims GROUP BY 1, 2""")
def q_member_sketches(spark, sf_dir):
    claims = ad.claims(spark, sf_dir).select("provider_id", "service_date", "member_id")
    daily = materialize(sk.distinct_sketches(claims, ["provider_id", "service_date"], "member_id"))
    month = F.trunc("service_date", "month").alias("month")
    guess = sk.distinct_estimates(daily, ["provider_id", month], out="estimate")
    exact = claims.groupBy("provider_id", month).agg(F.count_distinct("member_id").alias("unique_members"))
    return exact.join(guess, ["provider_id", "month"]).select(
        "provider_id", "month", "unique_members", sk.distinct_in_bound(F.col("estimate"), F.col("unique_members")).alias("sketch_in_bound"))


# the same daily sketches merged over any window: the trailing quarter and all time
@register("v10_member_windows", CL + """, q AS (SELECT last_day(service_date) AS month_end, provider_id FROM claims GROUP BY 1, 2)
SELECT q.provider_id, q.month_end, COUNT(DISTINCT member_id) AS unique_members, TRUE AS sketch_in_bound
FROM q JOIN claims c ON c.provider_id = q.provider_id AND c.service_date <= q.month_end
  AND c.service_date >= date_trunc('month', q.month_end) - INTERVAL 2 MONTH GROUP BY 1, 2""")
def q_member_windows(spark, sf_dir):
    """Distinct members of a provider's trailing three months for each month with claims."""
    # the claims are joined and read once, for the sketches and for the exact counts
    pairs = materialize(ad.claims(spark, sf_dir).select("provider_id", "member_id", F.last_day("service_date").alias("month_end")).distinct())
    parts = tasks_for(pairs, 3 * pairs.count())
    monthly = materialize(sk.distinct_sketches(pairs, ["provider_id", "month_end"], "member_id"))
    # a month's sketch goes into three windows; windows without claims of their last month are not asked for
    spread = monthly.select("provider_id", F.explode(F.array(*[F.last_day(F.add_months("month_end", k)) for k in range(3)])).alias("month_end"), "members")
    asked = spread.join(monthly.select("provider_id", "month_end"), ["provider_id", "month_end"], "left_semi")
    guess = sk.distinct_estimates(asked.repartition(parts, "provider_id", "month_end"), ["provider_id", "month_end"], out="estimate")
    exact = pr.members_of_windows(pairs, 3, parts)
    return exact.join(guess, ["provider_id", "month_end"]).select(
        "provider_id", "month_end", "unique_members", sk.distinct_in_bound(F.col("estimate"), F.col("unique_members")).alias("sketch_in_bound"))


# the provider summary from claims that lie in buckets by provider: no shuffle after the one that wrote them
@register("v10_summary_from_buckets", CL + SUMMARY_SQL)
def q_v10_buckets(spark, sf_dir):
    rows = ad.read(spark, sf_dir, "lineitem").count()  # one claim per line item at most, from the files' footers
    return pr.provider_summary(write_bucketed(ad.claims(spark, sf_dir), "provider_id", buckets_for(rows)))
