"""Production performance monitoring from investigator feedback.

Everything is grouped by (model_name, model_version, run_id), so one job
evaluates every scored run at once instead of one run per process.  The
predictions x feedback join is an equi-join on three keys that Catalyst plans
as a sort-merge (or, after AQE measures the feedback side, broadcast) join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_if, reasons
from ..functions.ranking import top_k_per_group

COMPLETED = ("CONFIRMED_FRAUD", "CONFIRMED_NORMAL")
RUN_KEYS = ["model_name", "model_version", "run_id"]


def expected_version(model_type, resource):
    """``type:last_path_segment(resource)`` when the resource is known, else NULL."""
    seg = F.regexp_extract(F.regexp_replace(resource, "/+$", ""), r"([^/]+)$", 1)
    return F.when(resource.isNotNull(), F.concat(model_type, F.lit(":"), seg))


# P1 -----------------------------------------------------------------------------
def approved_version(state: DataFrame, preds: DataFrame, feedback: DataFrame) -> DataFrame:
    """Scored model version of each state key's approved run, among versions with
    completed feedback; the latest feedback wins.  NULL-tolerant expected version."""
    s = state.select(F.col("model_name").alias("state_key"),
                     F.col("approved_model_type").alias("s_model"), F.col("approved_run_id").alias("s_run"),
                     expected_version(F.col("approved_model_type"), F.col("approved_model_resource")).alias("s_expected"))
    p = preds.select("provider_id", "run_id", "model_version", "model_name")
    f = (feedback.where(F.col("investigation_result").isin(*COMPLETED))
                 .select("provider_id", "run_id", "model_version", F.col("model_name").alias("f_model"), "created_at"))
    j = (p.join(s, (p.model_name == s.s_model) & (p.run_id == s.s_run), "inner")
          .join(f, ["provider_id", "run_id", "model_version"], "inner")
          .where((F.col("f_model") == F.col("s_model"))
                 & (F.col("s_expected").isNull() | (F.col("model_version") == F.col("s_expected")))))
    per = j.groupBy("state_key", "model_name", "run_id", "model_version").agg(
        F.max("created_at").alias("latest_feedback_timestamp"))
    row = F.struct("model_name", "run_id", "model_version", "latest_feedback_timestamp")
    best = per.groupBy("state_key").agg(F.max_by(row, F.struct("latest_feedback_timestamp", "model_version")).alias("r"))
    return best.select("state_key", "r.*")


# P2 / P5 --------------------------------------------------------------------------
def matched_cases(preds: DataFrame, feedback: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Predictions joined to completed outcomes on (provider, run, version), same model."""
    p = preds.select("provider_id", "run_id", "model_version", "model_name", "fraud_score")
    f = (feedback.where(F.col("investigation_result").isin(*COMPLETED))
                 .select("provider_id", "run_id", "model_version", F.col("model_name").alias("f_model"),
                         "investigation_result", "confirmed_fraud", "fraud_amount"))
    j = p.join(f, ["provider_id", "run_id", "model_version"], "inner").where(F.col("f_model") == F.col("model_name"))
    return j.select(*RUN_KEYS, "provider_id", "fraud_score",
                    F.when(F.col("fraud_score") >= threshold, 1).otherwise(0).alias("predicted_fraud"),
                    F.when(F.col("investigation_result") == "CONFIRMED_FRAUD", 1).otherwise(0).alias("actual_fraud"),
                    "investigation_result", "confirmed_fraud", "fraud_amount")


def capped_cases(matched: DataFrame, n: int) -> DataFrame:
    """P5: deterministic first ``n`` matched cases per run ordered by (provider, score)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return top_k_per_group(matched, RUN_KEYS, [F.col("provider_id"), F.col("fraud_score")], n,
                           rank_col="__cap_rn").drop("__cap_rn")


def confusion(matched: DataFrame) -> DataFrame:
    """Evaluated / confirmed counts and TP, FP, TN, FN per run."""
    pf, af = F.col("predicted_fraud"), F.col("actual_fraud")
    return matched.groupBy(*RUN_KEYS).agg(
        F.count(F.lit(1)).alias("evaluated_cases"),
        count_if(af == 1).alias("confirmed_fraud_cases"), count_if(af == 0).alias("confirmed_normal_cases"),
        count_if((pf == 1) & (af == 1)).alias("true_positive"), count_if((pf == 1) & (af == 0)).alias("false_positive"),
        count_if((pf == 0) & (af == 0)).alias("true_negative"), count_if((pf == 0) & (af == 1)).alias("false_negative"))


def with_all_runs(conf: DataFrame, preds: DataFrame) -> DataFrame:
    """P2 for every scored run: a run without a matched case has zero counts (P4 then says INSUFFICIENT_DATA)."""
    counts = [c for c in conf.columns if c not in RUN_KEYS]
    return preds.select(*RUN_KEYS).distinct().join(conf, RUN_KEYS, "left").na.fill(0, counts)


# P3 -----------------------------------------------------------------------------
def investigation_summary(feedback: DataFrame) -> DataFrame:
    """Reviewed, confirmed fraud/normal, yield and confirmed dollars per run."""
    f = feedback.where(F.col("investigation_result").isin(*COMPLETED))
    cf = F.col("confirmed_fraud")
    return f.groupBy(*RUN_KEYS).agg(
        F.count(F.lit(1)).alias("providers_reviewed"), count_if(cf).alias("confirmed_fraud"),
        count_if(~cf).alias("confirmed_normal"),
        F.try_divide(count_if(cf), F.count(F.lit(1))).alias("fraud_yield"),
        F.sum(F.when(cf, F.coalesce(F.col("fraud_amount"), F.lit(0))).otherwise(F.lit(0))).cast("decimal(18,2)")
         .alias("confirmed_fraud_amount"))


# P4 -----------------------------------------------------------------------------
def performance_degradation(conf: DataFrame, metrics: DataFrame, evaluation_ts, min_cases: int = 20,
                            precision_drop: float = 0.10, recall_drop: float = 0.15, f1_drop: float = 0.10
                            ) -> DataFrame:
    """precision/recall/F1/yield vs the run's training metrics with status.

    ``metrics`` is long (run_id, metric_name, metric_value); it is pivoted with
    ``max`` so repeated metric rows cannot multiply the join.
    """
    if evaluation_ts is None:
        raise ValueError("pass evaluation_ts explicitly")
    base = (metrics.where(F.col("metric_name").isin("precision", "recall", "f1_score"))
                   .groupBy("run_id").agg(
                       F.max(F.when(F.col("metric_name") == "precision", F.col("metric_value"))).alias("bp"),
                       F.max(F.when(F.col("metric_name") == "recall", F.col("metric_value"))).alias("br"),
                       F.max(F.when(F.col("metric_name") == "f1_score", F.col("metric_value"))).alias("bf")))
    j = conf.join(base, "run_id", "left")
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    enough = F.col("evaluated_cases") >= min_cases
    prec = F.when((tp + fp) > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when((tp + fn) > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    j = j.withColumn("_p", prec).withColumn("_r", rec)
    f1 = F.when((F.col("_p") + F.col("_r")) > 0, F.lit(2.0) * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))
                ).otherwise(F.lit(0.0))
    j = j.withColumn("_f", f1)
    rel = lambda cur, b: F.when(F.col(b).isNull() | (F.col(b) == 0), F.lit(None).cast("double")).otherwise(
        (F.col(cur) - F.col(b)) / F.col(b))
    j = j.withColumn("_pc", rel("_p", "bp")).withColumn("_rc", rel("_r", "br")).withColumn("_fc", rel("_f", "bf"))
    why = reasons((F.col("_pc") <= -precision_drop, "precision_degradation"),
                  (F.col("_rc") <= -recall_drop, "recall_degradation"),
                  (F.col("_fc") <= -f1_drop, "f1_degradation"))
    missing_base = F.col("bp").isNull() | F.col("br").isNull() | F.col("bf").isNull()
    status = (F.when(~enough, "INSUFFICIENT_DATA").when(missing_base, "INSUFFICIENT_BASELINE")
               .when(F.length(why) > 0, "ALERT").otherwise("PASS"))
    reason = (F.when(~enough, "Not enough completed investigation outcomes")
               .when(missing_base, "Training baseline metrics are missing")
               .when(F.length(why) > 0, why))
    g = lambda c: F.when(enough, F.col(c))  # noqa: E731  (metrics are NULL below the case floor)
    ts = F.lit(evaluation_ts).cast("timestamp")
    return j.select(
        ts.alias("evaluation_timestamp"), ts.cast("date").alias("evaluation_date"), *RUN_KEYS,
        "evaluated_cases", "confirmed_fraud_cases", "confirmed_normal_cases",
        "true_positive", "false_positive", "true_negative", "false_negative",
        g("_p").alias("precision"), g("_r").alias("recall"), g("_f").alias("f1_score"),
        F.when(enough, F.col("confirmed_fraud_cases") / F.col("evaluated_cases")).alias("fraud_yield"),
        g("bp").alias("baseline_precision"), g("br").alias("baseline_recall"), g("bf").alias("baseline_f1"),
        g("_pc").alias("precision_change"), g("_rc").alias("recall_change"), g("_fc").alias("f1_change"),
        status.alias("monitoring_status"), reason.alias("alert_reason"))


def point_changes(perf: DataFrame) -> DataFrame:
    """Absolute (percentage-point) changes next to the relative ones."""
    return perf.select("*", *[(F.col(c) - F.col(b)).alias(f"{c}_point_change")
                              for c, b in (("precision", "baseline_precision"), ("recall", "baseline_recall"),
                                           ("f1_score", "baseline_f1"))])

