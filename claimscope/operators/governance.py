"""Retraining and model-governance tables.

Governance state is small (one row per model key; one ledger row per
release), but every operator is still a DataFrame transformation so it runs
for any number of keys at once.  Monitor inputs are reduced to their latest
row with ``max_by`` aggregates (1-row frames) and attached with broadcast
cross joins, the Spark form of ``LEFT JOIN ... ON TRUE``.  Transactional
UPDATE / INSERT are re-expressed as pure functions returning the new table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.asof import as_of_join
from ..functions.columns import attach_scalars, count_if, reasons
from ..functions.ranking import latest_per, materialize, row_number_by, top_k_per_group

SUPPORTED_TYPES = ("random_forest", "xgboost")
PENDING, APPROVED = "PENDING_APPROVAL", "APPROVED"
# Promotion gate thresholds (pipeline configuration).
GATE = {"min_pr_auc_improvement": 0.00, "min_recall_change": 0.00, "min_f1_change": 0.00,
        "min_precision_change": -0.05}
GATE_METRICS = ("pr_auc", "precision", "recall", "f1_score")


def _latest_value(df: DataFrame, value: str, ts: str, alias: str) -> DataFrame:
    """1-row frame: ``value`` of the newest row by ``ts`` (NULL when ``df`` is empty); of rows
    with one time the smallest value, so ALERT comes before PASS."""
    last = df.groupBy(ts).agg(F.min(value).alias("__v"))
    return last.agg(F.max_by(F.col("__v"), F.col(ts)).alias(alias))


def _of_model(df: DataFrame, model_name: str) -> DataFrame:
    return df.where(F.col("model_name") == model_name)


def _feature_alerts(drift: DataFrame, ts: str = "monitoring_timestamp") -> DataFrame:
    """1-row: ALERT count and feature count of the latest feature-drift run."""
    mx = drift.agg(F.max(ts).alias("__mx"))
    latest = drift.join(F.broadcast(mx), F.col(ts) == F.col("__mx"), "inner")
    return latest.agg(count_if(F.col("monitoring_status") == "ALERT").alias("feature_alert_count"),
                      F.count(F.lit(1)).alias("feature_count"))


# G1 -----------------------------------------------------------------------------
def retraining_trigger(feedback: DataFrame, dq: DataFrame, drift: DataFrame, pred_drift: DataFrame,
                       check_ts, model_name: str = "provider_fraud_model", new_label_threshold: int = 20
                       ) -> DataFrame:
    """G1: label counts and the model's latest monitor statuses -> retraining_required + reason text.

    All three monitors are read for ``model_name`` only; a model without monitor rows has no alert.
    """
    if check_ts is None:
        raise ValueError("pass check_ts explicitly")
    lab = F.col("confirmed_fraud").cast("int")
    labels = feedback.where(lab.isNotNull()).agg(
        F.count(F.lit(1)).alias("labeled_provider_count"), count_if(lab == 1).alias("confirmed_fraud_count"),
        count_if(lab == 0).alias("confirmed_normal_count"))
    dq, drift, pred_drift = (_of_model(x, model_name) for x in (dq, drift, pred_drift))
    dq1 = _latest_value(dq, "monitoring_status", "monitoring_timestamp", "dq_status")
    fd1 = _feature_alerts(drift)
    pd1 = _latest_value(pred_drift, "status", "check_date", "pd_status")
    j = attach_scalars(attach_scalars(attach_scalars(labels, dq1), fd1), pd1)  # all 1-row frames
    dqt = F.coalesce(F.col("dq_status") == "ALERT", F.lit(False))
    fdt = F.coalesce(F.col("feature_alert_count") > 0, F.lit(False))
    pdt = F.coalesce(F.col("pd_status") == "ALERT", F.lit(False))
    enough = F.col("labeled_provider_count") >= new_label_threshold
    # Trigger reason texts.
    reason = (F.when(enough & dqt & fdt & pdt, "New labels + data quality + feature drift + prediction drift")
               .when(enough & (dqt | fdt | pdt), "New labels + monitoring alert")
               .when(enough, "Enough confirmed investigation labels available")
               .when(dqt & fdt & pdt, "Data quality + feature drift + prediction drift alerts")
               .when(dqt & fdt, "Data quality + feature drift alerts")
               .when(dqt & pdt, "Data quality + prediction drift alerts")
               .when(fdt & pdt, "Feature drift + prediction drift alerts")
               .when(dqt, "Data quality alert").when(fdt, "Feature drift alert")
               .when(pdt, "Prediction drift alert").otherwise("No retraining trigger"))
    return j.select(F.lit(check_ts).cast("timestamp").alias("check_timestamp"), F.lit(model_name).alias("model_name"),
                    "labeled_provider_count", "confirmed_fraud_count", "confirmed_normal_count",
                    F.lit(new_label_threshold).alias("new_label_threshold"),
                    dqt.alias("data_quality_trigger"), fdt.alias("feature_drift_trigger"),
                    pdt.alias("prediction_drift_trigger"), (dqt | fdt | pdt).alias("monitoring_trigger"),
                    (enough | dqt | fdt | pdt).alias("retraining_required"), reason.alias("trigger_reason"))


# G2 -----------------------------------------------------------------------------
def _norm_status(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c)), F.lit("INSUFFICIENT_DATA"))


def retraining_decision(state: DataFrame, candidates: DataFrame, dq: DataFrame, drift: DataFrame,
                        pred_drift: DataFrame, perf: DataFrame) -> DataFrame:
    """Per state key, combine monitor alerts, a new data month and signature
    changes into ``should_retrain`` with the list of reasons.

    ``candidates``: state_key, current_data_month, current_feature_signature,
    current_model_signature, current_model_type.  A missing monitor is
    INSUFFICIENT_DATA and does not trigger; a missing state row triggers
    (new month).
    """
    dq1 = _latest_value(dq, "monitoring_status", "monitoring_timestamp", "data_quality_status")
    fd1 = _feature_alerts(drift)
    pd1 = _latest_value(pred_drift, "status", "check_date", "prediction_drift_status")
    pf1 = perf.agg(F.max_by(F.struct("monitoring_status", "model_name", "model_version", "run_id"),
                            F.struct("evaluation_timestamp", "run_id")).alias("p")).select(
        F.col("p.monitoring_status").alias("performance_status"), F.col("p.run_id").alias("performance_run_id"))
    monitors = attach_scalars(attach_scalars(attach_scalars(dq1, fd1), pd1), pf1)
    s = state.select(F.col("model_name").alias("state_key"), "last_training_data_month",
                     "approved_feature_signature", "approved_model_signature", "approved_model_type")
    j = attach_scalars(candidates.join(s, "state_key", "left"), monitors)
    dqs, pds, pfs = (_norm_status(F.col("data_quality_status")), _norm_status(F.col("prediction_drift_status")),
                     _norm_status(F.col("performance_status")))
    fa = F.coalesce(F.col("feature_alert_count"), F.lit(0))
    fds = F.when(F.coalesce(F.col("feature_count"), F.lit(0)) == 0, "INSUFFICIENT_DATA").when(fa > 0, "ALERT") \
           .otherwise("PASS")
    new_month = F.col("last_training_data_month").isNull() | (F.col("current_data_month") > F.col("last_training_data_month"))
    feat_changed = F.col("approved_feature_signature").isNotNull() & (
        F.col("current_feature_signature") != F.col("approved_feature_signature"))
    model_changed = F.col("approved_model_signature").isNotNull() & (
        F.col("current_model_signature") != F.col("approved_model_signature"))
    why = reasons((dqs == "ALERT", "data_quality_alert"), (fa > 0, "feature_drift_alert"),
                  (pds == "ALERT", "prediction_drift_alert"), (pfs == "ALERT", "performance_degradation_alert"),
                  (new_month, "new_month_data"), (F.coalesce(feat_changed, F.lit(False)), "feature_set_changed"),
                  (F.coalesce(model_changed, F.lit(False)), "model_configuration_changed"))
    return j.select("state_key", "current_data_month", "last_training_data_month", "approved_model_type",
                    "current_model_type", dqs.alias("data_quality_status"), fds.alias("feature_drift_status"),
                    fa.cast("long").alias("feature_alert_count"), pds.alias("prediction_drift_status"),
                    pfs.alias("performance_status"), new_month.alias("new_month_available"),
                    F.coalesce(feat_changed, F.lit(False)).alias("feature_set_changed"),
                    F.coalesce(model_changed, F.lit(False)).alias("model_configuration_changed"),
                    why.alias("retrain_reasons"), (F.length(why) > 0).alias("should_retrain"))


# G3 -----------------------------------------------------------------------------
def retraining_dataset(features: DataFrame, feedback: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Latest non-null outcome per provider (date desc, created desc) joined to TEST features."""
    fb = feedback.where(F.col("confirmed_fraud").isNotNull()).select(
        "provider_id", "confirmed_fraud", "investigation_result", "investigator", "investigation_date", "run_id",
        "created_at", "investigation_id")
    latest = latest_per(fb, ["provider_id"], ["investigation_date", "created_at", "investigation_id"])
    f = features.where(F.col("dataset_split") == "TEST").select("provider_id", *cols)
    return f.join(latest, "provider_id", "inner").select(
        "provider_id", *cols, F.col("confirmed_fraud").cast("long").alias("fraud_label"), "investigation_result",
        "investigator", "investigation_date", F.col("run_id").alias("source_run_id"))


# G4 -----------------------------------------------------------------------------
def label_distribution(df: DataFrame, col: str = "fraud_label") -> DataFrame:
    """Row count per label value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("provider_count"))


# G5 -----------------------------------------------------------------------------
def _metric_wide(metrics: DataFrame, prefix: str) -> DataFrame:
    aggs = [F.max(F.when(F.col("metric_name") == m, F.col("metric_value"))).alias(f"{prefix}{m}") for m in GATE_METRICS]
    return metrics.where(F.col("metric_name").isin(*GATE_METRICS)).groupBy("run_id").agg(*aggs)


def promotion_gate(challengers: DataFrame, state: DataFrame, metrics: DataFrame,
                   thresholds: Mapping[str, float] = GATE) -> DataFrame:
    """Challenger vs champion metric deltas for many state keys at once.

    ``challengers``: state_key, challenger_run_id.  No champion -> bootstrap pass;
    missing metrics -> status ERROR (the reference raises) with the missing names.
    """
    ch = _metric_wide(metrics, "c_").withColumnRenamed("run_id", "challenger_run_id")
    cp = _metric_wide(metrics, "a_").withColumnRenamed("run_id", "approved_run_id")
    s = state.select(F.col("model_name").alias("state_key"), "approved_run_id")
    j = challengers.join(s, "state_key", "left").join(ch, "challenger_run_id", "left").join(cp, "approved_run_id", "left")
    miss = lambda p: reasons(*[(F.col(f"{p}{m}").isNull(), m) for m in sorted(GATE_METRICS)])
    d = {m: F.col(f"c_{m}") - F.col(f"a_{m}") for m in GATE_METRICS}
    checks = [(d["pr_auc"] < thresholds["min_pr_auc_improvement"], "pr_auc"),
              (d["precision"] < thresholds["min_precision_change"], "precision"),
              (d["recall"] < thresholds["min_recall_change"], "recall"),
              (d["f1_score"] < thresholds["min_f1_change"], "f1_score")]
    failed = reasons(*checks)
    no_champ = F.col("approved_run_id").isNull() | (F.col("approved_run_id") == "")
    status = (F.when(F.length(miss("c_")) > 0, "ERROR").when(no_champ, "BOOTSTRAP_PASS")
               .when(F.length(miss("a_")) > 0, "ERROR").when(F.length(failed) > 0, "FAIL").otherwise("PASS"))
    # Gate reason texts.
    reason = (F.when(F.length(miss("c_")) > 0, F.concat(F.lit("Challenger metrics are missing: "), miss("c_")))
               .when(no_champ, "No approved_run_id is recorded yet. Bootstrap promotion-gate pass; "
                               "manual approval is still required.")
               .when(F.length(miss("a_")) > 0, F.concat(F.lit("Champion metrics are missing: "), miss("a_")))
               .when(F.length(failed) > 0, F.concat(F.lit("Challenger failed promotion criteria: "),
                                                    F.regexp_replace(failed, ",", ", ")))
               .otherwise("Challenger satisfied all promotion criteria."))
    return j.select("state_key", "challenger_run_id", "approved_run_id",
                    *[d[m].alias(f"{m}_change") for m in GATE_METRICS],
                    F.when(status == "BOOTSTRAP_PASS", F.lit(None).cast("string")).otherwise(failed).alias("failed_checks"),
                    status.isin("PASS", "BOOTSTRAP_PASS").alias("eligible"), status.alias("gate_status"),
                    reason.alias("reason"))


# G6 -----------------------------------------------------------------------------
SNAPSHOT = ("model_resource", "run_id", "model_type", "feature_signature", "model_signature", "data_month",
            "training_timestamp")


def active_model(ledger: DataFrame) -> DataFrame:
    """Fold the PROMOTION/ROLLBACK log into the active model per state key
    (``to_*`` of the latest event; ties on event_time broken by event_id)."""
    ev = ledger.where(F.col("event_type").isin("PROMOTION", "ROLLBACK"))
    snap = F.struct(F.col("event_id"), F.col("event_type"), F.col("event_time"),
                    *[F.col(f"to_{c}").alias(c) for c in SNAPSHOT])
    agg = ev.groupBy("state_key").agg(F.max_by(snap, F.struct("event_time", "event_id")).alias("a"))
    return agg.select("state_key", F.col("a.event_id").alias("last_event_id"), F.col("a.event_type").alias("last_event_type"),
                      F.col("a.event_time").alias("last_event_time"), *[F.col(f"a.{c}").alias(c) for c in SNAPSHOT])


def checked_ledger(ledger: DataFrame) -> DataFrame:
    """G6 with optimistic locking: an event counts only if its ``from_*`` model is the active one at that time.

    The first event of a key starts its chain.  After an event that counts, the next one that counts is the
    first later event whose ``from_*`` is that event's ``to_*``: a pointer, found by an as-of join over
    (key, model, position) that splits a hot key.  The events that the first one reaches are found by
    pointer doubling, so a chain of n events takes about log2(n) joins and no task folds a whole key.

    Returns every PROMOTION and ROLLBACK event with ``accepted``, the run that was active before it
    (``active_run_id``; NULL before the first) and ``problem``.  Ties on event_time break by event_id; event ids are unique.
    """
    identity = lambda p: F.to_json(F.struct(F.col(f"{p}_model_resource").alias("m"), F.col(f"{p}_run_id").alias("r")))
    ev = ledger.where(F.col("event_type").isin("PROMOTION", "ROLLBACK")).select(
        "state_key", "event_id", "event_time", "event_type", "from_run_id", "to_run_id", identity("from").alias("__from"), identity("to").alias("__to"))
    ev = materialize(row_number_by(ev, ["state_key"], ["event_time", "event_id"], out="__rn"))
    # positions are negated: "the first later event" becomes "the latest one not after"
    left = ev.select("state_key", F.col("__to").alias("__model"), "__rn", (-F.col("__rn") - 1).alias("__at"))
    right = ev.select("state_key", F.col("__from").alias("__model"), (-F.col("__rn")).alias("__pos"), F.col("__rn").alias("__next"))
    jump = materialize(as_of_join(left, right, ["state_key", "__model"], "__at", "__pos", ["__next"])
                       .where(F.col("__next").isNotNull()).select("state_key", "__rn", "__next"))
    reached = ev.where(F.col("__rn") == 1).select("state_key", "__rn")
    while not jump.isEmpty():
        step = reached.join(jump, ["state_key", "__rn"]).select("state_key", F.col("__next").alias("__rn"))
        reached = materialize(reached.unionByName(step).distinct())
        onward = jump.select("state_key", F.col("__rn").alias("__next"), F.col("__next").alias("__far"))
        jump = materialize(jump.join(onward, ["state_key", "__next"]).select("state_key", "__rn", F.col("__far").alias("__next")))
    marked = ev.join(reached.withColumn("accepted", F.lit(True)), ["state_key", "__rn"], "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))
    marked = materialize(marked.withColumn("__before", F.col("__rn") - 1))
    held = marked.where("accepted").select("state_key", F.col("__rn").alias("__since"), F.col("to_run_id").alias("active_run_id"))
    seen = as_of_join(marked, held, ["state_key"], "__before", "__since", ["active_run_id"])
    # Fixed value: the message of an aborted change.
    problem = F.when(~F.col("accepted"), "Active model changed; event not applied")
    return seen.select("state_key", "event_id", "event_time", "event_type", "from_run_id", "to_run_id", "active_run_id", "accepted",
                       problem.alias("problem"))


def checked_active_model(ledger: DataFrame) -> DataFrame:
    """The active model per state key after the events that count, with the number of those that did not."""
    seen = checked_ledger(ledger)
    return seen.groupBy("state_key").agg(
        F.max_by("to_run_id", F.when(F.col("accepted"), F.struct("event_time", "event_id"))).alias("run_id"),
        F.max_by("event_id", F.when(F.col("accepted"), F.struct("event_time", "event_id"))).alias("last_event_id"),
        F.count_if(~F.col("accepted")).alias("rejected_events"))


# G7 -----------------------------------------------------------------------------
def previous_model(ledger: DataFrame, state: DataFrame) -> DataFrame:
    """Per state key, the latest release event leading to the approved model and
    its complete ``from_*`` snapshot; an incomplete snapshot is flagged, not guessed."""
    s = state.select(F.col("model_name").alias("state_key"), "approved_model_resource", "approved_run_id")
    ev = ledger.where(F.col("event_type").isin("PROMOTION", "ROLLBACK"))
    j = ev.join(s, (ev.state_key == s.state_key) & (ev.to_model_resource == s.approved_model_resource)
                & (ev.to_run_id == s.approved_run_id), "inner").drop(s.state_key)
    snap = F.struct("event_id", *[F.col(f"from_{c}").alias(c) for c in SNAPSHOT])
    agg = j.groupBy("state_key").agg(F.max_by(snap, F.struct("event_time", "event_id")).alias("p"))
    required = ["model_resource", "run_id", "model_type", "feature_signature", "model_signature", "training_timestamp"]
    complete = None
    for c in required:
        x = F.col(f"p.{c}").isNotNull() & (F.col(f"p.{c}").cast("string") != "")
        complete = x if complete is None else complete & x
    out = s.join(agg, "state_key", "left")
    return out.select("state_key", F.col("p.event_id").alias("event_id"),
                      *[F.col(f"p.{c}").alias(c) for c in SNAPSHOT],
                      F.coalesce(complete, F.lit(False)).alias("snapshot_complete"),
                      F.when(F.col("p.event_id").isNull(), "No release transition leading to active model")
                       .when(~complete, "Previous production model lacks a complete approval snapshot")
                       .alias("problem"))


# G8 -----------------------------------------------------------------------------
def rollback_eligibility(ledger: DataFrame, state: DataFrame, supported: Sequence[str] = SUPPORTED_TYPES) -> DataFrame:
    """Every historical PROMOTION target checked for rollback; first failing rule is the reason."""
    t = ledger.where(F.col("event_type") == "PROMOTION").select(
        "state_key", "event_id", "event_time", *[F.col(f"to_{c}").alias(c) for c in SNAPSHOT])
    s = state.select(F.col("model_name").alias("state_key"), "approved_model_resource", "candidate_status")
    j = t.join(s, "state_key", "left")
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    # Rollback validation messages.
    reason = (F.when(~F.col("model_type").isin(*supported), "Unsupported approved model type")
               .when(empty("run_id") | empty("model_resource"), "Approval history missing model or run identity")
               .when(empty("feature_signature") | empty("model_signature"), "Approval history missing model signatures")
               .when(empty("training_timestamp"), "Approval history missing original training timestamp")
               .when(F.col("model_resource") == F.col("approved_model_resource"), "Target is already the active approved model")
               .when(F.coalesce(F.col("candidate_status"), F.lit("")) == PENDING, "Resolve pending approval before rollback"))
    return j.select("state_key", "event_id", "event_time", "model_resource", "run_id", "model_type",
                    reason.isNull().alias("eligible"), reason.alias("reason"))


# G9 -----------------------------------------------------------------------------
def promotion_history(ledger: DataFrame, n: int = 50) -> DataFrame:
    """Newest ``n`` PROMOTION events per state key."""
    p = ledger.where(F.col("event_type") == "PROMOTION").select(
        "state_key", "event_id", "event_time", "to_run_id", "to_model_type", "to_model_resource")
    return top_k_per_group(p, ["state_key"], [F.col("event_time").desc(), F.col("event_id").desc()], n,
                           rank_col="history_rank")


# G10 ----------------------------------------------------------------------------
def pending_candidates(state: DataFrame) -> DataFrame:
    """Readiness of each key's pending candidate; the first missing field is the reason."""
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    reason = (F.when(F.coalesce(F.col("candidate_status"), F.lit("")) != PENDING,
                     F.concat(F.lit("No candidate is waiting for approval. Current status: "),
                              F.coalesce(F.col("candidate_status"), F.lit("None"))))
               .when(F.col("candidate_data_month").isNull(), "Pending candidate does not have candidate_data_month.")
               .when(empty("candidate_model_type"), "Pending candidate does not have candidate_model_type.")
               .when(empty("candidate_model_signature"), "Pending candidate does not have candidate_model_signature.")
               .when(empty("candidate_feature_signature"), "Pending candidate does not have candidate_feature_signature.")
               .when(empty("candidate_model_resource"), "Pending candidate does not have candidate_model_resource.")
               .when(empty("candidate_run_id"), "Pending candidate does not have candidate_run_id."))
    return state.select(F.col("model_name").alias("state_key"), "candidate_status", "candidate_data_month",
                        "candidate_model_type", "candidate_run_id", "candidate_model_resource",
                        reason.isNull().alias("ready_for_approval"), reason.alias("reason"))


# G11 ----------------------------------------------------------------------------
STATE_COPY = {"last_training_data_month": "candidate_data_month",
              "approved_feature_signature": "candidate_feature_signature",
              "approved_model_signature": "candidate_model_signature", "approved_model_type": "candidate_model_type",
              "approved_model_resource": "candidate_model_resource", "approved_run_id": "candidate_run_id"}


def approve_candidates(state: DataFrame, approvals: DataFrame) -> DataFrame:
    """Apply approvals (state_key, candidate_data_month, candidate_run_id,
    candidate_model_resource, approved_at) to pending rows whose candidate still
    matches; other rows are untouched.  Returns the new state plus ``changed``."""
    a = approvals.select(F.col("state_key").alias("model_name"), F.col("candidate_data_month").alias("__m"),
                         F.col("candidate_run_id").alias("__r"), F.col("candidate_model_resource").alias("__res"),
                         F.col("approved_at").alias("__at"))
    j = state.join(a, "model_name", "left")
    hit = (F.coalesce(F.col("candidate_status") == PENDING, F.lit(False))
           & F.coalesce(F.col("candidate_data_month") == F.col("__m"), F.lit(False))
           & F.coalesce(F.col("candidate_run_id") == F.col("__r"), F.lit(False))
           & F.coalesce(F.col("candidate_model_resource") == F.col("__res"), F.lit(False)))
    cols = []
    for c in state.columns:
        if c in STATE_COPY:
            cols.append(F.when(hit, F.col(STATE_COPY[c])).otherwise(F.col(c)).alias(c))
        elif c == "last_training_timestamp":
            cols.append(F.when(hit, F.col("__at").cast("timestamp")).otherwise(F.col(c)).alias(c))
        elif c == "candidate_status":
            cols.append(F.when(hit, F.lit(APPROVED)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols, hit.alias("changed"))
