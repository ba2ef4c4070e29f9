"""Data-quality, feature-drift and prediction-drift monitors.

Scale notes: every monitor is one scan with all per-feature counters folded
into a single ``agg`` (or one ``groupBy`` over unpivoted rows), so cost is one
pass regardless of the feature count.  Run resolution works on the run table
(one row per run after a partial aggregate), never on prediction rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach_scalars, count_if
from ..functions.ranking import materialize, quantile_disc

# Per-feature validation rules (inclusive bounds) of the monitoring config.
DEFAULT_RULES: dict[str, dict] = {
    "high_acuity_pct": {"min": 0, "max": 1},
    "pct_99214": {"min": 0, "max": 1},
    "pct_99215": {"min": 0, "max": 1},
    "referral_rate": {"min": 0, "max": 1},
    "eye_procedure_pct": {"min": 0, "max": 1},
    "avg_paid_per_claim": {"min": 0},
    "high_acuity_oe_ratio": {"min": 0},
    "avg_member_provider_distance": {"min": 0},
}


def _ts(ts: dt.datetime | str | None) -> Column:
    if ts is None:
        raise ValueError("pass the monitoring timestamp explicitly (no hidden now())")
    return F.lit(ts).cast("timestamp")


def _rule_conditions(features: Sequence[str], rules: Mapping[str, Mapping]) -> tuple[list[Column], list[Column]]:
    """Null and out-of-range predicates per feature; a missing rule fails closed."""
    nulls, invalid = [], []
    for f in features:
        rule = rules.get(f)
        if not isinstance(rule, Mapping):
            raise ValueError(f"Missing quality rule for feature: {f}")
        if not rule.get("allow_null", False):
            nulls.append(F.col(f).isNull())
        conds = []
        for key, op in (("min", "lt"), ("max", "gt")):
            if key in rule:
                b = rule[key]
                if isinstance(b, bool) or not isinstance(b, (int, float)):
                    raise ValueError(f"Non-numeric {key} for {f}")
                conds.append(F.col(f) < b if op == "lt" else F.col(f) > b)
        if conds:
            c = conds[0]
            for x in conds[1:]:
                c = c | x
            invalid.append(c)
    return nulls, invalid


def _sum_counts(conds: Sequence[Column]) -> Column:
    if not conds:
        return F.lit(0).cast("long")
    tot = count_if(conds[0])
    for c in conds[1:]:
        tot = tot + count_if(c)
    return tot


# M1 ---------------------------------------------------------------------------
def data_quality(features: DataFrame, rules: Mapping[str, Mapping] = DEFAULT_RULES,
                 feature_cols: Sequence[str] | None = None, split: str | None = "TEST",
                 model_name: str = "provider_fraud_model", monitoring_ts=None,
                 group_by: Sequence[str] = ()) -> DataFrame:
    """M1: rows, providers, duplicates, NULL and out-of-range counts, ALERT/PASS.

    ``group_by`` evaluates many snapshots/datasets in the same single pass.
    """
    cols = list(feature_cols or rules.keys())
    nulls, invalid = _rule_conditions(cols, rules)
    df = features.where(F.col("dataset_split") == split) if split else features
    g = df.groupBy(*group_by) if group_by else df
    agg = g.agg(F.count(F.lit(1)).alias("total_rows"),
                F.count_distinct("provider_id").alias("unique_providers"),
                _sum_counts(nulls).alias("null_feature_values"),
                _sum_counts(invalid).alias("invalid_feature_values"))
    dup = F.coalesce(F.col("total_rows") - F.col("unique_providers"), F.lit(0))
    status = (F.when(F.col("total_rows") == 0, "ALERT").when(dup > 0, "ALERT")
               .when(F.coalesce("null_feature_values", F.lit(0)) > 0, "ALERT")
               .when(F.coalesce("invalid_feature_values", F.lit(0)) > 0, "ALERT").otherwise("PASS"))
    ts = [_ts(monitoring_ts).alias("monitoring_timestamp")] if not group_by else [F.col(c) for c in group_by]
    return agg.select(*ts, F.lit(model_name).alias("model_name"), F.lit(split or "ALL").alias("dataset_name"),
                      "total_rows", "unique_providers", dup.cast("long").alias("duplicate_rows"),
                      F.coalesce("null_feature_values", F.lit(0)).cast("long").alias("null_feature_values"),
                      F.coalesce("invalid_feature_values", F.lit(0)).cast("long").alias("invalid_feature_values"),
                      status.alias("monitoring_status"))


# M2 ---------------------------------------------------------------------------
def quality_by_column(features: DataFrame, rules: Mapping[str, Mapping] = DEFAULT_RULES,
                      feature_cols: Sequence[str] | None = None) -> DataFrame:
    """M2: NULL and invalid counts per feature (one scan, then unpivot)."""
    cols = list(feature_cols or rules.keys())
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.count_distinct("provider_id").alias("unique_providers"),
            count_if(F.col("provider_id").isNull()).alias("null_provider_id")]
    for f in cols:
        n, inv = _rule_conditions([f], {f: {**rules[f], "allow_null": False}} if f in rules else {})
        aggs += [count_if(n[0]).alias(f"n__{f}"),
                 (count_if(inv[0]) if inv else F.lit(0).cast("long")).alias(f"i__{f}")]
    wide = features.agg(*aggs)
    parts = [F.struct(F.lit(f).alias("feature_name"), F.col(f"n__{f}").alias("null_count"),
                      F.col(f"i__{f}").alias("invalid_count")) for f in cols]
    return wide.select("total_rows", "unique_providers", "null_provider_id",
                       F.explode(F.array(*parts)).alias("r")).select(
        "r.feature_name", "total_rows", "unique_providers", "null_provider_id", "r.null_count", "r.invalid_count")


# M3 ---------------------------------------------------------------------------
def data_quality_expected(features: DataFrame, expected_rows: int | DataFrame, rules: Mapping[str, Mapping] = DEFAULT_RULES,
                          feature_cols: Sequence[str] | None = None, model_name: str = "isolation_forest",
                          monitoring_ts=None) -> DataFrame:
    """M3: strict quality of a batch input with an expected row count -> FAIL/PASS.

    ``expected_rows``: a number, or a 1-row frame with a column ``expected_rows``.
    """
    cols = list(feature_cols or rules.keys())
    nulls, invalid = _rule_conditions(cols, rules)
    agg = features.agg(F.count(F.lit(1)).alias("total_rows"),
                       F.count_distinct("provider_id").alias("unique_providers"),
                       _sum_counts(nulls).alias("null_feature_values"),
                       _sum_counts(invalid).alias("invalid_feature_values"))
    dup = F.col("total_rows") - F.col("unique_providers")
    if isinstance(expected_rows, DataFrame):
        agg, want = attach_scalars(agg, expected_rows), F.col("expected_rows")
    else:
        want = F.lit(expected_rows)
    status = (F.when(F.col("total_rows") != want, "FAIL").when(dup > 0, "FAIL")
               .when(F.col("null_feature_values") > 0, "FAIL").when(F.col("invalid_feature_values") > 0, "FAIL")
               .otherwise("PASS"))
    return agg.select(_ts(monitoring_ts).alias("monitoring_timestamp"), F.lit(model_name).alias("model_name"),
                      F.lit("TEST").alias("dataset_name"), "total_rows", "unique_providers",
                      dup.alias("duplicate_rows"), "null_feature_values", "invalid_feature_values",
                      status.alias("data_quality_status"))


# M4 / M5 ------------------------------------------------------------------------
def _drift_stats(baseline: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One shuffle: stack both populations as (population, feature, value), drop
    NULL values (UNPIVOT semantics), aggregate conditionally per feature."""
    if not cols:
        raise ValueError("no feature columns")
    stack = lambda df, pop: df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature_name", "v").where(F.col("v").isNotNull()).withColumn("pop", F.lit(pop))
    long = stack(baseline, "B").unionByName(stack(current, "C"))
    b, c = F.col("pop") == "B", F.col("pop") == "C"
    agg = long.groupBy("feature_name").agg(
        F.avg(F.when(b, F.col("v"))).alias("baseline_mean"),
        F.avg(F.when(c, F.col("v"))).alias("current_mean"),
        F.stddev_samp(F.when(b, F.col("v"))).alias("baseline_std"),
        count_if(b).alias("__nb"), count_if(c).alias("__nc"))
    # inner-join semantics of the reference: a feature needs rows on both sides
    agg = agg.where((F.col("__nb") > 0) & (F.col("__nc") > 0))
    shift = F.try_divide(F.abs(F.col("current_mean") - F.col("baseline_mean")), F.nullif(F.col("baseline_std"), F.lit(0.0)))
    return agg.select("feature_name", "baseline_mean", "current_mean", "baseline_std",
                      shift.alias("standardized_mean_shift"))


def feature_drift(features: DataFrame, cols: Sequence[str], alert: float = 1.0,
                  model_name: str = "provider_fraud_model", monitoring_ts=None) -> DataFrame:
    """M4: TRAIN vs TEST standardized mean shift per feature; ALERT when >= ``alert``."""
    s = _drift_stats(features.where(F.col("dataset_split") == "TRAIN"),
                     features.where(F.col("dataset_split") == "TEST"), cols)
    return s.select(_ts(monitoring_ts).alias("monitoring_timestamp"), F.lit(model_name).alias("model_name"), "*",
                    F.when(F.col("standardized_mean_shift") >= alert, "ALERT").otherwise("PASS").alias("monitoring_status"))


def feature_drift_levels(baseline: DataFrame, current: DataFrame, cols: Sequence[str], warn: float = 0.5,
                         fail: float = 1.0, model_name: str = "isolation_forest", monitoring_ts=None) -> DataFrame:
    """M5: baseline table vs a separate current table; FAIL / WARNING / PASS."""
    if warn > fail:
        raise ValueError("warn must be <= fail")
    s = _drift_stats(baseline, current, cols)
    st = (F.when(F.col("standardized_mean_shift") >= fail, "FAIL")
           .when(F.col("standardized_mean_shift") >= warn, "WARNING").otherwise("PASS"))
    return s.select(_ts(monitoring_ts).alias("monitoring_timestamp"), F.lit(model_name).alias("model_name"), "*",
                    st.alias("drift_status"))


# M6 ---------------------------------------------------------------------------
def score_runs(preds: DataFrame) -> DataFrame:
    """Run table: one row per (model, version, run) with its latest created_at."""
    return (preds.where(F.col("fraud_score").isNotNull())
                 .groupBy("model_name", "model_version", "run_id")
                 .agg(F.max("created_at").alias("run_created_at")))


def resolve_score_runs(preds: DataFrame) -> DataFrame:
    """M6: CURRENT = latest scored run overall; BASELINE = latest other run of the same
    model_version.  Ties on created_at break by (model_name, run_id) descending.

    Both picks are ``max_by`` aggregates over the run table (one row per run).
    """
    runs = score_runs(preds)
    row = F.struct("model_name", "model_version", "run_id", "run_created_at")
    key = F.struct("run_created_at", "model_name", "run_id")
    cur = runs.agg(F.max_by(row, key).alias("r")).select("r.*").where(F.col("run_id").isNotNull())
    c = cur.select(F.col("model_version").alias("__v"), F.col("run_id").alias("__r"))
    others = runs.join(F.broadcast(c), (runs.model_version == c.__v) & (runs.run_id != c.__r), "inner").drop("__v", "__r")
    base = others.agg(F.max_by(row, key).alias("r")).select("r.*").where(F.col("run_id").isNotNull())
    return (cur.withColumn("role", F.lit("CURRENT"))
               .unionByName(base.withColumn("role", F.lit("BASELINE")))
               .select("role", "model_name", "model_version", "run_id", "run_created_at"))


def _population_scores(preds: DataFrame, runs: DataFrame) -> DataFrame:
    # runs has <= 2 rows (CURRENT, BASELINE): broadcast is size-safe
    r = F.broadcast(runs.select(F.col("role").alias("population"), "run_id", "model_version"))
    return (preds.where(F.col("fraud_score").isNotNull())
                 .join(r, ["run_id", "model_version"], "inner")
                 .select("population", "fraud_score"))


# M7 ---------------------------------------------------------------------------
def score_summary(preds: DataFrame, runs: DataFrame | None = None, scores: DataFrame | None = None) -> DataFrame:
    """M7: row count, mean and p50/p90/p95 (exact discrete) per population."""
    if scores is None:
        runs = runs if runs is not None else resolve_score_runs(preds)
        scores = _population_scores(preds, runs)
    s = scores
    moments = s.groupBy("population").agg(F.count(F.lit(1)).alias("row_count"), F.avg("fraud_score").alias("mean_score"))
    qs = quantile_disc(s, ["population"], "fraud_score", [0.5, 0.9, 0.95], ["p50", "p90", "p95"])
    return moments.join(qs, "population", "left")


# M8 ---------------------------------------------------------------------------
def psi(preds: DataFrame, runs: DataFrame | None = None, buckets: int = 10, floor_rate: float = 0.0001,
        scores: DataFrame | None = None) -> DataFrame:
    """M8: population stability index over ``buckets`` fixed score buckets.

    One ``groupBy(population, bucket)`` (partial aggregation), pivoted to one
    row per bucket and joined to the full bucket list (a ``sequence`` of
    ``buckets`` values).  Scores below 0 fall in no bucket, as in the reference;
    they are reported as ``unbucketed_rows``.
    """
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    if scores is None:
        runs = runs if runs is not None else resolve_score_runs(preds)
        scores = _population_scores(preds, runs)
    s = scores
    bucket = F.least(F.floor(F.col("fraud_score") * buckets).cast("int"), F.lit(buckets - 1))
    counts = s.groupBy("population", bucket.alias("score_bucket")).agg(F.count(F.lit(1)).alias("bucket_count"))
    totals = counts.groupBy("population").agg(F.sum("bucket_count").alias("row_count"))
    rates = counts.join(totals, "population").select(
        "population", "score_bucket", F.try_divide(F.col("bucket_count"), F.col("row_count")).alias("bucket_rate"))
    wide = rates.groupBy("score_bucket").agg(
        F.max(F.when(F.col("population") == "BASELINE", F.col("bucket_rate"))).alias("b"),
        F.max(F.when(F.col("population") == "CURRENT", F.col("bucket_rate"))).alias("c"))
    all_b = s.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("score_bucket"))
    j = all_b.join(wide, "score_bucket", "left")
    c = F.greatest(F.coalesce(F.col("c"), F.lit(0.0)), F.lit(floor_rate))
    b = F.greatest(F.coalesce(F.col("b"), F.lit(0.0)), F.lit(floor_rate))
    neg = counts.where(F.col("score_bucket") < 0).agg(F.coalesce(F.sum("bucket_count"), F.lit(0)).cast("long").alias("unbucketed_rows"))
    return attach_scalars(j.agg(F.sum((c - b) * F.ln(F.try_divide(c, b))).alias("population_stability_index")), neg)


# M9 ---------------------------------------------------------------------------
def prediction_drift(preds: DataFrame, monitoring_ts=None, psi_alert: float = 0.20, psi_watch: float = 0.10,
                     mean_alert: float = 0.10) -> DataFrame:
    """M9: drift report of the current vs baseline run with status and reason."""
    ts = _ts(monitoring_ts)
    # the run table and the two score populations feed four branches: compute once
    runs = materialize(resolve_score_runs(preds))
    scores = materialize(_population_scores(preds, runs))
    summ = score_summary(preds, runs, scores)
    p = psi(preds, runs, scores=scores).select("population_stability_index")
    cur = runs.where(F.col("role") == "CURRENT").select("model_name", "model_version", F.col("run_id").alias("current_run_id"))
    base = runs.where(F.col("role") == "BASELINE").select(F.col("model_version").alias("__bv"), F.col("run_id").alias("baseline_run_id"))
    bs = summ.where(F.col("population") == "BASELINE").select(*[F.col(c).alias(f"b_{c}") for c in summ.columns])
    cs = summ.where(F.col("population") == "CURRENT").select(*[F.col(c).alias(f"c_{c}") for c in summ.columns])
    f = cur.join(base, cur.model_version == base.__bv, "left")
    # 1-row global aggregates (NULLs when a population is absent) = LEFT JOIN ON TRUE
    for one in (bs.agg(*[F.max(c).alias(c) for c in bs.columns]), cs.agg(*[F.max(c).alias(c) for c in cs.columns]), p):
        f = attach_scalars(f, one)
    shift = F.abs(F.col("c_mean_score") - F.col("b_mean_score"))
    psi_c = F.col("population_stability_index")
    status = (F.when(F.col("baseline_run_id").isNull(), "INSUFFICIENT_DATA")
               .when((F.col("b_row_count") == 0) | (F.col("c_row_count") == 0), "INSUFFICIENT_DATA")
               .when(psi_c >= psi_alert, "ALERT").when(shift >= mean_alert, "ALERT")
               .when(psi_c >= psi_watch, "WATCH").otherwise("PASS"))
    # Alert reason texts of the prediction-drift monitor.
    reason = (F.when(F.col("baseline_run_id").isNull(), "No previous scored run exists for the same model version.")
               .when(psi_c >= psi_alert, f"Prediction score PSI exceeded {psi_alert:.2f}.")
               .when(shift >= mean_alert, f"Mean fraud score shifted by at least {mean_alert:.2f}.")
               .when(psi_c >= psi_watch, "Prediction score PSI is in the watch range.")
               .otherwise("Prediction score distribution is stable."))
    return f.select(ts.alias("check_date"), ts.alias("monitoring_timestamp"), "model_name", "model_version",
                    "baseline_run_id", "current_run_id", F.col("b_row_count").alias("baseline_count"),
                    F.col("c_row_count").alias("current_count"), F.col("b_mean_score").alias("baseline_mean_score"),
                    F.col("c_mean_score").alias("current_mean_score"), shift.alias("mean_score_shift"),
                    F.col("b_p50").alias("baseline_p50"), F.col("c_p50").alias("current_p50"),
                    F.col("b_p90").alias("baseline_p90"), F.col("c_p90").alias("current_p90"),
                    F.col("b_p95").alias("baseline_p95"), F.col("c_p95").alias("current_p95"),
                    psi_c, status.alias("status"), reason.alias("alert_reason"))


# M10 / M11 ------------------------------------------------------------------------
def positive_rate_drift(raw: DataFrame, positive: str = "-1", negative: str = "1", baseline: float = 0.10,
                        warn: float = 0.05, fail: float = 0.15, group_by: Sequence[str] = (),
                        model_name: str = "isolation_forest", monitoring_ts=None) -> DataFrame:
    """Share of the positive class vs a fixed baseline rate; FAIL / WARNING / PASS."""
    g = raw.groupBy(*group_by) if group_by else raw
    agg = g.agg(F.count(F.lit(1)).alias("total_predictions"),
                count_if(F.col("prediction") == positive).alias("positive_count"),
                count_if(F.col("prediction") == negative).alias("negative_count"))
    rate = F.try_divide(F.col("positive_count"), F.col("total_predictions"))
    change = F.abs(rate - F.lit(baseline))
    status = F.when(change >= fail, "FAIL").when(change >= warn, "WARNING").otherwise("PASS")
    lead = [F.col(c) for c in group_by] if group_by else [_ts(monitoring_ts).alias("monitoring_timestamp")]
    return agg.select(*lead, F.lit(model_name).alias("model_name"), "total_predictions", "positive_count",
                      "negative_count", rate.alias("positive_rate"), F.lit(baseline).alias("baseline_rate"),
                      change.alias("rate_change"), status.alias("monitoring_status"))


def prediction_counts(raw: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Raw predicted class distribution."""
    return raw.groupBy(*group_by, "prediction").agg(F.count(F.lit(1)).alias("count"))


# M12 ---------------------------------------------------------------------------
def latest_run_rows(history: DataFrame, ts: str = "monitoring_timestamp", n: int | None = None) -> DataFrame:
    """Rows of the latest monitor run (``ts = MAX(ts)``, a broadcast 1-row
    semi-join), or the newest ``n`` rows when ``n`` is given (top-k)."""
    if n is not None:
        if n < 1:
            raise ValueError("n must be >= 1")
        return history.orderBy(F.col(ts).desc(), *[F.col(c) for c in history.columns if c != ts]).limit(n)
    mx = history.agg(F.max(ts).alias("__mx"))
    return history.join(F.broadcast(mx), F.col(ts) == F.col("__mx"), "left_semi")


def latest_stored_rows(history: DataFrame, date_col: str, ts: str = "monitoring_timestamp") -> DataFrame:
    """M12 on a history partitioned by ``date_col``: the newest date is read off the partitions, and its files alone are scanned.

    The newest date is a scalar subquery over the partition column, which reads no data column; as a
    partition filter it is evaluated before the scan, so older files are not opened however long the history is.
    """
    newest = history.agg(F.max(date_col)).scalar()
    return latest_run_rows(history.where(F.col(date_col) == newest), ts)
