"""Validation and profiling operators.

Every operator is a single aggregation pass (or two stacked hash aggregates);
wide column lists are folded into one ``agg`` and turned long with ``unpivot``
afterwards, so a 50-column profile is one scan, not fifty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import attach_scalars, count_if, flag_rate, money_avg, pct2
from ..functions.ranking import materialize, quantile_cont, top_k

FLAG_COLS = ["is_high_acuity_em", "is_99214", "is_99215", "is_referral", "is_eye_procedure"]
# Metric labels of the overall behaviour report.
BEHAVIOUR_LABELS = {
    "is_high_acuity_em": "High Acuity Rate",
    "is_99214": "99214 Rate",
    "is_99215": "99215 Rate",
    "is_referral": "Referral Rate",
    "is_eye_procedure": "Eye Procedure Rate",
}
PCT_COLS = ["high_acuity_pct", "pct_99214", "pct_99215", "referral_rate", "eye_procedure_pct"]
SUMMARY_FEATURES = ["total_claims", "unique_members", "high_acuity_pct", "pct_99214", "pct_99215",
                    "referral_rate", "eye_procedure_pct", "avg_billed_per_claim", "avg_allowed_per_claim",
                    "avg_paid_per_claim", "total_paid"]
SEPARABILITY_FEATURES = ["high_acuity_pct", "pct_99215", "referral_rate", "eye_procedure_pct",
                         "avg_paid_per_claim", "avg_member_provider_distance"]


def _need(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


# V1
def load_counts(claims: DataFrame, approx: bool = False) -> DataFrame:
    """V1: rows, distinct providers, distinct members (exact, or HLL++ sketches)."""
    cd = F.approx_count_distinct if approx else F.count_distinct
    return claims.agg(F.count(F.lit(1)).alias("total_claims"),
                      cd("provider_id").alias("total_providers"),
                      cd("member_id").alias("total_members"))


# V2
def split_summary(claims: DataFrame, split_col: str = "dataset_split") -> DataFrame:
    """V2: date range, claims, providers, members per split."""
    _need(claims, [split_col, "service_date", "provider_id", "member_id"])
    return claims.groupBy(split_col).agg(
        F.min("service_date").alias("min_service_date"), F.max("service_date").alias("max_service_date"),
        F.count(F.lit(1)).alias("claim_count"), F.count_distinct("provider_id").alias("provider_count"),
        F.count_distinct("member_id").alias("member_count"))


# V3
def cohort_rate(claims: DataFrame, flag: str) -> DataFrame:
    """V3: total rows, flagged rows and ROUND(100 * AVG(flag), 2)."""
    _need(claims, [flag])
    agg = claims.agg(F.count(F.lit(1)).alias("total_claims"),
                     F.sum(flag).cast("long").alias("flag_claims"),
                     F.count(flag).alias("__n"))
    return agg.select("total_claims", "flag_claims", pct2("flag_claims", "__n").alias("flag_pct"))


# V4
def prefix_distribution(claims: DataFrame, col: str, n: int = 1) -> DataFrame:
    """V4: row count by the first ``n`` characters of ``col``."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return (claims.groupBy(F.substring(F.col(col).cast("string"), 1, n).alias("prefix"))
                  .agg(F.count(F.lit(1)).alias("claim_count")))


# V5
def dimension_distribution(claims: DataFrame, dims: Sequence[str]) -> DataFrame:
    """V5: claims and distinct providers per value of each dimension, in one pass.

    The dimensions are stacked (one row per claim and dimension) and aggregated
    by (dimension, value); the distinct-provider count is a partial aggregate too.
    """
    _need(claims, list(dims))
    long = claims.select("provider_id", *[F.col(d).cast("string").alias(d) for d in dims]).unpivot(
        ["provider_id"], list(dims), "dimension", "value")
    return long.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("claim_count"),
                                                  F.count_distinct("provider_id").alias("provider_count"))


# V6
def null_profile(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """V6: missing count and percent for each column (one scan), worst first."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column_name", "missing_count")
    out = long.select("column_name", F.col("missing_count").cast("long").alias("missing_count"),
                      pct2("missing_count", "__rows").alias("missing_pct"))
    if only_missing:
        out = out.where(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_count"), "column_name")


# V7
def duplicate_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """V7: rows beyond the first for each key value (partial aggregation per key)."""
    keys = [key] if isinstance(key, str) else list(key)
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    return per.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
                   count_if(F.col("__c") > 1).alias("duplicated_keys"))


# V8
def value_share(df: DataFrame, col: str) -> DataFrame:
    """V8: value counts with percent of all rows.

    The total is the sum of the counts (one scan), a 1-row frame joined as a broadcast,
    not a ``sum() over ()`` window (which would pull every group into one task).
    """
    counts = materialize(df.groupBy(col).agg(F.count(F.lit(1)).alias("claim_count")))
    total = counts.agg(F.sum("claim_count").alias("__total"))
    return attach_scalars(counts, total).select(
        col, "claim_count", pct2("claim_count", "__total").alias("claim_pct"))


# V9
def behaviour_metrics(claims: DataFrame, labels: dict[str, str] = BEHAVIOUR_LABELS) -> DataFrame:
    """V9: overall flag rates in long form (metric, value_pct)."""
    wide = claims.agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).cast("long").alias(c) for c in labels])
    long = wide.unpivot(["__n"], list(labels), "flag", "k")
    label = F.coalesce(*[F.when(F.col("flag") == c, F.lit(v)) for c, v in labels.items()])
    return long.select(label.alias("metric"), pct2("k", "__n").alias("value_pct"))


# V10
def provider_summary(claims: DataFrame, keys: Sequence[str] = ("provider_id", "provider_city", "provider_state")
                     ) -> DataFrame:
    """16 exploratory measures per provider."""
    aggs = [F.count(F.lit(1)).alias("total_claims"), F.count_distinct("member_id").alias("unique_members")]
    for flag, n_name, p_name in [("is_high_acuity_em", "high_acuity_claims", "high_acuity_pct"),
                                 ("is_99214", "claims_99214", "pct_99214"),
                                 ("is_99215", "claims_99215", "pct_99215"),
                                 ("is_referral", "referral_count", "referral_rate"),
                                 ("is_eye_procedure", "eye_procedure_claims", "eye_procedure_pct")]:
        aggs += [F.sum(flag).cast("long").alias(n_name), flag_rate(flag).alias(p_name)]
    aggs += [money_avg("total_billed_amt").alias("avg_billed_per_claim"),
             money_avg("total_allowed_amt").alias("avg_allowed_per_claim"),
             money_avg("total_paid_amount").alias("avg_paid_per_claim"),
             F.sum("total_paid_amount").cast("decimal(18,2)").alias("total_paid")]
    return claims.groupBy(*keys).agg(*aggs)


def members_of_windows(pairs: DataFrame, months: int, num_partitions: int) -> DataFrame:
    """V10 over time: distinct members of a provider's trailing ``months`` for each month end with a row.

    ``pairs``: distinct (provider_id, member_id, month_end).  A member's months are in order, so each adds the
    windows up to the member's next month only: a member enters a window once, and windows are running sums of entries
    and exits per (provider, month).  No pair is repeated per window.
    """
    if months < 1:
        raise ValueError("months must be >= 1")
    known = pairs.where(F.col("provider_id").isNotNull() & F.col("month_end").isNotNull())
    seen = Window.partitionBy("provider_id", "member_id").orderBy("month_end")
    gone = F.last_day(F.add_months("month_end", months))  # the first window without this month
    until = F.least(gone, F.coalesce(F.lead("month_end").over(seen), gone))
    # a member that is not known counts for no window, but its month is asked for
    one = F.when(F.col("member_id").isNotNull(), 1).otherwise(0)
    spans = known.repartition(num_partitions, "provider_id", "member_id").select(
        "provider_id", "month_end", until.alias("until"), one.alias("n"))
    steps = F.inline(F.array(F.struct(F.col("month_end"), F.col("n"), F.lit(1).alias("asked")),
                             F.struct(F.col("until").alias("month_end"), (-F.col("n")).alias("n"), F.lit(0).alias("asked"))))
    per_month = spans.select("provider_id", steps).groupBy("provider_id", "month_end").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    running = Window.partitionBy("provider_id").orderBy("month_end").rowsBetween(Window.unboundedPreceding, 0)
    return (per_month.withColumn("unique_members", F.sum("n").over(running).cast("long")).where(F.col("asked") == 1)
            .select("provider_id", "month_end", "unique_members"))


# V11
def top_providers(summary: DataFrame, col: str, n: int = 10, id_col: str = "provider_id",
                  pct_cols: Sequence[str] = ()) -> DataFrame:
    """Top-n providers by ``col`` (ties by id); percent columns scaled by 100.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps n rows.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    top = top_k(summary, [F.col(col).desc_nulls_last(), F.col(id_col)], n)
    return top.select(*[(F.col(c) * 100).alias(c) if c in pct_cols else F.col(c) for c in top.columns])


# V12
def describe_features(df: DataFrame, cols: Sequence[str], pcts: Sequence[float] = (0.25, 0.5, 0.75),
                      group_by: Sequence[str] = ()) -> DataFrame:
    """count/mean/std/min/percentiles/max per feature (and group), long form.

    Moments come from one aggregate over the stacked (feature, value) rows;
    percentiles use the exact distributed ``quantile_cont``.
    """
    _need(df, [*group_by, *cols])
    g = list(group_by)
    long = df.select(*g, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        g, list(cols), "feature", "value")
    long = materialize(long)  # feeds moments and quantiles; never recompute the source twice
    keys = [*g, "feature"]
    moments = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    names = [f"p{int(round(q * 100))}" for q in pcts]
    qs = quantile_cont(long, keys, "value", list(pcts), names)
    return moments.join(qs, keys, "left").select(*keys, "count", "mean", "std", "min", *names, "max")


# V13
def snapshot_uniqueness(features: DataFrame, split_col: str = "dataset_split",
                        ts_col: str = "feature_timestamp") -> DataFrame:
    """Rows vs distinct providers per split and the snapshot timestamp."""
    return features.groupBy(split_col).agg(F.count(F.lit(1)).alias("provider_rows"),
                                           F.count_distinct("provider_id").alias("providers"),
                                           F.min(ts_col).alias("feature_timestamp"))


# V14
def cohort_assertions(claims: DataFrame, rules: Sequence[tuple[str, str, object]]) -> DataFrame:
    """PASS when a column holds exactly one value equal to the expectation, else WARNING.

    ``rules`` = [(check_name, column, expected_value)]; one aggregate for all rules.
    """
    if not rules:
        raise ValueError("no rules")
    aggs = []
    for i, (_, c, _) in enumerate(rules):
        aggs += [F.count_distinct(c).alias(f"__d{i}"), F.min(c).alias(f"__m{i}"), F.max(c).alias(f"__x{i}")]
    wide = claims.agg(*aggs)
    rows = []
    for i, (name, c, expected) in enumerate(rules):
        ok = ((F.col(f"__d{i}") == 1) & (F.col(f"__m{i}").cast("string") == F.lit(str(expected))))
        rows.append(F.struct(F.lit(name).alias("check_name"), F.lit(c).alias("column_name"),
                             F.lit(str(expected)).alias("expected"),
                             F.col(f"__d{i}").alias("distinct_values"),
                             F.col(f"__m{i}").cast("string").alias("min_value"),
                             F.col(f"__x{i}").cast("string").alias("max_value"),
                             F.when(ok, F.lit("PASS")).otherwise(F.lit("WARNING")).alias("status")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# V15
def label_separability(claims: DataFrame, features: Sequence[str] = SEPARABILITY_FEATURES) -> DataFrame:
    """Per feature and label, min/mean/max of the provider-level averages."""
    prov = claims.groupBy("provider_id", "fraud_provider_label").agg(
        flag_rate("is_high_acuity_em").alias("high_acuity_pct"), flag_rate("is_99215").alias("pct_99215"),
        flag_rate("is_referral").alias("referral_rate"), flag_rate("is_eye_procedure").alias("eye_procedure_pct"),
        money_avg("total_paid_amount").alias("avg_paid_per_claim"),
        F.avg("member_provider_distance").alias("avg_member_provider_distance"))
    long = prov.unpivot(["provider_id", "fraud_provider_label"], list(features), "feature", "value")
    return long.groupBy("feature", "fraud_provider_label").agg(
        F.min("value").alias("min_value"), F.avg("value").alias("mean_value"), F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("providers"))
