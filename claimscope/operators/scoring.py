"""Batch scoring and prediction curation.

Ranks are computed with ``row_number_by`` (range-partitioned, exact) because a
scoring run is one huge partition key; reason codes use higher-order array
functions per row, so they add no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach_scalars, count_if, validate_names
from ..functions.fingerprints import BUCKETS, bucket_fingerprints, bucket_of, differing_buckets, rows_of
from ..functions.ranking import materialize, row_number_by

RUN_KEYS = ["model_name", "model_version", "run_id"]
# Tier thresholds and texts of the curated prediction table.
HIGH_AT, MEDIUM_AT = 0.80, 0.50
TIER_REASON = {"HIGH": "Very high model fraud probability", "MEDIUM": "Elevated model fraud probability",
               "LOW": "Below investigation threshold"}
CLASS_REASON = {
    "isolation_forest": ("Isolation Forest identified provider as anomalous",
                         "Isolation Forest identified provider as normal"),
    "random_forest": ("Random Forest predicted provider as potential fraud", "Random Forest predicted provider as normal"),
}


# C1 -----------------------------------------------------------------------------
def batch_input(features: DataFrame, cols: Sequence[str], split: str = "TEST") -> DataFrame:
    """Exactly [provider_id STRING, *features DOUBLE] of the split, in order.

    The feature contract is checked on the schema before any job runs.
    """
    cols = validate_names(cols)
    missing = [c for c in ["provider_id", *cols] if c not in features.columns]
    if missing:
        raise ValueError(f"feature table lacks {missing}")
    src = features.where(F.col("dataset_split") == split) if split else features
    out = src.select(F.col("provider_id").cast("string").alias("provider_id"),
                     *[F.col(c).cast("double").alias(c) for c in cols])
    if out.columns != ["provider_id", *cols]:
        raise ValueError("batch input schema does not match the contract")
    return out


# C2 -----------------------------------------------------------------------------
def score(batch: DataFrame, model, cols: Sequence[str], positive_index: int = 1) -> DataFrame:
    """Class-1 probability per provider from a fitted ``pyspark.ml`` model.

    Features are assembled by name and order; the id never enters the vector.
    Scoring is a distributed ``transform`` (no per-row service calls).
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    cols = validate_names(cols)
    va = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="keep")
    scored = model.transform(va.transform(batch).withColumnRenamed("__features", model.getFeaturesCol()))
    prob = vector_to_array(F.col(model.getProbabilityCol()))
    return scored.select("provider_id", prob[positive_index].alias("fraud_score"))


# C3 -----------------------------------------------------------------------------
def prediction_completeness(batch: DataFrame, raw: DataFrame, score_col: str = "fraud_score") -> DataFrame:
    """Input vs predicted providers: missing, unexpected, duplicated, out of range.

    Raw rows are pre-aggregated per provider (partial aggregation), then one
    full outer join on provider id.
    """
    b = batch.select("provider_id").distinct().withColumn("__in", F.lit(True))
    r = raw.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("__n"),
        count_if(F.col(score_col).isNotNull() & ((F.col(score_col) < 0) | (F.col(score_col) > 1))).alias("__oor"),
        count_if(F.col(score_col).isNull()).alias("__null"))
    j = b.join(r, "provider_id", "full_outer")
    known = F.col("provider_id").isNotNull()
    agg = j.agg(
        count_if(F.col("__in")).alias("input_count"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("predicted_count"),
        count_if(F.col("__in") & F.col("__n").isNull()).alias("missing_providers"),
        count_if(F.col("__in").isNull() & known).alias("unexpected_providers"),
        F.coalesce(F.sum(F.when(~known, F.col("__n"))), F.lit(0)).cast("long").alias("lost_lineage_rows"),
        count_if((F.col("__n") > 1) & known).alias("duplicated_providers"),
        F.coalesce(F.sum("__oor"), F.lit(0)).cast("long").alias("out_of_range_scores"),
        F.coalesce(F.sum("__null"), F.lit(0)).cast("long").alias("null_scores"))
    return _completeness_status(agg)


def _completeness_status(agg: DataFrame) -> DataFrame:
    # Failure reasons of the batch-output checks, first failing check wins.
    reason = (F.when(F.col("predicted_count") == 0, "zero successful prediction rows")
               .when(F.col("predicted_count") != F.col("input_count"), "prediction count does not match input count")
               .when(F.col("lost_lineage_rows") > 0, "output lost provider lineage")
               .when(F.col("duplicated_providers") > 0, "duplicate prediction for a provider")
               .when((F.col("out_of_range_scores") > 0) | (F.col("null_scores") > 0), "prediction is not a probability")
               .when((F.col("missing_providers") > 0) | (F.col("unexpected_providers") > 0), "provider lineage mismatch"))
    return agg.select("*", F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"))


def completeness_by_fingerprint(batch: DataFrame, raw: DataFrame, score_col: str = "fraud_score", buckets: int = BUCKETS) -> DataFrame:
    """C3 for large runs: both sides send one fingerprint per id bucket; only buckets that differ are joined.

    ``batch`` has one row per provider, as the batch input is made.  A bucket with equal fingerprints then holds
    each of its providers once on both sides.
    """
    scores = raw.agg(
        F.count(F.lit(1)).alias("predicted_count"), count_if(F.col("provider_id").isNull()).alias("lost_lineage_rows"),
        count_if(F.col(score_col).isNotNull() & ((F.col(score_col) < 0) | (F.col(score_col) > 1))).alias("out_of_range_scores"),
        count_if(F.col(score_col).isNull()).alias("null_scores"))
    inputs = batch.agg(F.count("provider_id").alias("input_count"), count_if(F.col("provider_id").isNull()).alias("__nameless"))
    differ = differing_buckets(bucket_fingerprints(batch, "provider_id", (), buckets), bucket_fingerprints(raw, "provider_id", (), buckets))
    if differ:
        b = rows_of(batch.where(F.col("provider_id").isNotNull()), "provider_id", differ, buckets).select("provider_id", F.lit(True).alias("__in"))
        r = rows_of(raw.where(F.col("provider_id").isNotNull()), "provider_id", differ, buckets).groupBy("provider_id").agg(F.count(F.lit(1)).alias("__n"))
        odd = b.join(r, "provider_id", "full_outer").agg(
            count_if(F.col("__in") & F.col("__n").isNull()).alias("missing_providers"),
            count_if(F.col("__in").isNull()).alias("unexpected_providers"), count_if(F.col("__n") > 1).alias("duplicated_providers"))
    else:
        odd = scores.select(*[F.lit(0).cast("long").alias(c) for c in ("missing_providers", "unexpected_providers", "duplicated_providers")])
    j = attach_scalars(attach_scalars(scores, inputs), odd)
    # a batch row without a provider is an input that can't be found again
    nameless = F.least(F.col("__nameless"), F.lit(1))
    agg = j.select((F.col("input_count") + nameless).alias("input_count"), "predicted_count", (F.col("missing_providers") + nameless).alias("missing_providers"),
                   "unexpected_providers", "lost_lineage_rows", "duplicated_providers", "out_of_range_scores", "null_scores")
    return _completeness_status(agg)


def completeness_failures(batch: DataFrame, raw: DataFrame, n: int = 20) -> DataFrame:
    """Sample of failing providers for C3 (a bounded top-k listing by id)."""
    b = batch.select("provider_id").distinct().withColumn("__in", F.lit(True))
    r = raw.groupBy("provider_id").agg(F.count(F.lit(1)).alias("__n"))
    j = b.join(r, "provider_id", "full_outer")
    problem = (F.when(F.col("__in") & F.col("__n").isNull(), "missing")
                .when(F.col("__in").isNull(), "unexpected").when(F.col("__n") > 1, "duplicated"))
    return j.select("provider_id", problem.alias("problem")).where(F.col("problem").isNotNull()) \
            .orderBy("problem", "provider_id").limit(n)


# C4 -----------------------------------------------------------------------------
def invalid_predictions(raw: DataFrame, col: str = "prediction", group_by: Sequence[str] = ()) -> DataFrame:
    """C4: rows whose raw prediction is present but is no number (text, or NaN)."""
    number = F.col(col).try_cast("double")
    bad = (number.isNull() | F.isnan(number)) & F.col(col).isNotNull()
    g = raw.groupBy(*group_by) if group_by else raw
    return g.agg(F.count(F.lit(1)).alias("total_rows"), count_if(bad).alias("invalid_predictions"))


# C5 -----------------------------------------------------------------------------
def score_distribution(scored: DataFrame, group_by: Sequence[str] = (), col: str = "fraud_score",
                       threshold: float = 0.5) -> DataFrame:
    """N, >= threshold, < threshold, min, max, mean of the scores."""
    g = scored.groupBy(*group_by) if group_by else scored
    s = F.col(col)
    return g.agg(F.count(s).alias("scored_rows"), count_if(s >= threshold).alias("at_or_above_threshold"),
                 count_if(s < threshold).alias("below_threshold"), F.min(s).alias("min_score"),
                 F.max(s).alias("max_score"), F.avg(s).alias("avg_score"))


# C6 -----------------------------------------------------------------------------
def risk_tier(score: Column) -> Column:
    return F.when(score >= HIGH_AT, "HIGH").when(score >= MEDIUM_AT, "MEDIUM").otherwise("LOW")


def curate_predictions(raw: DataFrame, prediction_col: str = "prediction",
                       lineage: Sequence[str] = ("prediction_date", "experiment_id", "run_id", "model_name",
                                                 "model_version", "created_at")) -> DataFrame:
    """Parse, rank by (score desc, provider) within each scored run, tier and reason.

    A scored run is (model, version, run).  Predictions that C4 counts as invalid are left
    out.  ``risk_rank`` is exact and computed without funnelling a run into one task.
    """
    lineage = list(lineage)
    parsed = raw.select(*lineage, F.col("provider_id").cast("string").alias("provider_id"),
                        F.col(prediction_col).try_cast("double").alias("fraud_score")
                        ).where(F.col("fraud_score").isNotNull() & ~F.isnan("fraud_score"))
    ranked = row_number_by(parsed, ["model_name", "model_version", "run_id"], [F.col("fraud_score").desc(), F.col("provider_id")], out="risk_rank")
    tier = risk_tier(F.col("fraud_score"))
    reason = F.when(tier == "HIGH", TIER_REASON["HIGH"]).when(tier == "MEDIUM", TIER_REASON["MEDIUM"]) \
              .otherwise(TIER_REASON["LOW"])
    return ranked.select(*[c for c in lineage if c != "created_at"], "provider_id", "fraud_score", "risk_rank",
                         tier.alias("risk_category"), reason.alias("reason"), "created_at")


# C8 -----------------------------------------------------------------------------
def train_means(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame of TRAIN feature means (``mean_<feature>``)."""
    return train.agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def reason_codes(features: DataFrame, means: DataFrame, cols: Sequence[str], k: int = 3,
                 zero_mean: str = "zero") -> DataFrame:
    """Top-``k`` features by value / TRAIN mean (desc), ties by feature order.

    ``zero_mean="zero"``: ratio 0 when the mean is 0 (SQL scripts / pandas);
    ``zero_mean="drop"``: SAFE_DIVIDE and drop NULL ratios (pipeline component).
    NULL ratios sort last.  ``means`` is a 1-row aggregate (broadcast).
    """
    if zero_mean not in ("zero", "drop"):
        raise ValueError("zero_mean must be 'zero' or 'drop'")
    if k < 1:
        raise ValueError("k must be >= 1")
    j = attach_scalars(features, means)
    items = []
    for i, c in enumerate(cols):
        m = F.col(f"mean_{c}")
        ratio = (F.when(m != 0, F.col(c) / m).otherwise(F.lit(0.0)) if zero_mean == "zero"
                 else F.try_divide(F.col(c), m))
        items.append(F.struct(ratio.isNull().alias("n"), (-ratio).alias("neg"), F.lit(i + 1).alias("o"),
                              F.lit(c).alias("name")))
    arr = F.array(*items)
    if zero_mean == "drop":
        arr = F.filter(arr, lambda x: ~x["n"])
    ranked = F.array_sort(arr)
    out = j.select(*features.columns, *[F.get(ranked, i)["name"].alias(f"reason_{i + 1}") for i in range(k)])
    return out


# C7 -----------------------------------------------------------------------------
def curate_classes(raw: DataFrame, runs: DataFrame, model_type: str, positive: str,
                   features: DataFrame | None = None, means: DataFrame | None = None,
                   cols: Sequence[str] = (), prediction_date=None, created_at=None) -> DataFrame:
    """Binary class output -> score 1.0/0.0, HIGH/LOW, rank by class then id,
    lineage of the latest run of the model type; optional reason codes (C8).

    A prediction that is no class number gives no row, as in C6; C4 counts those rows.
    """
    if prediction_date is None or created_at is None:
        raise ValueError("pass prediction_date and created_at explicitly")
    cls = F.col("prediction").try_cast("int")
    pos = cls == int(positive)
    r = raw.where(cls.isNotNull()).select(F.col("provider_id").cast("string").alias("provider_id"),
                                          F.when(pos, 1.0).otherwise(0.0).alias("fraud_score"))
    if features is not None:
        r = r.join(features, "provider_id", "inner")
        r = reason_codes(r, means, cols, 3, "zero")
    else:
        r = r.select("*", *[F.lit(None).cast("string").alias(f"reason_{i}") for i in (1, 2, 3)])
    ranked = row_number_by(r.withColumn("__g", F.lit(1)), ["__g"],
                           [F.col("fraud_score").desc(), F.col("provider_id")], out="risk_rank")
    latest = (runs.where(F.col("model_type") == model_type)
                  .agg(F.max_by(F.struct("experiment_id", "run_id", "experiment_name"),
                                F.struct("created_at", "run_id")).alias("e")).select("e.*"))
    yes, no = CLASS_REASON.get(model_type, (f"{model_type} flagged provider", f"{model_type} did not flag provider"))
    return attach_scalars(ranked, latest).select(
        F.lit(prediction_date).cast("date").alias("prediction_date"), "provider_id", "experiment_id", "run_id",
        F.lit(model_type).alias("model_name"), "experiment_name", "fraud_score", "risk_rank",
        F.when(F.col("fraud_score") == 1.0, "HIGH").otherwise("LOW").alias("risk_category"),
        F.when(F.col("fraud_score") == 1.0, yes).otherwise(no).alias("reason"),
        F.lit(created_at).cast("timestamp").alias("created_at"), "reason_1", "reason_2", "reason_3")


# C9 -----------------------------------------------------------------------------
def anomaly_tiers(scored: DataFrame, k: int = 50, flag_col: str = "suspicious_flag",
                  group_by: Sequence[str] = ("model_name", "model_version", "run_id")) -> DataFrame:
    """Flagged -> HIGH; else rank <= k -> MEDIUM; else LOW (vectorised, no row apply)."""
    ranked = row_number_by(scored, list(group_by), [F.col("fraud_score").desc(), F.col("provider_id")],
                           out="risk_rank")
    tier = F.when(F.col(flag_col) == 1, "HIGH").when(F.col("risk_rank") <= k, "MEDIUM").otherwise("LOW")
    return ranked.withColumn("risk_category", tier)


# C10 ----------------------------------------------------------------------------
def prediction_summary(preds: DataFrame, keys: Sequence[str] = ("experiment_id", "run_id", "model_name")
                       ) -> DataFrame:
    """Providers, HIGH/LOW counts and mean score per run."""
    return preds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("provider_count"), count_if(F.col("risk_category") == "HIGH").alias("high_risk_count"),
        count_if(F.col("risk_category") == "LOW").alias("low_risk_count"),
        F.avg("fraud_score").alias("predicted_anomaly_rate"))


# C11 ----------------------------------------------------------------------------
def score_parity(a: DataFrame, b: DataFrame, tol: float = 1e-6, key: str = "provider_id",
                 col: str = "fraud_score") -> DataFrame:
    """C11: join two score sets by provider; max |diff|, coverage and PASS/FAIL."""
    x = a.select(key, F.col(col).alias("__a"))
    y = b.select(key, F.col(col).alias("__b"))
    j = x.join(y, key, "full_outer")
    d = F.abs(F.col("__a") - F.col("__b"))
    agg = j.agg(count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("matched_providers"),
                count_if(F.col("__b").isNull()).alias("only_in_a"), count_if(F.col("__a").isNull()).alias("only_in_b"),
                F.max(d).alias("max_abs_difference"), F.avg(d).alias("mean_abs_difference"),
                count_if(d > tol).alias("providers_over_tolerance"))
    return _parity_status(agg, tol)


def _parity_status(agg: DataFrame, tol: float) -> DataFrame:
    ok = (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0) & F.coalesce(F.col("max_abs_difference") <= tol, F.lit(True))
    return agg.withColumn("parity_status", F.when(ok, "PASS").otherwise("FAIL"))


def parity_by_fingerprint(a: DataFrame, b: DataFrame, tol: float = 1e-6, key: str = "provider_id", col: str = "fraud_score",
                          buckets: int = BUCKETS) -> DataFrame:
    """C11 for large score sets: id buckets whose (id, score) fingerprints are equal agree row by row and are not joined.

    Ids are unique within a set and not null, as in ``score_parity``'s inputs.  Buckets with a null score are joined.
    """
    def prints(df, side):
        f = bucket_fingerprints(df, key, [col], buckets)
        gaps = df.where(F.col(key).isNotNull()).groupBy(bucket_of(key, buckets).alias("bucket")).agg((F.count(F.lit(1)) - F.count(col)).alias("gaps"))
        # a bucket with nulls must be joined: its fingerprint gets a mark that the other side never has
        return f.join(gaps, "bucket").withColumn("f2", F.when(F.col("gaps") > 0, F.lit(side).cast("decimal(38,0)")).otherwise(F.col("f2")))
    x, y = materialize(prints(a, -1)), materialize(prints(b, -2))
    differ = differing_buckets(x, y)
    same = x.where(~F.col("bucket").isin(differ)).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("__same"))
    if differ:
        p = rows_of(a, key, differ, buckets).select(key, F.col(col).alias("__a"))
        q = rows_of(b, key, differ, buckets).select(key, F.col(col).alias("__b"))
        d = F.abs(F.col("__a") - F.col("__b"))
        odd = p.join(q, key, "full_outer").agg(
            count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("m"), count_if(F.col("__b").isNull()).alias("only_in_a"),
            count_if(F.col("__a").isNull()).alias("only_in_b"), F.max(d).alias("most"), F.sum(d).alias("total"), count_if(d > tol).alias("over"))
    else:
        zero = F.lit(0).cast("long")
        odd = same.select(zero.alias("m"), zero.alias("only_in_a"), zero.alias("only_in_b"), F.lit(None).cast("double").alias("most"),
                          F.lit(None).cast("double").alias("total"), zero.alias("over"))
    j = attach_scalars(odd, same)
    equal = F.when(F.col("__same") > 0, F.lit(0.0))
    matched = F.col("m") + F.col("__same")
    return _parity_status(j.select(
        matched.alias("matched_providers"), "only_in_a", "only_in_b", F.greatest("most", equal).alias("max_abs_difference"),
        F.try_divide(F.coalesce("total", equal), matched.cast("double")).alias("mean_abs_difference"), F.col("over").alias("providers_over_tolerance")), tol)
