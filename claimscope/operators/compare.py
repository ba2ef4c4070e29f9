"""Model comparison and experiment tracking.

"Latest run" questions are answered on the run table (one row per run after a
partial aggregate) with ``max_by``; prediction rows are then filtered by a
broadcast semi-join against those few run ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import count_if, pct2, round_double
from ..functions.ranking import latest_per, top_k


# X1 -----------------------------------------------------------------------------
def latest_runs(runs: DataFrame, key: str = "model_type", ts: str = "created_at", id_col: str = "run_id",
                types: Sequence[str] | None = None) -> DataFrame:
    """Latest run per ``key`` (ties by run id)."""
    r = runs.where(F.col(key).isin(*types)) if types else runs
    return latest_per(r, [key], [ts, id_col])


def latest_prediction_runs(preds: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """Latest scored run per model_name from prediction rows (aggregate first)."""
    p = preds.where(F.col("model_name").isin(*models)) if models else preds
    runs = p.groupBy("model_name", "run_id").agg(F.max("created_at").alias("ts"))
    return latest_per(runs, ["model_name"], ["ts", "run_id"]).select("model_name", "run_id")


def latest_predictions(preds: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    runs = latest_prediction_runs(preds, models)  # one row per model: broadcast-safe
    return preds.join(F.broadcast(runs), ["model_name", "run_id"], "left_semi")


# X2 -----------------------------------------------------------------------------
def latest_metrics(runs: DataFrame, metrics: DataFrame, types: Sequence[str], names: Sequence[str],
                   digits: int | None = 4) -> DataFrame:
    """Metrics of the latest run per model type, long form, rounded."""
    lr = latest_runs(runs, types=types).select("model_type", "run_id")
    m = metrics.where(F.col("metric_name").isin(*names))
    return m.join(F.broadcast(lr), "run_id").select(
        "model_type", "metric_name",
        (round_double(F.col("metric_value"), digits) if digits is not None else F.col("metric_value")).alias("metric_value"))


# X3 -----------------------------------------------------------------------------
def metric_pivot(runs: DataFrame, metrics: DataFrame, types: Sequence[str], names: Sequence[str],
                 digits: int = 4) -> DataFrame:
    """One row per metric, one column per model type (max handles repeated rows)."""
    long = latest_metrics(runs, metrics, types, names, digits=None)
    wide = long.groupBy("metric_name").pivot("model_type", list(types)).agg(F.max("metric_value"))
    return wide.select("metric_name", *[round_double(F.col(t), digits).alias(t) for t in types])


# X4 -----------------------------------------------------------------------------
def tier_share(preds: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """Risk tier counts and percent per model for each model's latest run."""
    lp = latest_predictions(preds, models)
    c = lp.groupBy("model_name", "risk_category").agg(F.count(F.lit(1)).alias("provider_count"))
    t = c.groupBy("model_name").agg(F.sum("provider_count").alias("__t"))
    return c.join(t, "model_name").select("model_name", "risk_category", "provider_count",
                                          pct2("provider_count", "__t").alias("provider_pct"))


# X5 -----------------------------------------------------------------------------
def rank_matrix(preds: DataFrame, models: Sequence[str], k: int = 20) -> DataFrame:
    """Providers in any model's top ``k``, with each model's rank and score.

    The candidate set (<= k per model) is found first and semi-joined, so the
    per-provider pivot only touches those providers.
    """
    lp = latest_predictions(preds, models)
    cand = lp.where(F.col("risk_rank") <= k).select("provider_id").distinct()
    sub = lp.join(F.broadcast(cand), "provider_id", "left_semi")
    aggs = [F.max(F.when(F.col("model_name") == m, F.col("risk_rank"))).alias(f"{m}_rank") for m in models]
    aggs += [F.max(F.when(F.col("model_name") == m, F.col("fraud_score"))).alias(f"{m}_score") for m in models]
    wide = sub.groupBy("provider_id").agg(*aggs)
    best = F.least(*[F.col(f"{m}_rank") for m in models], F.lit(None).cast("long"))  # skips missing ranks
    return wide.withColumn("best_rank", best.cast("long"))


# X6 -----------------------------------------------------------------------------
def topk_overlap(preds: DataFrame, a: str, b: str, k: int = 20) -> DataFrame:
    """Number of providers in both models' top ``k``."""
    lp = latest_predictions(preds, [a, b]).where(F.col("risk_rank") <= k)
    x = lp.where(F.col("model_name") == a).select("provider_id")
    y = lp.where(F.col("model_name") == b).select("provider_id")
    return x.join(y, "provider_id", "inner").agg(F.count(F.lit(1)).alias(f"common_top_{k}_providers"))


# X7 -----------------------------------------------------------------------------
def score_on_confirmed(preds: DataFrame, feedback: DataFrame, models: Sequence[str]) -> DataFrame:
    """Scores and HIGH counts of each model's latest run on confirmed-fraud providers."""
    conf = feedback.where(F.col("confirmed_fraud")).select("provider_id").distinct()
    lp = latest_predictions(preds, models).join(conf, "provider_id", "left_semi")
    return lp.groupBy("model_name").agg(F.count(F.lit(1)).alias("confirmed_fraud_scored"),
                                        round_double(F.avg("fraud_score"), 4).alias("avg_fraud_score"),
                                        count_if(F.col("risk_category") == "HIGH").alias("high_risk_count"))


# X8 -----------------------------------------------------------------------------
def disagreement(preds: DataFrame, a: str, b: str, k: int = 50) -> DataFrame:
    """Providers outside model ``a``'s top ``k`` that model ``b`` rates HIGH."""
    lp = latest_predictions(preds, [a, b])
    x = lp.where(F.col("model_name") == a).select(
        "provider_id", F.col("fraud_score").alias(f"{a}_score"), F.col("risk_rank").alias(f"{a}_rank"),
        F.col("risk_category").alias(f"{a}_risk"))
    y = lp.where(F.col("model_name") == b).select(
        "provider_id", F.col("fraud_score").alias(f"{b}_score"), F.col("risk_rank").alias(f"{b}_rank"),
        F.col("risk_category").alias(f"{b}_risk"))
    return x.join(y, "provider_id").where((F.col(f"{a}_rank") > k) & (F.col(f"{b}_risk") == "HIGH"))


# X9 -----------------------------------------------------------------------------
def run_history(runs: DataFrame, model_type: str | None = None, n: int | None = None) -> DataFrame:
    """Runs (optionally of one type), newest first; ``n`` limits the listing."""
    r = runs.where(F.col("model_type") == model_type) if model_type else runs
    r = r.orderBy(F.col("created_at").desc(), F.col("run_id").desc())
    return r.limit(n) if n else r


def metric_history(metrics: DataFrame, experiment_id: str | None = None) -> DataFrame:
    """Metric rows (optionally of one experiment), newest first."""
    m = metrics.where(F.col("experiment_id") == experiment_id) if experiment_id else metrics
    return m.select("run_id", "metric_name", "metric_value", "created_at").orderBy(
        F.col("created_at").desc(), "metric_name", "run_id")


# X10 ----------------------------------------------------------------------------
def latest_top_predictions(preds: DataFrame, model: str, n: int = 20,
                           cols: Sequence[str] = ("provider_id", "fraud_score", "risk_rank", "risk_category")
                           ) -> DataFrame:
    """Top ``n`` rows (by risk_rank) of the model's latest scored run."""
    lp = latest_predictions(preds, [model])
    return top_k(lp, ["risk_rank", "provider_id"], n).select(*cols)


# X11 ----------------------------------------------------------------------------
def resolve_run(runs: DataFrame, model_type: str, run_id: str | None = None) -> DataFrame:
    """X11: the given run, or the latest SUCCEEDED run of the type (<= 1 row)."""
    if run_id is not None:
        r = runs.where(F.col("run_id") == run_id)
    else:
        r = runs.where((F.col("model_type") == model_type) & (F.col("status") == "SUCCEEDED"))
    best = r.agg(F.max_by(F.struct("experiment_id", "run_id"), F.struct("created_at", "run_id")).alias("x"))
    return best.select("x.experiment_id", "x.run_id").where(F.col("run_id").isNotNull())


# X12 ----------------------------------------------------------------------------
def metric_rows(wide: DataFrame, id_cols: Sequence[str], metric_cols: Sequence[str] | None = None) -> DataFrame:
    """Wide metric columns -> (ids..., metric_name, metric_value DOUBLE) rows."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    cols = list(metric_cols or [f.name for f in wide.schema.fields
                                if f.name not in id_cols and isinstance(f.dataType, numeric)])
    if not cols:
        raise ValueError("no metric columns")
    w = wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    return w.unpivot(list(id_cols), cols, "metric_name", "metric_value")
