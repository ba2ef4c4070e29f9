"""Investigation queue, feedback analytics and business value.

Queues and "next cases" are top-k problems: they are planned as
TakeOrderedAndProject (each task keeps k rows) and only the <= k survivors
are ranked.  Anti joins replace ``LEFT JOIN ... IS NULL`` / ``NOT EXISTS``.
Metrics @K are one aggregate with a conditional count per K: no replication
of the ranked rows per capacity value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach_scalars, count_if, pct2
from ..functions.ranking import materialize, top_k, top_k_per_group
from .performance import COMPLETED, RUN_KEYS, expected_version


def _queue_priority(rank):
    return F.when(rank <= 10, "P1").when(rank <= 25, "P2").otherwise("P3")


# I1 -----------------------------------------------------------------------------
def production_run(state: DataFrame, preds: DataFrame, state_key: str) -> DataFrame:
    """The approved (model, version, run) of ``state_key`` among scored runs (<= 1 row)."""
    s = (state.where(F.col("model_name") == state_key)
              .select(F.col("approved_model_type").alias("s_model"), F.col("approved_run_id").alias("s_run"),
                      expected_version(F.col("approved_model_type"), F.col("approved_model_resource")).alias("s_exp"))
              .limit(1))
    j = preds.join(F.broadcast(s), (preds.model_name == s.s_model) & (preds.run_id == s.s_run), "inner").where(
        F.col("s_exp").isNull() | (F.col("model_version") == F.col("s_exp")))
    runs = j.groupBy(*RUN_KEYS).agg(F.max("created_at").alias("latest_prediction_timestamp"))
    best = runs.agg(F.max_by(F.struct(*RUN_KEYS), F.struct("latest_prediction_timestamp", "model_version")).alias("r"))
    return best.select("r.*").where(F.col("run_id").isNotNull())


def investigation_queue(preds: DataFrame, state: DataFrame, state_key: str, capacity: int = 50,
                        queue_created_at=None) -> DataFrame:
    """Top ``capacity`` providers of the approved production run with priorities."""
    if capacity < 1:
        raise ValueError("capacity must be >= 1")
    if queue_created_at is None:
        raise ValueError("pass queue_created_at explicitly")
    run = production_run(state, preds, state_key)
    p = preds.join(F.broadcast(run), RUN_KEYS, "left_semi")
    top = top_k(p, [F.col("fraud_score").desc(), F.col("provider_id")], capacity, rank_col="investigation_rank")
    return top.select("provider_id", "experiment_id", "run_id", "model_name", "model_version", "fraud_score",
                      "risk_rank", "risk_category", "reason", "investigation_rank",
                      _queue_priority(F.col("investigation_rank")).alias("investigation_priority"),
                      F.lit(queue_created_at).cast("timestamp").alias("queue_created_at"))


def completed(feedback: DataFrame) -> DataFrame:
    """The cases that have an outcome."""
    return feedback.where(F.col("investigation_result").isin(*COMPLETED))


# I2 -----------------------------------------------------------------------------
def queue_summary(queue: DataFrame) -> DataFrame:
    """Queued count and lowest/highest score per run."""
    return queue.groupBy(*RUN_KEYS).agg(F.count(F.lit(1)).alias("investigation_count"),
                                        F.min("fraud_score").alias("lowest_queued_score"),
                                        F.max("fraud_score").alias("highest_queued_score"))


# I3 / I4 ------------------------------------------------------------------------
def open_queue(queue: DataFrame, feedback: DataFrame, keys: Sequence[str] = ("provider_id",)) -> DataFrame:
    """Queue entries with no completed outcome on ``keys`` (left anti join)."""
    return queue.join(completed(feedback).select(*keys).distinct(), list(keys), "left_anti")


# I5 -----------------------------------------------------------------------------
def next_cases(preds: DataFrame, feedback: DataFrame, n: int) -> DataFrame:
    """Per run, the ``n`` best-ranked providers without an outcome on (provider, run, version)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    open_ = preds.join(completed(feedback).select("provider_id", "run_id", "model_version"),
                       ["provider_id", "run_id", "model_version"], "left_anti")
    return top_k_per_group(open_, RUN_KEYS, [F.col("risk_rank"), F.col("provider_id")], n,
                           rank_col="case_order").select("provider_id", *RUN_KEYS, "fraud_score", "risk_rank",
                                                         "risk_category", "case_order")


# I6 -----------------------------------------------------------------------------
def exploration_sample(preds: DataFrame, feedback: DataFrame, model_name: str, tier: str = "LOW", n: int = 30,
                       seed: int = 42) -> DataFrame:
    """Reproducible random sample of ``n`` never-investigated providers of ``tier``
    from the model's latest run.  The "random" order is md5(provider_id:seed), so
    reruns (and other engines) pick the same sample."""
    p = preds.where(F.col("model_name") == model_name)
    latest = p.groupBy("run_id").agg(F.max("created_at").alias("ts")).agg(
        F.max_by("run_id", F.struct("ts", "run_id")).alias("run_id"))
    cand = (p.join(F.broadcast(latest), "run_id", "left_semi")
             .join(completed(feedback).select("provider_id").distinct(), "provider_id", "left_anti")
             .where(F.col("risk_category") == tier))
    key = F.md5(F.concat_ws(":", F.col("provider_id"), F.lit(str(seed))))
    top = top_k(cand.withColumn("__k", key), [F.col("__k"), F.col("provider_id")], n, rank_col="exploration_random_rank")
    return top.select("provider_id", "model_version", "fraud_score", "risk_rank", "risk_category",
                      "exploration_random_rank")


# I7 -----------------------------------------------------------------------------
def outcome_share(feedback: DataFrame) -> DataFrame:
    """Outcome counts with percent of reviewed; the total is the sum of the counts."""
    c = completed(feedback).groupBy("investigation_result").agg(F.count(F.lit(1)).alias("provider_count"))
    t = c.agg(F.sum("provider_count").alias("__t"))
    return attach_scalars(c, t).select("investigation_result", "provider_count",
                                              pct2("provider_count", "__t").alias("pct_of_reviewed"))


# I8 -----------------------------------------------------------------------------
def fraud_yield(feedback: DataFrame) -> DataFrame:
    """I8: reviewed, confirmed fraud/normal, yield percent and confirmed dollars."""
    cf = F.col("confirmed_fraud")
    a = completed(feedback).agg(F.count(F.lit(1)).alias("providers_reviewed"), count_if(cf).alias("confirmed_fraud"),
                     count_if(~cf).alias("confirmed_normal"), count_if(cf.isNotNull()).alias("__n"),
                     F.round(F.sum("fraud_amount"), 2).cast("decimal(18,2)").alias("confirmed_fraud_amount"))
    return a.select("providers_reviewed", "confirmed_fraud", "confirmed_normal",
                    pct2("confirmed_fraud", "__n").alias("fraud_yield_pct"), "confirmed_fraud_amount")


# I9 -----------------------------------------------------------------------------
def rank_vs_outcome(preds: DataFrame, feedback: DataFrame, model_name: str, n: int = 50) -> DataFrame:
    """Model rank next to the investigation outcome (join on provider, version), top n."""
    p = preds.where(F.col("model_name") == model_name).select("risk_rank", "provider_id", "model_version",
                                                              "fraud_score", F.col("run_id").alias("pred_run_id"))
    f = feedback.select("provider_id", "model_version", "investigation_id", "investigation_result",
                        "confirmed_fraud", "fraud_amount")
    j = p.join(f, ["provider_id", "model_version"], "inner")
    out = top_k(j, ["risk_rank", "provider_id", "pred_run_id", "investigation_id"], n)
    return out.select("risk_rank", "provider_id", "pred_run_id", "fraud_score", "investigation_id",
                      "investigation_result", "confirmed_fraud", "fraud_amount")


# I10 ----------------------------------------------------------------------------
def outcome_by_run(feedback: DataFrame) -> DataFrame:
    """Outcome counts and dollars per run and result."""
    return (feedback.where(F.col("run_id").isNotNull())
                    .groupBy("run_id", "investigation_result")
                    .agg(F.count(F.lit(1)).alias("provider_count"),
                         F.sum("fraud_amount").cast("decimal(18,2)").alias("total_fraud_amount")))


# I11 ----------------------------------------------------------------------------
def provider_truth(claims: DataFrame) -> DataFrame:
    """Provider label = max claim label (partial aggregation per provider)."""
    return claims.groupBy(F.col("provider_id").cast("string").alias("provider_id")).agg(
        F.max(F.col("fraud_provider_label").cast("long")).alias("fraud_label"))


# I12 / I13 ------------------------------------------------------------------------
def latest_scored_run(preds: DataFrame) -> DataFrame:
    """Latest (model, version, run) by prediction time; ties by model then run (1 row)."""
    runs = preds.groupBy(*RUN_KEYS).agg(F.max("created_at").alias("ts"))
    return runs.agg(F.max_by(F.struct(*RUN_KEYS), F.struct("ts", "model_name", "run_id")).alias("r")).select("r.*")


def _ranked_with_truth(preds: DataFrame, truth: DataFrame, run: DataFrame, max_k: int):
    # read twice (population and top k): one table of the run's providers
    # a prediction without truth can't be judged: it is left out of the ranking and counted
    p = materialize(preds.join(F.broadcast(run), RUN_KEYS, "left_semi").join(truth, "provider_id", "left"))
    pop = p.agg(F.count("fraud_label").alias("total_providers"),
                count_if(F.col("fraud_label").isNull()).alias("providers_without_truth"),
                F.sum("fraud_label").cast("long").alias("total_fraud_providers"),
                F.avg("fraud_label").alias("fraud_prevalence"))
    top = top_k(p.where(F.col("fraud_label").isNotNull()), [F.col("fraud_score").desc(), F.col("provider_id")], max_k, rank_col="rank_position")
    return top, pop


def metrics_at_k(preds: DataFrame, truth: DataFrame, ks: Sequence[int] = (10, 20, 50),
                 feedback: DataFrame | None = None) -> DataFrame:
    """I12 (+ I13 when ``feedback`` is given): selected, captured, precision / recall /
    lift @K, prevalence and confirmed dollars captured, for the latest scored run."""
    ks = sorted({int(k) for k in ks})
    if not ks or ks[0] < 1:
        raise ValueError("capacities must be >= 1")
    run = latest_scored_run(preds)
    top, pop = _ranked_with_truth(preds, truth, run, ks[-1])
    if feedback is not None:
        fb = (feedback.join(F.broadcast(run), RUN_KEYS, "left_semi")
                      .where(F.col("investigation_result").isin(*COMPLETED))
                      .groupBy("provider_id").agg(
                          F.max(F.when(F.col("confirmed_fraud"), F.col("fraud_amount")).otherwise(F.lit(0)))
                           .alias("amt")))
        top = top.join(fb, "provider_id", "left")
    else:
        top = top.withColumn("amt", F.lit(None).cast("decimal(18,2)"))
    r = F.col("rank_position")
    wide = top.agg(*[count_if(r <= k).alias(f"s{k}") for k in ks],
                   *[count_if((r <= k) & (F.col("fraud_label") == 1)).alias(f"c{k}") for k in ks],
                   *[F.coalesce(F.sum(F.when(r <= k, F.coalesce(F.col("amt"), F.lit(0)))), F.lit(0))
                     .cast("decimal(18,2)").alias(f"d{k}") for k in ks])
    rows = [F.struct(F.lit(k).alias("investigation_capacity"), F.col(f"s{k}").alias("providers_selected"),
                     F.col(f"c{k}").alias("fraud_captured"), F.col(f"d{k}").alias("confirmed_fraud_dollars_captured"))
            for k in ks]
    long = wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    j = attach_scalars(attach_scalars(long, pop), run)
    prec = F.try_divide(F.col("fraud_captured"), F.col("providers_selected"))
    return j.select(*RUN_KEYS, "investigation_capacity", "providers_selected", "fraud_captured",
                    prec.alias("precision_at_k"),
                    F.try_divide(F.col("fraud_captured"), F.col("total_fraud_providers")).alias("recall_at_k"),
                    F.try_divide(prec, F.col("fraud_prevalence")).alias("lift_at_k"),
                    "confirmed_fraud_dollars_captured", "fraud_prevalence", "total_fraud_providers", "total_providers",
                    "providers_without_truth")


def dollars_at_k(preds: DataFrame, truth: DataFrame, feedback: DataFrame, ks: Sequence[int] = (10, 20, 50)
                 ) -> DataFrame:
    """Confirmed fraud dollars captured @K (max per provider, confirmed only)."""
    m = metrics_at_k(preds, truth, ks, feedback)
    return m.select(*RUN_KEYS, "investigation_capacity", "confirmed_fraud_dollars_captured")

