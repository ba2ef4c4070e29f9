"""Map the driver's star-schema tables onto the claims-analytics data model.

The adapters are fixtures: they give every operator realistic inputs that grow
with the scale factor.  Each adapter has a Spark form (DataFrame API) and an
equivalent DuckDB SQL form (``*_SQL`` below) used by the oracle queries.

Scale notes
-----------
* ``claims`` joins lineitem (largest) with orders (second largest) by key; both
  are big, so the join is left to Catalyst/AQE (sort-merge or shuffled hash).
  part/supplier/nation/region joins are also left to AQE, whose broadcast
  conversion is size-checked at runtime against ``autoBroadcastJoinThreshold``.
* A service-date window is pushed into the lineitem scan as a ``l_shipdate``
  range on the raw column so Parquet row groups are pruned.
* predictions/feedback aggregate events by (model, run, user): partial
  aggregation happens map-side before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the fixture mapping (FIXTURES.md §2).
MODEL_BY_EVENT = {"view": "isolation_forest", "click": "xgboost", "purchase": "random_forest"}
FEEDBACK_EVENT = "error"
FEEDBACK_MODEL = "xgboost"
RUN_EPOCH = "2024-01-01 00:00:00"
RUN_DAYS = 10
CONFIRM_ABOVE = 100
COMPLETED_MIN_EVENTS = 5  # a case is completed at >= 5 error events, and pending before that
FIXTURE_DATA_MONTH = dt.date(2001, 9, 1)
FIXTURE_TRAIN_MONTHS = 6
FIXTURE_TEST_MONTHS = 3
PLACED_BY = "provider_key"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def claims(spark: SparkSession, sf_dir: str, start: dt.date | None = None, end: dt.date | None = None,
           tasks: int | None = None, without: Sequence[str] = ()) -> DataFrame:
    """One claim per line item.  ``start``/``end`` (inclusive dates) prune the scan.

    With ``tasks`` the claims of a provider lie together, by the column ``PLACED_BY`` added then: the joined rows move
    there before they are widened to claims, so the join with the providers and a grouping by ``PLACED_BY`` and other
    columns move them no more.  No claims of the providers ``without`` are read then.
    """
    li = read(spark, sf_dir, "lineitem")
    if start is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz"))
    if end is not None:
        nxt = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
        li = li.where(F.col("l_shipdate") < F.lit(nxt).cast("timestamp_ntz"))
    if without:
        li = li.where(~F.coalesce(F.col("l_suppkey").cast("string").isin(*without), F.lit(False)))
    # what is joined is as narrow as it can be: these columns move with every row
    li = li.withColumns({"service_date": F.col("l_shipdate").cast("date"), "is_referral": _flag(F.col("l_returnflag") == "R")})
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                              _flag(F.col("p_size") <= 10).alias("is_eye_procedure"))
    supp = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))
    of_supp = F.col("l_suppkey") == F.col("s_suppkey")
    in_nation, in_region = F.col("s_nationkey") == F.col("n_nationkey"), F.col("n_regionkey") == F.col("r_regionkey")
    if tasks is None:
        j = j.join(supp, of_supp).join(nation, in_nation).join(region, in_region)
    else:  # one join, on the column that the rows lie by
        j = j.repartition(tasks, "l_suppkey").join(supp.join(nation, in_nation).join(region, in_region), of_supp)
    billed = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount")
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("claim_id"),
        F.col("o_orderdate").cast("date").alias("claim_date"),
        F.col("l_suppkey").cast("string").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.col("p_type").alias("provider_specialty"),
        F.col("o_custkey").cast("string").alias("member_id"),
        F.col("service_date"),
        F.col("n_name").alias("provider_city"),
        F.col("r_name").alias("provider_state"),
        F.col("p_brand").alias("cpt_code"),
        F.col("p_name").alias("icd_code"),
        billed.alias("total_billed_amt"),
        (billed * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(18,3)").alias("total_allowed_amt"),
        (billed * (F.lit(1) - disc.cast("decimal(4,2)"))).cast("decimal(18,4)").alias("total_paid_amount"),
        F.col("l_linenumber").alias("place_of_service"),
        _flag(disc >= 0.07).alias("is_high_acuity_em"),
        _flag((disc >= 0.07) & (disc < 0.09)).alias("is_99214"),
        _flag(disc >= 0.09).alias("is_99215"),
        F.col("is_referral"),
        F.col("is_eye_procedure"),
        F.col("l_quantity").alias("member_provider_distance"),
        _flag(F.col("l_suppkey") % 5 == 0).alias("fraud_provider_label"),
        *([F.col("l_suppkey").alias(PLACED_BY)] if tasks is not None else []),
    )


def last_service_date(spark: SparkSession, sf_dir: str, days: int = 31) -> dt.date | None:
    """The latest date of a claim.  Claims of the line items' last ``days`` are joined, and all of them only if there are none."""
    last = read(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]
    if last is None:
        return None
    newest = F.max("service_date")
    near = claims(spark, sf_dir, start=last - dt.timedelta(days=days)).agg(newest).first()[0]
    return near if near is not None else claims(spark, sf_dir).agg(newest).first()[0]


def claim_load(spark: SparkSession, sf_dir: str, hot_rows: int = 1_000_000) -> tuple[int, list[str]]:
    """Line items, and the providers with more than ``hot_rows`` of them (or than a thousandth of all: 1,000 at most).  Joins nothing."""
    per = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    rows = per.agg(F.sum("n")).first()[0] or 0
    hot = per.where((F.col("n") > max(hot_rows, rows // 1000)) & F.col("l_suppkey").isNotNull())
    return rows, [str(r.l_suppkey) for r in hot.select("l_suppkey").collect()]


def _run_no(ts: Column) -> Column:
    return F.floor((F.dayofmonth(ts) - 1) / RUN_DAYS).cast("int")


def _run_created_at(run_no: Column) -> Column:
    return (F.lit(RUN_EPOCH).cast("timestamp")
            + F.make_dt_interval(days=(run_no + 1) * RUN_DAYS))


def raw_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw batch output per (model, run, provider): score in [0, 1] plus lineage."""
    ev = read(spark, sf_dir, "events").where(F.col("event_type").isin(*MODEL_BY_EVENT))
    model = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in MODEL_BY_EVENT.items()])
    g = (ev.select(model.alias("model_name"), _run_no(F.col("ts")).alias("run_no"),
                   F.col("user_id"), F.col("value").cast("decimal(18,2)").alias("v"))
           .groupBy("model_name", "run_no", "user_id")
           .agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")))
    created = _run_created_at(F.col("run_no"))
    return g.select(
        created.cast("date").alias("prediction_date"),
        F.col("user_id").cast("string").alias("provider_id"),
        F.concat(F.lit("exp-"), F.col("model_name")).alias("experiment_id"),
        F.concat_ws("-", F.col("model_name"), F.col("run_no").cast("string")).alias("run_id"),
        F.col("model_name"),
        F.concat(F.col("model_name"), F.lit(":1")).alias("model_version"),
        F.least(F.col("s").cast("double") / F.col("n") / F.lit(100.0), F.lit(1.0)).alias("fraud_score"),
        created.alias("created_at"),
    )


def raw_classes(spark: SparkSession, sf_dir: str, model_name: str = "isolation_forest") -> DataFrame:
    """Raw class output of a classifier run: isolation forest '-1' (anomaly) / '1',
    random forest '1' / '0', derived from the score at 0.5."""
    pos, neg = ("-1", "1") if model_name == "isolation_forest" else ("1", "0")
    p = raw_predictions(spark, sf_dir).where(F.col("model_name") == model_name)
    return p.select("provider_id", "run_id", "model_name", "model_version", "created_at",
                    F.when(F.col("fraud_score") >= 0.5, F.lit(pos)).otherwise(F.lit(neg)).alias("prediction"))


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case per (provider, run) with an error event, attached to the xgboost model.

    Every case is a row; those with too few events are ``PENDING`` and have no outcome yet.
    """
    ev = read(spark, sf_dir, "events").where(F.col("event_type") == FEEDBACK_EVENT)
    g = (ev.select(F.col("user_id"), _run_no(F.col("ts")).alias("run_no"), F.col("value"),
                   F.col("value").cast("decimal(18,2)").alias("v"), F.col("ts"))
           .groupBy("user_id", "run_no")
           .agg(F.max("value").alias("mx"), F.sum("v").alias("s"), F.max("ts").alias("last_ts"),
                F.count(F.lit(1)).alias("n")))
    done = F.col("n") >= COMPLETED_MIN_EVENTS
    confirmed = F.when(done, F.col("mx") > CONFIRM_ABOVE)
    return g.select(
        F.concat_ws("-", F.lit("INV"), F.col("user_id").cast("string"), F.col("run_no").cast("string")).alias("investigation_id"),
        F.col("user_id").cast("string").alias("provider_id"),
        F.lit(f"{FEEDBACK_MODEL}:1").alias("model_version"),
        F.when(~done, F.lit("PENDING")).when(confirmed, F.lit("CONFIRMED_FRAUD"))
         .otherwise(F.lit("CONFIRMED_NORMAL")).alias("investigation_result"),
        confirmed.alias("confirmed_fraud"),
        F.when(done, F.when(confirmed, F.col("s")).otherwise(F.lit(0))).cast("decimal(18,2)").alias("fraud_amount"),
        F.col("last_ts").cast("date").alias("investigation_date"),
        F.lit("synthetic_team").alias("investigator"),
        F.col("last_ts").cast("timestamp").alias("created_at"),
        F.concat_ws("-", F.lit(FEEDBACK_MODEL), F.col("run_no").cast("string")).alias("run_id"),
        F.lit(FEEDBACK_MODEL).alias("model_name"),
    )


def experiment_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run row per (model, run) seen in the events; the last random-forest run failed."""
    ev = read(spark, sf_dir, "events").where(F.col("event_type").isin(*MODEL_BY_EVENT))
    model = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in MODEL_BY_EVENT.items()])
    g = (ev.select(model.alias("model_type"), _run_no(F.col("ts")).alias("run_no"), F.col("ts"))
           .groupBy("model_type", "run_no")
           .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))
    return g.select(
        F.concat(F.lit("exp-"), F.col("model_type")).alias("experiment_id"),
        F.concat_ws("-", F.col("model_type"), F.col("run_no").cast("string")).alias("run_id"),
        F.concat(F.lit("provider_fraud_"), F.col("model_type")).alias("experiment_name"),
        F.lit("data_science_team").alias("owner"),
        F.col("model_type"),
        F.lit("features_v1").alias("feature_version"),
        F.concat(F.lit("events_run_"), F.col("run_no").cast("string")).alias("dataset_version"),
        F.lit("local").alias("git_commit"),
        F.col("first_ts").cast("date").alias("training_start"),
        F.col("last_ts").cast("date").alias("training_end"),
        F.when((F.col("model_type") == "random_forest") & (F.col("run_no") == 2), F.lit("FAILED"))
         .otherwise(F.lit("SUCCEEDED")).alias("status"),
        _run_created_at(F.col("run_no")).alias("created_at"),
    )


# ---------------------------------------------------------------------------
# DuckDB forms of the same adapters (used only by the oracle SQL).
# ---------------------------------------------------------------------------

CLAIMS_SQL = """
SELECT
  CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS claim_id,
  CAST(o.o_orderdate AS DATE) AS claim_date,
  CAST(l.l_suppkey AS VARCHAR) AS provider_id,
  s.s_name AS provider_name,
  p.p_type AS provider_specialty,
  CAST(o.o_custkey AS VARCHAR) AS member_id,
  CAST(l.l_shipdate AS DATE) AS service_date,
  n.n_name AS provider_city,
  r.r_name AS provider_state,
  p.p_brand AS cpt_code,
  p.p_name AS icd_code,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_billed_amt,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(0.9 AS DECIMAL(2,1)) AS DECIMAL(18,3)) AS total_allowed_amt,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS total_paid_amount,
  l.l_linenumber AS place_of_service,
  CASE WHEN l.l_discount >= 0.07 THEN 1 ELSE 0 END AS is_high_acuity_em,
  CASE WHEN l.l_discount >= 0.07 AND l.l_discount < 0.09 THEN 1 ELSE 0 END AS is_99214,
  CASE WHEN l.l_discount >= 0.09 THEN 1 ELSE 0 END AS is_99215,
  CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS is_referral,
  CASE WHEN p.p_size <= 10 THEN 1 ELSE 0 END AS is_eye_procedure,
  l.l_quantity AS member_provider_distance,
  CASE WHEN l.l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS fraud_provider_label
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_MODEL_CASE = ("CASE event_type WHEN 'view' THEN 'isolation_forest' WHEN 'click' THEN 'xgboost' "
               "WHEN 'purchase' THEN 'random_forest' END")
_RUN_NO = "CAST(FLOOR((day(ts) - 1) / 10) AS INTEGER)"

RAW_PREDICTIONS_SQL = f"""
SELECT
  CAST(TIMESTAMP '{RUN_EPOCH}' + INTERVAL (10 * (run_no + 1)) DAY AS DATE) AS prediction_date,
  CAST(user_id AS VARCHAR) AS provider_id,
  'exp-' || model_name AS experiment_id,
  model_name || '-' || CAST(run_no AS VARCHAR) AS run_id,
  model_name,
  model_name || ':1' AS model_version,
  LEAST(CAST(s AS DOUBLE) / n / 100.0, 1.0) AS fraud_score,
  TIMESTAMP '{RUN_EPOCH}' + INTERVAL (10 * (run_no + 1)) DAY AS created_at
FROM (
  SELECT {_MODEL_CASE} AS model_name, {_RUN_NO} AS run_no, user_id,
         SUM(CAST(value AS DECIMAL(18,2))) AS s, COUNT(*) AS n
  FROM events WHERE event_type IN ('view', 'click', 'purchase')
  GROUP BY 1, 2, 3
) g
"""

def raw_classes_sql(model_name: str = "isolation_forest") -> str:
    pos, neg = ("-1", "1") if model_name == "isolation_forest" else ("1", "0")
    return (f"SELECT provider_id, run_id, model_name, model_version, created_at, "
            f"CASE WHEN fraud_score >= 0.5 THEN '{pos}' ELSE '{neg}' END AS prediction "
            f"FROM ({RAW_PREDICTIONS_SQL}) WHERE model_name = '{model_name}'")


FEEDBACK_SQL = f"""
SELECT
  'INV-' || CAST(user_id AS VARCHAR) || '-' || CAST(run_no AS VARCHAR) AS investigation_id,
  CAST(user_id AS VARCHAR) AS provider_id,
  'xgboost:1' AS model_version,
  CASE WHEN n < 5 THEN 'PENDING' WHEN mx > 100 THEN 'CONFIRMED_FRAUD' ELSE 'CONFIRMED_NORMAL' END AS investigation_result,
  CASE WHEN n >= 5 THEN mx > 100 END AS confirmed_fraud,
  CAST(CASE WHEN n < 5 THEN NULL WHEN mx > 100 THEN s ELSE 0 END AS DECIMAL(18,2)) AS fraud_amount,
  CAST(last_ts AS DATE) AS investigation_date,
  'synthetic_team' AS investigator,
  CAST(last_ts AS TIMESTAMP) AS created_at,
  'xgboost-' || CAST(run_no AS VARCHAR) AS run_id,
  'xgboost' AS model_name
FROM (
  SELECT user_id, {_RUN_NO} AS run_no, MAX(value) AS mx,
         SUM(CAST(value AS DECIMAL(18,2))) AS s, MAX(ts) AS last_ts, COUNT(*) AS n
  FROM events WHERE event_type = 'error'
  GROUP BY 1, 2
) g
"""

EXPERIMENT_RUNS_SQL = f"""
SELECT
  'exp-' || model_type AS experiment_id,
  model_type || '-' || CAST(run_no AS VARCHAR) AS run_id,
  'provider_fraud_' || model_type AS experiment_name,
  'data_science_team' AS owner,
  model_type,
  'features_v1' AS feature_version,
  'events_run_' || CAST(run_no AS VARCHAR) AS dataset_version,
  'local' AS git_commit,
  CAST(first_ts AS DATE) AS training_start,
  CAST(last_ts AS DATE) AS training_end,
  CASE WHEN model_type = 'random_forest' AND run_no = 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
  TIMESTAMP '{RUN_EPOCH}' + INTERVAL (10 * (run_no + 1)) DAY AS created_at
FROM (
  SELECT {_MODEL_CASE} AS model_type, {_RUN_NO} AS run_no, MIN(ts) AS first_ts, MAX(ts) AS last_ts
  FROM events WHERE event_type IN ('view', 'click', 'purchase')
  GROUP BY 1, 2
) g
"""


def claims_window_sql(start: dt.date | None = None, end: dt.date | None = None) -> str:
    """Claims CTE body limited to a service-date window (mirrors the Spark pushdown)."""
    conds = []
    if start is not None:
        conds.append(f"CAST(l.l_shipdate AS DATE) >= DATE '{start.isoformat()}'")
    if end is not None:
        conds.append(f"CAST(l.l_shipdate AS DATE) <= DATE '{end.isoformat()}'")
    return CLAIMS_SQL + (" WHERE " + " AND ".join(conds) if conds else "")


# ---------------------------------------------------------------------------
# Governance and experiment-tracking tables derived from the run table.
# ---------------------------------------------------------------------------
RESOURCE_PREFIX = "registry/models/"
STATE_KEY_PREFIX = "provider_fraud_"


def training_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state row per model type: latest run = candidate, the run before = approved.

    The run table has one row per (model, run) -- tiny by construction -- so a
    window over it is bounded.
    """
    from pyspark.sql import Window
    runs = experiment_runs(spark, sf_dir)
    w = Window.partitionBy("model_type").orderBy(F.col("created_at").desc(), F.col("run_id").desc())
    r = runs.withColumn("rn", F.row_number().over(w))
    c = r.where("rn = 1").alias("c")
    a = r.where("rn = 2").alias("a")
    j = c.join(a, "model_type", "left")
    return j.select(
        F.concat(F.lit(STATE_KEY_PREFIX), F.col("model_type")).alias("model_name"),
        F.trunc(F.col("a.training_end"), "month").alias("last_training_data_month"),
        F.col("a.created_at").alias("last_training_timestamp"),
        F.when(F.col("c.status") == "SUCCEEDED", F.lit("PENDING_APPROVAL")).otherwise(F.lit("REJECTED")).alias("candidate_status"),
        F.concat(F.lit(RESOURCE_PREFIX), F.lit("2")).alias("candidate_model_resource"),
        F.trunc(F.col("c.training_end"), "month").alias("candidate_data_month"),
        F.col("c.created_at").alias("candidate_created_at"),
        F.sha2(F.col("a.feature_version"), 256).alias("approved_feature_signature"),
        F.sha2(F.col("c.feature_version"), 256).alias("candidate_feature_signature"),
        F.sha2(F.col("a.run_id"), 256).alias("approved_model_signature"),
        F.sha2(F.col("c.run_id"), 256).alias("candidate_model_signature"),
        F.col("model_type").alias("approved_model_type"),
        F.col("model_type").alias("candidate_model_type"),
        F.col("a.run_id").alias("approved_run_id"),
        F.col("c.run_id").alias("candidate_run_id"),
        F.concat(F.lit(RESOURCE_PREFIX), F.lit("1")).alias("approved_model_resource"),
    )


TRAINING_STATE_SQL = f"""
SELECT '{STATE_KEY_PREFIX}' || c.model_type AS model_name,
  CAST(date_trunc('month', a.training_end) AS DATE) AS last_training_data_month,
  a.created_at AS last_training_timestamp,
  CASE WHEN c.status = 'SUCCEEDED' THEN 'PENDING_APPROVAL' ELSE 'REJECTED' END AS candidate_status,
  '{RESOURCE_PREFIX}2' AS candidate_model_resource,
  CAST(date_trunc('month', c.training_end) AS DATE) AS candidate_data_month,
  c.created_at AS candidate_created_at,
  sha256(a.feature_version) AS approved_feature_signature, sha256(c.feature_version) AS candidate_feature_signature,
  sha256(a.run_id) AS approved_model_signature, sha256(c.run_id) AS candidate_model_signature,
  c.model_type AS approved_model_type, c.model_type AS candidate_model_type,
  a.run_id AS approved_run_id, c.run_id AS candidate_run_id,
  '{RESOURCE_PREFIX}1' AS approved_model_resource
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_type ORDER BY created_at DESC, run_id DESC) AS rn FROM ({EXPERIMENT_RUNS_SQL})) c
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_type ORDER BY created_at DESC, run_id DESC) AS rn FROM ({EXPERIMENT_RUNS_SQL})) a
  ON c.model_type = a.model_type AND a.rn = 2
WHERE c.rn = 1
"""

TRAINING_THRESHOLD = 0.4
SCORE_METRICS = ["provider_count", "flagged_provider_count", "alert_rate", "mean_score", "max_score"]


def experiment_metrics(spark: SparkSession, sf_dir: str, preds: DataFrame | None = None,
                       cases: DataFrame | None = None) -> DataFrame:
    """Long metric rows per run: score summary of every run plus precision / recall /
    F1 at the training threshold for runs with investigator feedback.

    ``preds`` and ``cases`` (predictions joined to outcomes) are read several times: they are
    tables, made here unless the caller has them.
    """
    from ..functions.ranking import materialize
    from ..operators.performance import confusion, matched_cases
    p = preds if preds is not None else materialize(raw_predictions(spark, sf_dir))
    m = cases if cases is not None else materialize(matched_cases(p, feedback(spark, sf_dir)))
    m = m.withColumn("predicted_fraud", F.when(F.col("fraud_score") >= TRAINING_THRESHOLD, 1).otherwise(0))
    s = p.groupBy("experiment_id", "run_id").agg(
        F.count(F.lit(1)).cast("double").alias("provider_count"),
        F.count_if(F.col("fraud_score") >= 0.5).cast("double").alias("flagged_provider_count"),
        F.avg("fraud_score").alias("mean_score"), F.max("fraud_score").alias("max_score"),
        F.max("created_at").alias("created_at"))
    s = s.withColumn("alert_rate", F.col("flagged_provider_count") / F.col("provider_count"))
    long1 = s.unpivot(["experiment_id", "run_id", "created_at"], SCORE_METRICS, "metric_name", "metric_value")
    conf = confusion(m)
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    c = conf.select("run_id", F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
                    F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"))
    c = c.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                        2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(0.0))
    from ..operators.models import classification_metrics
    ap = classification_metrics(m, group_by=["run_id"]).select("run_id", F.col("average_precision").alias("pr_auc"))
    c = c.join(ap, "run_id", "left")
    runs_meta = s.select("experiment_id", "run_id", "created_at")
    long2 = c.join(runs_meta, "run_id").unpivot(["experiment_id", "run_id", "created_at"],
                                                ["precision", "recall", "f1_score", "pr_auc"], "metric_name",
                                                "metric_value")
    cols = ["experiment_id", "run_id", "metric_name", "metric_value", "created_at"]
    return long1.select(*cols).unionByName(long2.select(*cols))


EXPERIMENT_METRICS_SQL = f"""
WITH p AS ({RAW_PREDICTIONS_SQL}), f AS ({FEEDBACK_SQL}),
s AS (SELECT experiment_id, run_id, CAST(COUNT(*) AS DOUBLE) AS provider_count,
        CAST(COUNT(*) FILTER (WHERE fraud_score >= 0.5) AS DOUBLE) AS flagged_provider_count,
        AVG(fraud_score) AS mean_score, MAX(fraud_score) AS max_score, MAX(created_at) AS created_at
      FROM p GROUP BY 1, 2),
m AS (SELECT p.run_id, COUNT(*) FILTER (WHERE p.fraud_score >= {TRAINING_THRESHOLD} AND f.investigation_result = 'CONFIRMED_FRAUD') AS tp,
        COUNT(*) FILTER (WHERE p.fraud_score >= {TRAINING_THRESHOLD} AND f.investigation_result <> 'CONFIRMED_FRAUD') AS fp,
        COUNT(*) FILTER (WHERE p.fraud_score < {TRAINING_THRESHOLD} AND f.investigation_result = 'CONFIRMED_FRAUD') AS fn
      FROM p JOIN f ON p.provider_id = f.provider_id AND p.run_id = f.run_id AND p.model_version = f.model_version
      WHERE f.model_name = p.model_name AND f.investigation_result IN ('CONFIRMED_FRAUD', 'CONFIRMED_NORMAL')
      GROUP BY p.run_id),
c AS (SELECT run_id, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM m),
mt AS (SELECT p.run_id, p.fraud_score AS sc, CASE WHEN f.investigation_result = 'CONFIRMED_FRAUD' THEN 1 ELSE 0 END AS y
       FROM p JOIN f ON p.provider_id = f.provider_id AND p.run_id = f.run_id AND p.model_version = f.model_version
       WHERE f.model_name = p.model_name AND f.investigation_result IN ('CONFIRMED_FRAUD', 'CONFIRMED_NORMAL')),
per AS (SELECT run_id, sc, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM mt GROUP BY 1, 2),
cum AS (SELECT *, SUM(pos) OVER (PARTITION BY run_id ORDER BY sc DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
          SUM(neg) OVER (PARTITION BY run_id ORDER BY sc DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
          SUM(pos) OVER (PARTITION BY run_id) AS tp_all FROM per),
ap AS (SELECT run_id, SUM(CASE WHEN tp_all = 0 THEN NULL ELSE pos / tp_all END * cp / (cp + cn)) AS pr_auc FROM cum GROUP BY 1),
c2 AS (SELECT c.*, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score,
         ap.pr_auc FROM c LEFT JOIN ap USING (run_id)),
s2 AS (SELECT *, flagged_provider_count / provider_count AS alert_rate FROM s)
SELECT experiment_id, run_id, metric_name, metric_value, created_at FROM (
  SELECT experiment_id, run_id, created_at, provider_count, flagged_provider_count, alert_rate, mean_score, max_score FROM s2)
  UNPIVOT (metric_value FOR metric_name IN (provider_count, flagged_provider_count, alert_rate, mean_score, max_score))
UNION ALL
SELECT experiment_id, run_id, metric_name, metric_value, created_at FROM (
  SELECT s2.experiment_id, c2.run_id, s2.created_at, c2.precision, c2.recall, c2.f1_score, c2.pr_auc FROM c2 JOIN s2 USING (run_id))
  UNPIVOT (metric_value FOR metric_name IN (precision, recall, f1_score, pr_auc))
"""


def approval_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release log derived from the run table: a PROMOTION per succeeded run (from the
    previous run to it) and a ROLLBACK per failed run (from the previous run back to
    the one before).  Isolation-forest events are legacy rows without the
    ``from_feature_signature`` (an incomplete snapshot)."""
    from pyspark.sql import Window
    r = experiment_runs(spark, sf_dir).select(
        "run_id", "model_type", "status", "created_at", "feature_version",
        F.regexp_extract("run_id", r"-([0-9]+)$", 1).alias("run_no"),
        F.trunc("training_end", "month").alias("data_month"))
    snap = lambda p: [F.concat(F.lit(RESOURCE_PREFIX), F.col("run_no")).alias(f"{p}model_resource"),
                      F.col("run_id").alias(f"{p}run_id"), F.col("model_type").alias(f"{p}model_type"),
                      F.sha2(F.col("feature_version"), 256).alias(f"{p}feature_signature"),
                      F.sha2(F.col("run_id"), 256).alias(f"{p}model_signature"),
                      F.col("data_month").alias(f"{p}data_month"), F.col("created_at").alias(f"{p}training_timestamp")]
    snaps = r.select("model_type", "run_id", "status", "created_at", F.struct(*snap("")).alias("snap"))
    w = Window.partitionBy("model_type").orderBy("created_at", "run_id")  # run table: one row per run
    snaps = snaps.select("*", F.lag("snap", 1).over(w).alias("prev"), F.lag("snap", 2).over(w).alias("prev2"))
    names = ["model_resource", "run_id", "model_type", "feature_signature", "model_signature", "data_month",
             "training_timestamp"]
    legacy = F.col("model_type") == "isolation_forest"

    def event(kind, days, src, dst):
        cols = [F.col(f"{src}.{n}").alias(f"from_{n}") if not (n == "feature_signature")
                else F.when(legacy, F.lit(None).cast("string")).otherwise(F.col(f"{src}.{n}")).alias(f"from_{n}")
                for n in names]
        return [F.concat(F.lit(kind[:5] + "-"), F.col("run_id")).alias("event_id"),
                F.concat(F.lit(STATE_KEY_PREFIX), F.col("model_type")).alias("state_key"),
                (F.col("created_at") + F.make_dt_interval(days=F.lit(days))).alias("event_time"),
                F.lit(kind).alias("event_type"), F.lit("approver").alias("actor"),
                F.lit("monthly release" if kind == "PROMOTION" else "failed run").alias("reason"), *cols,
                *[F.col(f"{dst}.{n}").alias(f"to_{n}") for n in names]]
    promo = snaps.where(F.col("status") == "SUCCEEDED").select(*event("PROMOTION", 1, "prev", "snap"))
    rollback = snaps.where((F.col("status") == "FAILED") & F.col("prev2").isNotNull()).select(
        *event("ROLLBACK", 2, "prev", "prev2"))
    return promo.unionByName(rollback)


def _ledger_snap(alias, prefix, legacy_null_feature=False):
    fs = f"{alias}_feature_signature"
    fsig = f"CASE WHEN model_type = 'isolation_forest' THEN NULL ELSE {fs} END" if legacy_null_feature else fs
    return (f"{alias}_model_resource AS {prefix}model_resource, {alias}_run_id AS {prefix}run_id, "
            f"{alias}_model_type AS {prefix}model_type, {fsig} AS {prefix}feature_signature, "
            f"{alias}_model_signature AS {prefix}model_signature, {alias}_data_month AS {prefix}data_month, "
            f"{alias}_training_timestamp AS {prefix}training_timestamp")


_SNAP_COLS = ["model_resource", "run_id", "model_type", "feature_signature", "model_signature", "data_month",
              "training_timestamp"]
_LAGS = ", ".join(f"LAG(s_{c}, {k}) OVER (PARTITION BY model_type ORDER BY created_at, run_id) AS {a}_{c}"
                  for k, a in ((1, "p"), (2, "q")) for c in _SNAP_COLS)
APPROVAL_LEDGER_SQL = f"""
WITH r AS (SELECT run_id, model_type, status, created_at,
             '{RESOURCE_PREFIX}' || regexp_extract(run_id, '-([0-9]+)$', 1) AS s_model_resource, run_id AS s_run_id,
             model_type AS s_model_type, sha256(feature_version) AS s_feature_signature, sha256(run_id) AS s_model_signature,
             CAST(date_trunc('month', training_end) AS DATE) AS s_data_month, created_at AS s_training_timestamp
           FROM ({EXPERIMENT_RUNS_SQL})),
l AS (SELECT *, {_LAGS} FROM r)
SELECT 'PROMO-' || run_id AS event_id, '{STATE_KEY_PREFIX}' || model_type AS state_key,
  created_at + INTERVAL 1 DAY AS event_time, 'PROMOTION' AS event_type, 'approver' AS actor, 'monthly release' AS reason,
  {_ledger_snap('p', 'from_', True)}, {_ledger_snap('s', 'to_')}
FROM l WHERE status = 'SUCCEEDED'
UNION ALL
SELECT 'ROLLB-' || run_id, '{STATE_KEY_PREFIX}' || model_type, created_at + INTERVAL 2 DAY, 'ROLLBACK', 'approver',
  'failed run', {_ledger_snap('p', 'from_', True)}, {_ledger_snap('q', 'to_')}
FROM l WHERE status = 'FAILED' AND q_run_id IS NOT NULL
"""
