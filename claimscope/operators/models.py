"""Model training and evaluation.

* Supervised models are ``pyspark.ml`` estimators (distributed fit/transform).
* The isolation forest (not in ``pyspark.ml``) samples <= ``max_samples`` rows
  per tree with a hash-ordered top-k (a uniform sample without replacement),
  builds every tree in parallel with ``applyInPandas`` (one tree per group,
  bounded size) and scores with ``mapInPandas`` against the broadcast forest
  (300 trees x <= 511 nodes: a fitted model of bounded size, like any MLlib model).
* Ranking metrics aggregate by distinct score first and use distributed
  running sums, so they are exact with ties and never sort a run in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach_scalars, count_if, validate_names
from ..functions.ranking import quantile_cont, running_sums, top_k_per_group

# Model hyper-parameters of the pipeline configuration.
RF_PARAMS = {"n_estimators": 300, "max_depth": 5, "min_samples_leaf": 2, "class_weight": "balanced",
             "random_state": 42}
GBT_PARAMS = {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.05, "subsample": 0.80,
              "colsample_bytree": 0.80, "scale_pos_weight": 9.0, "random_state": 42}
IF_PARAMS = {"n_estimators": 300, "max_samples": 256, "contamination": 0.10, "random_state": 42}
SWEEP_THRESHOLDS = (0.2, 0.3, 0.4, 0.5)


# T1 -----------------------------------------------------------------------------
def training_readiness(features: DataFrame, cols: Sequence[str], label: str = "fraud_label",
                       splits: Sequence[str] = ("TRAIN", "TEST")) -> DataFrame:
    """Per split: rows, classes present, NULL feature values -> READY / NOT_READY."""
    cols = validate_names(cols)
    nulls = None
    for c in cols:
        x = count_if(F.col(c).isNull())
        nulls = x if nulls is None else nulls + x
    agg = features.where(F.col("dataset_split").isin(*splits)).groupBy("dataset_split").agg(
        F.count(F.lit(1)).alias("row_count"), count_if(F.col(label) == 1).alias("positive_count"),
        count_if(F.col(label) == 0).alias("negative_count"), nulls.alias("null_feature_values"))
    want = features.sparkSession.createDataFrame([(s,) for s in splits], "dataset_split string")
    j = want.join(agg, "dataset_split", "left").na.fill(0, ["row_count", "positive_count", "negative_count",
                                                             "null_feature_values"])
    reason = (F.when(F.col("row_count") == 0, "split is empty")
               .when((F.col("positive_count") == 0) | (F.col("negative_count") == 0), "only one class present")
               .when(F.col("null_feature_values") > 0, "NULL feature values"))
    return j.select("*", F.when(reason.isNull(), "READY").otherwise("NOT_READY").alias("status"),
                    reason.alias("reason"))


# weights ---------------------------------------------------------------------------
def balanced_weights(df: DataFrame, label: str = "fraud_label", out: str = "weight") -> DataFrame:
    """``n / (2 * n_class)`` per row (scikit-learn 'balanced'); the class table has 2 rows."""
    cls = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = df.agg(F.count(F.lit(1)).alias("__n"))
    k = cls.agg(F.count(F.lit(1)).alias("__k"))
    w = attach_scalars(attach_scalars(cls, tot), k).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out))
    return df.join(w, label, "left")


#: Rows of a training task, and tasks that a small table is dealt to all the same.
TRAINING_ROWS, TRAINING_TASKS = 20_000, 8


def _training_layout(d: DataFrame, id_col: str = "provider_id") -> DataFrame:
    """Cache the assembled training set, dealt by provider id into tasks of about ``TRAINING_ROWS`` rows.

    Tree learners make one pass per level (and per boosting round), so the input is read
    thousands of times: caching avoids recomputing the features, and each pass has as many tasks as the
    rows need, not as many as a shuffle of the claims gets.  The session's shuffle partitions are the most.
    """
    most = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(most, max(TRAINING_TASKS, -(-d.count() // TRAINING_ROWS)))
    return d.repartition(n, id_col).sortWithinPartitions(id_col).persist()


def _assemble(df: DataFrame, cols: Sequence[str], out: str = "features"):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# T2 -----------------------------------------------------------------------------
def train_random_forest(train: DataFrame, cols: Sequence[str], params: Mapping = RF_PARAMS,
                        label: str = "fraud_label"):
    """Random forest with balanced class weights (``weightCol``)."""
    from pyspark.ml.classification import RandomForestClassifier
    cols = validate_names(cols)
    d = _training_layout(_assemble(balanced_weights(train, label), cols).withColumn("label", F.col(label).cast("double")))
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                numTrees=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
                                minInstancesPerNode=int(params["min_samples_leaf"]),
                                seed=int(params["random_state"]), featureSubsetStrategy="sqrt")
    try:
        return rf.fit(d)
    finally:
        d.unpersist()


# T3 -----------------------------------------------------------------------------
def train_gbt(train: DataFrame, cols: Sequence[str], params: Mapping = GBT_PARAMS, label: str = "fraud_label"):
    """Gradient-boosted trees; positives weighted by ``scale_pos_weight``."""
    from pyspark.ml.classification import GBTClassifier
    cols = validate_names(cols)
    d = _training_layout(_assemble(train, cols).withColumn("label", F.col(label).cast("double")).withColumn(
        "weight", F.when(F.col(label) == 1, F.lit(float(params["scale_pos_weight"]))).otherwise(F.lit(1.0))))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                        maxIter=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
                        stepSize=float(params["learning_rate"]), subsamplingRate=float(params["subsample"]),
                        featureSubsetStrategy=str(params["colsample_bytree"]), seed=int(params["random_state"]))
    try:
        return gbt.fit(d)
    finally:
        d.unpersist()


# T4 -----------------------------------------------------------------------------
def standardise(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """T4: z-score with TRAIN mean and population std (std 0 -> divide by 1)."""
    stats = train.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    def apply(df):
        j = attach_scalars(df, stats)  # 1-row statistics
        outs = []
        for c in cols:
            s = F.when(F.col(f"__s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"__s_{c}"))
            outs.append(((F.col(c) - F.col(f"__m_{c}")) / s).alias(c))
        return j.select(*[F.col(x) for x in df.columns if x not in cols], *outs)
    return apply(train), apply(test)


# T5 -----------------------------------------------------------------------------
def _c(n):
    """Average unsuccessful-search path length in a BST of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    return out


_TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size long, depth int"


def _build_tree(pdf: pd.DataFrame, cols: Sequence[str], seed: int, height_limit: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    X = pdf[list(cols)].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    rows = []
    stack = [(np.arange(len(X)), 0, 0)]
    next_id = 1
    while stack:
        idx, node, depth = stack.pop()
        sub = X[idx]
        if depth >= height_limit or len(idx) <= 1:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        lo, hi = np.nanmin(sub, axis=0), np.nanmax(sub, axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        q = int(rng.choice(usable))
        thr = float(rng.uniform(lo[q], hi[q]))
        go_left = sub[:, q] < thr
        left, right = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, q, thr, left, right, len(idx), depth))
        stack.append((idx[~go_left], right, depth + 1))
        stack.append((idx[go_left], left, depth + 1))
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])


_HASHES = 1 << 63
#: Nodes of a forest that are collected and broadcast at most.
MOST_NODES = 5_000_000


def sample_cut(psi: int, n: int) -> int:
    """Largest hash of a candidate: four times as many candidates as samples are expected at any ``n``."""
    return min(_HASHES - 1, max(1, _HASHES * 4 * psi // n))


def fit_isolation_forest(train: DataFrame, cols: Sequence[str], params: Mapping = IF_PARAMS,
                         id_col: str = "provider_id") -> DataFrame:
    """Tree table of an isolation forest fitted on ``train`` (standardised features)."""
    n_trees, max_samples, seed = int(params["n_estimators"]), int(params["max_samples"]), int(params["random_state"])
    n = train.count()  # one scalar: sizes the per-tree candidate rate
    if n == 0:
        raise ValueError("empty training data")
    psi = min(max_samples, n)
    cut = sample_cut(psi, n)
    # a row is a candidate of tree t when its 63-bit hash for t is below the cut
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                     lambda t: F.xxhash64(F.col(id_col).cast("string"), F.lit(seed), t).bitwiseAND(F.lit(_HASHES - 1)) <= cut)
    cand = train.select(id_col, *cols, F.explode(trees).alias("tree")).withColumn(
        "__h", F.xxhash64(F.col(id_col).cast("string"), F.lit(seed + 1), F.col("tree")))
    sample = top_k_per_group(cand, ["tree"], [F.col("__h"), F.col(id_col)], psi, rank_col="__r")
    limit = int(math.ceil(math.log2(max(psi, 2))))
    cols = list(cols)
    return sample.select("tree", *cols).groupBy("tree").applyInPandas(
        lambda pdf: _build_tree(pdf, cols, seed, limit), schema=_TREE_SCHEMA).withColumn(
        "psi", F.lit(psi)).withColumn("n_trees", F.lit(n_trees))


def forest_model(forest: DataFrame):
    """Collect a fitted tree table into arrays.

    The table has at most n_trees x (2^(limit+1) - 1) nodes; more than ``MOST_NODES`` is an
    error, as is a tree that is missing or was built from fewer than psi rows.
    """
    nodes = forest.orderBy("tree", "node").limit(MOST_NODES + 1).collect()
    if not nodes:
        raise ValueError("empty forest")
    if len(nodes) > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes: lower n_estimators or max_samples")
    psi = int(nodes[0]["psi"])
    n_trees = max(r["tree"] for r in nodes) + 1
    leaves: dict[int, int] = {}
    for r in nodes:
        if r["feature"] < 0:
            leaves[r["tree"]] = leaves.get(r["tree"], 0) + r["size"]
    if len(leaves) != int(nodes[0]["n_trees"]) or any(k != psi for k in leaves.values()):
        raise ValueError("a tree is missing or has fewer rows than the sample size")
    size = max(r["node"] for r in nodes) + 1
    feat = np.full((n_trees, size), -1, dtype=np.int64)
    thr = np.zeros((n_trees, size))
    left = np.full((n_trees, size), -1, dtype=np.int64)
    right = np.full((n_trees, size), -1, dtype=np.int64)
    leaf_adj = np.zeros((n_trees, size))
    depth = np.zeros((n_trees, size))
    for r in nodes:
        t, k = r["tree"], r["node"]
        feat[t, k], thr[t, k], left[t, k], right[t, k], depth[t, k] = (
            r["feature"], r["threshold"], r["left"], r["right"], r["depth"])
        leaf_adj[t, k] = _c(np.array([r["size"]]))[0] if r["feature"] < 0 else 0.0
    present = np.zeros(n_trees, dtype=bool)
    present[sorted({r["tree"] for r in nodes})] = True
    return feat, thr, left, right, leaf_adj, depth, present, psi


def score_isolation_forest(df: DataFrame, model, cols: Sequence[str], id_col: str = "provider_id") -> DataFrame:
    """Anomaly score 2^(-E[h(x)] / c(psi)) for every row of ``df`` (higher = more anomalous).

    ``model`` is a ``forest_model`` tuple or a broadcast of one; rows are scored
    in Arrow batches by ``mapInPandas``, every tree walked with numpy.
    """
    sc = df.sparkSession.sparkContext
    bc = model if hasattr(model, "value") else sc.broadcast(model)
    cols = list(cols)

    def score(it):
        f_, t_, l_, r_, a_, d_, p_, psi_ = bc.value
        cpsi = float(_c(np.array([psi_]))[0]) or 1.0
        trees = np.flatnonzero(p_)
        for pdf in it:
            X = pdf[cols].to_numpy(dtype=float)
            total = np.zeros(len(X))
            rows = np.arange(len(X))
            for t in trees:
                node = np.zeros(len(X), dtype=np.int64)
                while True:
                    fi = f_[t, node]
                    inner = fi >= 0
                    if not inner.any():
                        break
                    xv = X[rows[inner], fi[inner]]
                    node[inner] = np.where(xv < t_[t, node[inner]], l_[t, node[inner]], r_[t, node[inner]])
                total += d_[t, node] + a_[t, node]
            e = total / max(len(trees), 1)
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), "fraud_score": np.power(2.0, -e / cpsi)})

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, *cols).mapInPandas(score, schema=f"{id_col} {id_type}, fraud_score double")


def isolation_forest(train: DataFrame, test: DataFrame, cols: Sequence[str], params: Mapping = IF_PARAMS,
                     id_col: str = "provider_id") -> DataFrame:
    """T5: fit on standardised TRAIN, score TEST, flag scores above the TRAIN
    (1 - contamination) quantile (scikit-learn's ``offset_`` rule)."""
    cols = validate_names(cols)
    tr, te = standardise(train.select(id_col, *cols), test.select(id_col, *cols), cols)
    model = train.sparkSession.sparkContext.broadcast(forest_model(fit_isolation_forest(tr, cols, params, id_col)))
    s_train = score_isolation_forest(tr, model, cols, id_col)
    s_test = score_isolation_forest(te, model, cols, id_col)
    cut = quantile_cont(s_train, [], "fraud_score", [1.0 - float(params["contamination"])], ["__thr"])
    out = attach_scalars(s_test, cut)  # 1-row threshold
    flag = (F.col("fraud_score") > F.col("__thr")).cast("int")
    return out.select(id_col, "fraud_score", flag.alias("suspicious_flag"),
                      F.when(flag == 1, "-1").otherwise("1").alias("prediction"))


# T6 -----------------------------------------------------------------------------
def classification_metrics(scored: DataFrame, score_col: str = "fraud_score", label_col: str = "actual_fraud",
                           threshold: float = 0.5, group_by: Sequence[str] = ()) -> DataFrame:
    """Average precision (step), ROC-AUC (trapezoid), precision/recall/F1 at ``threshold``.

    Exact with ties: rows are aggregated by distinct score first, then running
    sums over descending score give the curve points.
    """
    g = list(group_by)
    lab = F.col(label_col).cast("long")
    per = scored.groupBy(*g, F.col(score_col).alias("__s")).agg(
        F.sum(lab).alias("pos"), (F.count(F.lit(1)) - F.sum(lab)).alias("neg"))
    j = running_sums(per, g, [F.col("__s").desc()], ["pos", "neg"], total_prefix="tot_").withColumnsRenamed(
        {"tot_pos": "P", "tot_neg": "N"})
    prec_t = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    ap_term = F.try_divide(F.col("pos"), F.col("P")) * prec_t
    tpr, tpr0 = F.try_divide(F.col("cum_pos"), F.col("P")), F.try_divide(F.col("cum_pos") - F.col("pos"), F.col("P"))
    fpr, fpr0 = F.try_divide(F.col("cum_neg"), F.col("N")), F.try_divide(F.col("cum_neg") - F.col("neg"), F.col("N"))
    # the confusion counts come from the same rows: the cases are read once
    pred = F.col("__s") >= threshold
    some = lambda c: F.sum(F.when(c[0], F.col(c[1])).otherwise(0)).cast("long")
    cm = (j.groupBy(*g) if g else j).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("positives"),
        some((pred, "pos")).alias("tp"), some((pred, "neg")).alias("fp"), some((~pred, "pos")).alias("fn"),
        F.sum(ap_term).alias("average_precision"), F.sum((fpr - fpr0) * (tpr + tpr0) / 2.0).alias("roc_auc"))
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    cm = cm.select(*g, "n", "positives", p.alias("precision"), r.alias("recall"), "average_precision", "roc_auc")
    return cm.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                            2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(0.0))


# T7 -----------------------------------------------------------------------------
def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] = SWEEP_THRESHOLDS, score_col: str = "fraud_score",
                    label_col: str = "actual_fraud", group_by: Sequence[str] = ()) -> DataFrame:
    """Predicted count, precision, recall, F1 per threshold (one aggregate, no explode of rows)."""
    if not thresholds:
        raise ValueError("no thresholds")
    y = F.col(label_col) == 1
    s = F.col(score_col)
    aggs = [count_if(y).alias("__pos")]
    for i, t in enumerate(thresholds):
        aggs += [count_if(s >= t).alias(f"__n{i}"), count_if((s >= t) & y).alias(f"__tp{i}")]
    wide = (scored.groupBy(*group_by) if group_by else scored).agg(*aggs)
    rows = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"__n{i}").alias("predicted_count"),
                     F.col(f"__tp{i}").alias("tp")) for i, t in enumerate(thresholds)]
    long = wide.select(*group_by, "__pos", F.explode(F.array(*rows)).alias("x")).select(*group_by, "__pos", "x.*")
    p = F.when(F.col("predicted_count") > 0, F.col("tp") / F.col("predicted_count")).otherwise(0.0)
    r = F.when(F.col("__pos") > 0, F.col("tp") / F.col("__pos")).otherwise(0.0)
    out = long.select(*group_by, "threshold", "predicted_count", p.alias("precision"), r.alias("recall"))
    return out.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                             2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                          .otherwise(0.0))


# T8 -----------------------------------------------------------------------------
def feature_importance(model, cols: Sequence[str], spark=None) -> DataFrame:
    """Feature importances of a fitted tree model, descending (bounded by #features)."""
    spark = spark or __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    rows = [(c, float(v)) for c, v in zip(cols, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


# T9 -----------------------------------------------------------------------------
def anomaly_metrics(scored: DataFrame, flag_col: str = "suspicious_flag", score_col: str = "fraud_score",
                    group_by: Sequence[str] = ()) -> DataFrame:
    """Count, flagged, alert rate, mean, p95 (linear interpolation), max."""
    g = list(group_by)
    agg = (scored.groupBy(*g) if g else scored).agg(
        F.count(F.lit(1)).alias("provider_count"), count_if(F.col(flag_col) == 1).alias("flagged_provider_count"),
        F.avg(score_col).alias("mean_anomaly_score"), F.max(score_col).alias("max_anomaly_score"))
    agg = agg.withColumn("alert_rate", F.col("flagged_provider_count") / F.col("provider_count"))
    p95 = quantile_cont(scored, g, score_col, [0.95], ["p95_anomaly_score"])
    return agg.join(p95, g, "left") if g else attach_scalars(agg, p95)


# T10 ----------------------------------------------------------------------------
def experiment_record(runs: DataFrame, name_col: str = "experiment_name", type_col: str = "model_type",
                      month_col: str = "data_month", ts_col: str = "created_at") -> DataFrame:
    """experiment_id = first 16 hex of sha256(name); run_id = type-YYYYMMDD(month)-YYYYMMDDHHMMSS."""
    return runs.select(
        F.substring(F.sha2(F.col(name_col), 256), 1, 16).alias("experiment_id"),
        F.concat_ws("-", F.col(type_col), F.date_format(F.col(month_col), "yyyyMMdd"),
                    F.date_format(F.col(ts_col), "yyyyMMddHHmmss")).alias("run_id"),
        "*")

