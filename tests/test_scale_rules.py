"""Layout, skew and completeness rules that the oracles on small data cannot show."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from claimscope import session
from claimscope.functions.ranking import quantile_cont, quantile_disc, top_k_per_group
from claimscope.operators import governance as gv
from claimscope.operators import models as mdl
from claimscope.operators import performance as pe
from claimscope.operators import scoring as sc
from claimscope.sources import adapters as ad
from claimscope.sources import io
from claimscope.streaming import short_term  # noqa: F401  (imports without a stream)

SMALL = "/root/testdata/sf0.001"


def test_quantiles_order_distinct_values_only(spark, monkeypatch):
    from claimscope.functions import ranking
    seen = []
    real = ranking.running_sums

    def spy(df, *a, **k):
        seen.append(df.count())
        return real(df, *a, **k)
    monkeypatch.setattr(ranking, "running_sums", spy)
    df = spark.range(20000).select(F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.col("id") / 20000).alias("v"))
    got = quantile_disc(df, [], "v", [0.05, 0.5, 0.95], ["a", "b", "c"]).first()
    assert seen == [2001] and (got.b, got.c) == (1.0, 1.0) and got.a == 9990 / 20000
    assert quantile_cont(df, [], "v", [0.5], ["m"]).first().m == 1.0


def test_top_k_per_group_limits_before_the_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id")
    out = top_k_per_group(df, ["g"], [F.col("id").desc()], 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r.g, r.rn, r.id) for r in out.collect())[:4] == [(0, 1, 4998), (0, 2, 4995), (0, 3, 4992), (0, 4, 4989)]


def test_one_date_is_written_by_several_tasks_and_the_session_stays(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    path = io.shared_path(spark, "test-s6-layout")
    df = spark.range(4000).select(F.concat(F.lit("p"), "id").alias("provider_id"), F.lit("2024-01-31 10:00:00").cast("timestamp").alias("feature_timestamp"))
    io.write_partitioned(df, path)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 4000
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == before
    assert io.shared_path(spark, "x") != io.shared_path(spark, "x")


def test_upsert_refuses_a_repeated_source_key(spark):
    t = spark.createDataFrame([("a", 1.0)], "k string, v double")
    with pytest.raises(ValueError, match="more than once"):
        io.upsert(t, spark.createDataFrame([("a", 2.0), ("a", 3.0)], "k string, v double"), ["k"], ["v"])


def test_append_history_on_disk(spark):
    path = io.shared_path(spark, "test-history")
    for i in range(2):
        io.append_history_to(path, spark.createDataFrame([(i, "m")], "n int, model_name string"))
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [0, 1]


def test_a_cluster_without_a_checkpoint_folder_is_an_error():
    class Cluster:
        conf = SimpleNamespace(get=lambda *a: None)
        sparkContext = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_every_case_is_kept(spark):
    groups = (ad.read(spark, SMALL, "events").where("event_type = 'error'")
              .select("user_id", ad._run_no(F.col("ts")).alias("r")).distinct().count())
    fb = ad.feedback(spark, SMALL)
    assert fb.count() == groups and fb.where("investigation_result = 'PENDING' and confirmed_fraud is not null").count() == 0


def test_sampling_has_candidates_at_any_size():
    for n in (1, 256, 1024, 10 ** 6, 1_100_000_000, 10 ** 13):
        psi = min(256, n)
        expected = (mdl.sample_cut(psi, n) + 1) / (1 << 63) * n
        assert expected >= min(n, 4 * psi) * 0.999


def test_a_short_tree_is_an_error(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("provider_id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    forest = mdl.fit_isolation_forest(df, ["a", "b"], {**mdl.IF_PARAMS, "n_estimators": 5})
    assert mdl.forest_model(forest)[-1] == 40
    with pytest.raises(ValueError, match="missing"):
        mdl.forest_model(forest.where("tree <> 3"))


def test_ranks_per_scored_run_and_nan_is_invalid(spark):
    rows = [("2024-01-01", "e", "r1", "m", v, "2024-01-01 00:00:00", p, s) for v in ("m:1", "m:2") for p, s in (("a", "0.9"), ("b", "NaN"), ("c", "x"), ("d", "0.2"))]
    df = spark.createDataFrame(rows, "prediction_date string, experiment_id string, run_id string, model_name string, model_version string, created_at string, provider_id string, prediction string")
    got = sorted((r.model_version, r.provider_id, r.risk_rank) for r in sc.curate_predictions(df).collect())
    assert got == [("m:1", "a", 1), ("m:1", "d", 2), ("m:2", "a", 1), ("m:2", "d", 2)]
    assert sc.invalid_predictions(df).first().invalid_predictions == 4


def test_trigger_reads_the_models_own_monitors(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    fb = spark.createDataFrame([(True,), (None,)], "confirmed_fraud boolean")
    dq = spark.createDataFrame([("m", "ALERT", t(1)), ("other", "PASS", t(9))], "model_name string, monitoring_status string, monitoring_timestamp timestamp")
    pdr = spark.createDataFrame([("m", "PASS", t(1)), ("other", "ALERT", t(9))], "model_name string, status string, check_date timestamp")
    r = gv.retraining_trigger(fb, dq, dq, pdr, "2024-02-01 00:00:00", model_name="m").first()
    assert (r.data_quality_trigger, r.feature_drift_trigger, r.prediction_drift_trigger) == (True, True, False)
    assert r.trigger_reason == "Data quality + feature drift alerts" and r.labeled_provider_count == 1
    r = gv.retraining_trigger(fb, dq, dq, pdr, "2024-02-01 00:00:00", model_name="none").first()
    assert r.trigger_reason == "No retraining trigger" and not r.retraining_required


def test_a_run_without_cases_has_insufficient_data(spark):
    preds = spark.createDataFrame([("p1", "r1", "m:1", "m", 0.9), ("p1", "r2", "m:1", "m", 0.9)], "provider_id string, run_id string, model_version string, model_name string, fraud_score double")
    fb = spark.createDataFrame([("p1", "r1", "m:1", "m", "CONFIRMED_FRAUD", True, 1)], "provider_id string, run_id string, model_version string, model_name string, investigation_result string, confirmed_fraud boolean, fraud_amount int")
    conf = pe.with_all_runs(pe.confusion(pe.matched_cases(preds, fb)), preds)
    metrics = spark.createDataFrame([], "run_id string, metric_name string, metric_value double")
    got = {r.run_id: (r.evaluated_cases, r.monitoring_status) for r in pe.performance_degradation(conf, metrics, "2024-02-01 00:00:00").collect()}
    assert got == {"r1": (1, "INSUFFICIENT_DATA"), "r2": (0, "INSUFFICIENT_DATA")}


@pytest.fixture(scope="module")
def separable(spark):
    rows = [(f"p{i:03d}", float(i % 50), float(i * 7 % 13), int((i % 50 > 38) != (i % 17 == 0))) for i in range(300)]
    return spark.createDataFrame(rows, "provider_id string, a double, b double, fraud_label int")


def test_boosted_trees(spark, separable):
    params = {**mdl.GBT_PARAMS, "n_estimators": 8}
    scores = []
    for weight in (9.0, 9.0, 1.0):
        model = mdl.train_gbt(separable, ["a", "b"], {**params, "scale_pos_weight": weight})
        scores.append({r.provider_id: r.fraud_score for r in sc.score(separable, model, ["a", "b"]).collect()})
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores[0].values())
    label = {r.provider_id: r.fraud_label for r in separable.collect()}
    pairs = [(x, y) for p, x in scores[0].items() for q, y in scores[0].items() if label[p] > label[q]]
    assert sum((x > y) + (x == y) / 2 for x, y in pairs) / len(pairs) > 0.8  # AUC
    mean = lambda s: sum(s.values()) / len(s)
    assert mean(scores[0]) > mean(scores[2])  # a larger positive weight raises scores


@pytest.mark.parametrize("train", [lambda d: mdl.train_random_forest(d, ["a", "b"], {**mdl.RF_PARAMS, "n_estimators": 10}),
                                   lambda d: mdl.train_gbt(d, ["a", "b"], {**mdl.GBT_PARAMS, "n_estimators": 4})])
def test_a_reloaded_model_scores_alike(spark, separable, train):
    model = train(separable)
    path = io.shared_path(spark, "test-model")
    model.write().save(path)
    again = type(model).load(path)
    assert sorted(sc.score(separable, model, ["a", "b"]).collect()) == sorted(sc.score(separable, again, ["a", "b"]).collect())
    imp = mdl.feature_importance(model, ["a", "b"], spark).collect()
    assert imp[0].feature == "a" and abs(sum(r.importance for r in imp) - 1) < 1e-9
