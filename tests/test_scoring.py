from pyspark.sql import functions as F

from claimscope.operators import scoring as sc

B = "provider_id string"
R = "provider_id string, fraud_score double"


def _check(spark, batch, raw):
    return sc.prediction_completeness(spark.createDataFrame([(p,) for p in batch], B), spark.createDataFrame(raw, R)).first()


def test_completeness_pass(spark):
    r = _check(spark, ["a", "b", "c"], [("a", 0.1), ("b", 0.9), ("c", 0.5)])
    assert r.status == "PASS" and r.reason is None


def test_completeness_failures(spark):
    assert _check(spark, ["a"], []).reason == "zero successful prediction rows"
    assert _check(spark, ["a", "b"], [("a", 0.2)]).reason == "prediction count does not match input count"
    r = _check(spark, ["a", "b"], [("a", 0.2), (None, 0.3)])
    assert r.reason == "output lost provider lineage" and r.lost_lineage_rows == 1 and r.unexpected_providers == 0
    assert _check(spark, ["a", "b"], [("a", 0.2), ("a", 0.3)]).reason == "duplicate prediction for a provider"
    assert _check(spark, ["a", "b"], [("a", 0.2), ("b", 1.3)]).reason == "prediction is not a probability"
    r = _check(spark, ["a", "b"], [("a", 0.2), ("c", 0.3)])
    assert r.reason == "provider lineage mismatch" and r.missing_providers == 1 and r.unexpected_providers == 1


def test_reason_codes_order_and_zero_mean(spark):
    feats = spark.createDataFrame([("p", 2.0, 1.0, 5.0, None)], "provider_id string, a double, b double, c double, d double")
    means = spark.createDataFrame([(1.0, 1.0, 0.0, 1.0)], "mean_a double, mean_b double, mean_c double, mean_d double")
    z = sc.reason_codes(feats, means, ["a", "b", "c", "d"], 3, "zero").first()
    assert (z.reason_1, z.reason_2, z.reason_3) == ("a", "b", "c")      # c: mean 0 -> ratio 0; d NULL sorts last
    d = sc.reason_codes(feats, means, ["a", "b", "c", "d"], 3, "drop").first()
    assert (d.reason_1, d.reason_2, d.reason_3) == ("a", "b", None)     # c and d dropped


def test_curated_rank_ties_and_tiers(spark):
    raw = spark.createDataFrame([("r", "p2", "0.9"), ("r", "p1", "0.9"), ("r", "p3", "0.6"), ("r", "p4", "x")],
                                "run_id string, provider_id string, prediction string")
    for c in ("prediction_date", "experiment_id", "model_name", "model_version", "created_at"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    out = {r.provider_id: r for r in sc.curate_predictions(raw).collect()}
    assert "p4" not in out                                          # unparseable score is dropped
    assert (out["p1"].risk_rank, out["p2"].risk_rank, out["p3"].risk_rank) == (1, 2, 3)
    assert out["p1"].risk_category == "HIGH" and out["p3"].risk_category == "MEDIUM"


def test_queue_needs_no_label_column(spark):
    from claimscope.operators.investigation import investigation_queue, open_queue, queue_summary

    preds = spark.sql("""
        SELECT concat('P', id) AS provider_id, 'e' AS experiment_id, 'r1' AS run_id, 'xgboost' AS model_name,
          'xgboost:7' AS model_version, id / 10.0D AS fraud_score, 10 - id AS risk_rank, 'LOW' AS risk_category,
          'none' AS reason, timestamp'2024-01-01' AS created_at FROM range(10)""")
    state = spark.sql("SELECT 'k' AS model_name, 'xgboost' AS approved_model_type, 'r1' AS approved_run_id, 'models/7' AS approved_model_resource")
    queue = investigation_queue(preds, state, "k", 3, "2024-02-01 00:00:00")
    assert [(r.provider_id, r.investigation_rank) for r in queue.orderBy("investigation_rank").collect()] == [("P9", 1), ("P8", 2), ("P7", 3)]
    assert queue_summary(queue).collect()[0].investigation_count == 3
    done = spark.sql("SELECT 'P9' AS provider_id, 'CONFIRMED_FRAUD' AS investigation_result UNION ALL SELECT 'P8', 'PENDING'")
    assert {r.provider_id for r in open_queue(queue, done).collect()} == {"P8", "P7"}


def test_classes_that_are_no_number_give_no_row(spark):
    from claimscope.operators.scoring import curate_classes, invalid_predictions

    raw = spark.createDataFrame([("a", "-1"), ("b", "1"), ("c", "oops"), ("d", None), ("e", "")], "provider_id string, prediction string")
    runs = spark.sql("SELECT 'isolation_forest' AS model_type, 'e' AS experiment_id, 'r' AS run_id, 'n' AS experiment_name, timestamp'2024-01-01' AS created_at")
    got = curate_classes(raw, runs, "isolation_forest", "-1", prediction_date="2024-01-02", created_at="2024-01-02 00:00:00").collect()
    assert sorted((r.provider_id, r.fraud_score, r.risk_category) for r in got) == [("a", 1.0, "HIGH"), ("b", 0.0, "LOW")]
    assert invalid_predictions(raw).collect()[0].invalid_predictions == 2
