import uuid

from pyspark.sql import functions as F

from claimscope.sources import io
from claimscope.sources.schemas import DATA_QUALITY, align_schema


def test_upsert_updates_listed_columns_and_inserts(spark):
    target = spark.createDataFrame([("a", 1, 10.0, "x"), ("b", 1, 20.0, "y")], "k string, t int, v double, note string")
    source = spark.createDataFrame([("a", 1, 99.0, "changed"), ("c", 1, 30.0, "new")], "k string, t int, v double, note string")
    out = {r.k: r for r in io.upsert(target, source, ["k", "t"], ["v"]).collect()}
    assert out["a"].v == 99.0 and out["a"].note == "x"      # matched: only v updated
    assert out["b"].v == 20.0                              # untouched
    assert out["c"].v == 30.0 and out["c"].note == "new"   # inserted with all columns


def test_replace_slice_is_idempotent(spark):
    target = spark.createDataFrame([("r1", "p1", 0.1), ("r1", "p2", 0.2), ("r2", "p1", 0.3)], "run_id string, p string, s double")
    new = spark.createDataFrame([("r1", "p1", 0.9)], "run_id string, p string, s double")
    once = io.replace_slice(target, new, ["run_id"])
    twice = io.replace_slice(once, new, ["run_id"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted((r.run_id, r.p) for r in once.collect()) == [("r1", "p1"), ("r2", "p1")]


def test_align_schema_adds_typed_nulls(spark):
    old = spark.createDataFrame([("m", 5)], "model_name string, total_rows long")
    out = align_schema(old, DATA_QUALITY)
    assert out.columns[:len(DATA_QUALITY)] == [f.name for f in DATA_QUALITY.fields]
    r = out.first()
    assert r.total_rows == 5 and r.duplicate_rows is None


def test_write_partitioned_overwrites_only_its_dates(spark):
    path = io.shared_path(spark, f"test-s6-{uuid.uuid4().hex[:8]}")
    a = spark.createDataFrame([("p1", "2024-01-31 23:59:59", 1.0), ("p2", "2024-02-29 23:59:59", 2.0)],
                              "provider_id string, ts string, v double").withColumn("feature_timestamp", F.col("ts").cast("timestamp")).drop("ts")
    io.write_partitioned(a, path)
    b = spark.createDataFrame([("p3", "2024-02-29 23:59:59", 3.0)],
                              "provider_id string, ts string, v double").withColumn("feature_timestamp", F.col("ts").cast("timestamp")).drop("ts")
    io.write_partitioned(b, path)
    io.write_partitioned(b, path)  # re-run: same result
    back = sorted((r.provider_id, str(r.feature_date)) for r in spark.read.parquet(path).collect())
    assert back == [("p1", "2024-01-31"), ("p3", "2024-02-29")]


def test_append_history(spark):
    h = spark.createDataFrame([("m", 1)], "model_name string, total_rows long")
    n = spark.createDataFrame([("m", 2, "PASS")], "model_name string, total_rows long, monitoring_status string")
    out = io.append_history(h, n).collect()
    assert len(out) == 2 and {r.monitoring_status for r in out} == {None, "PASS"}


def test_read_table_csv_declared_schema_failfast(spark):
    import pytest
    from pyspark.sql import types as T

    from claimscope.sources.schemas import read_table
    path = io.shared_path(spark, f"test-s1-{uuid.uuid4().hex[:8]}")
    good = spark.createDataFrame([("c1", "p1", 10.5), ("c2", "p2", 3.25)], "claim_id string, provider_id string, amt double")
    good.coalesce(1).write.option("header", "true").csv(path + "/good")
    schema = T.StructType([T.StructField("claim_id", T.StringType()), T.StructField("provider_id", T.StringType()),
                           T.StructField("amt", T.DoubleType())])
    rows = sorted(tuple(r) for r in read_table(spark, path + "/good", schema, "csv").collect())
    assert rows == [("c1", "p1", 10.5), ("c2", "p2", 3.25)]
    bad = spark.createDataFrame([("c3", "p3", "not-a-number")], "claim_id string, provider_id string, amt string")
    bad.coalesce(1).write.option("header", "true").csv(path + "/bad")
    with pytest.raises(Exception):
        read_table(spark, path + "/bad", schema, "csv").collect()


def test_bucketed_claims_are_aggregated_without_a_shuffle(spark):
    from claimscope.sources.layout import write_bucketed

    rows = spark.range(1000).selectExpr("CAST(id % 37 AS STRING) AS provider_id", "CAST(id % 91 AS STRING) AS member_id", "id AS v")
    table = write_bucketed(rows, "provider_id", 8)
    got = table.groupBy("provider_id").agg(F.count_distinct("member_id").alias("m"), F.sum("v").alias("v"))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    joined = table.groupBy("provider_id").agg(F.count("*").alias("n")).join(got, "provider_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = rows.groupBy("provider_id").agg(F.count_distinct("member_id").alias("m"), F.sum("v").alias("v"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
