"""Sketches against exact values, fingerprints against full joins, the checked ledger against a plain fold, date pruning."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions import fingerprints as fp
from claimscope.functions import sketches as sk
from claimscope.operators import governance as gv
from claimscope.operators import monitoring as mo
from claimscope.operators import scoring as sc


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# sketches ----------------------------------------------------------------------
def test_distinct_sketches_merge_like_one(spark):
    rows = spark.range(60000).select((F.col("id") % 3).alias("p"), (F.col("id") % 50).alias("day"), F.concat(F.lit("m"), F.col("id") % 17001).alias("m"))
    rows = rows.unionByName(spark.sql("SELECT 0L AS p, 1L AS day, CAST(NULL AS STRING) AS m"))
    daily = sk.distinct_sketches(rows, ["p", "day"], "m")
    assert daily.count() == 150
    got = {r.p: r.unique_members for r in sk.distinct_estimates(daily, ["p"]).collect()}
    exact = {r.p: r.n for r in rows.groupBy("p").agg(F.count_distinct("m").alias("n")).collect()}
    assert all(abs(got[p] - n) <= sk.distinct_error() * n for p, n in exact.items())
    once = {r.p: r.unique_members for r in sk.distinct_estimates(sk.distinct_sketches(rows, ["p"], "m"), ["p"]).collect()}
    assert all(abs(once[p] - got[p]) <= 0.02 * exact[p] for p in exact)
    assert sk.distinct_sketches(rows.limit(0), ["p"], "m").count() == 0
    with pytest.raises(ValueError):
        sk.distinct_sketches(rows, ["p"], "m", lg_k=30)


def test_score_sketches_and_index(spark):
    rows = spark.range(40000).select((F.col("id") % 4).alias("run"), F.pmod(F.hash("id"), F.lit(1000)).cast("double") / 1000 * F.when(F.col("id") % 4 == 3, 0.7).otherwise(1.0))
    rows = rows.toDF("run", "fraud_score").unionByName(spark.sql("SELECT 0L, CAST(NULL AS DOUBLE) UNION ALL SELECT 0L, CAST('NaN' AS DOUBLE)").toDF("run", "fraud_score"))
    runs = sk.score_sketches(rows, ["run"]).checkpoint()
    told = {r.run: r for r in sk.sketch_summary(runs).collect()}
    exact = {r.run: r for r in rows.where("NOT isnan(fraud_score)").groupBy("run").agg(
        F.count("fraud_score").alias("n"), F.avg("fraud_score").alias("mean"), F.percentile("fraud_score", [0.5, 0.9, 0.95]).alias("q")).collect()}
    for run, e in exact.items():
        t = told[run]
        assert t.row_count == e.n and t.mean_score == pytest.approx(e["mean"])
        assert [t.p50, t.p90, t.p95] == pytest.approx(e.q, abs=sk.rank_error() + 0.002)
    every = sk.sketch_summary(sk.merged_sketches(runs.withColumn("all", F.lit(1)), ["all"])).collect()[0]
    assert every.row_count == 40000
    pair = runs.where("run = 3").select(F.col("scores").alias("c")).crossJoin(runs.where("run = 0").select(F.col("scores").alias("b")))
    got = pair.select(sk.sketch_psi(F.col("c"), F.col("b")).alias("psi")).collect()[0].psi
    counts = {r.run: r.c for r in rows.where("NOT isnan(fraud_score)").withColumn("k", F.least(F.floor(F.col("fraud_score") * 10), F.lit(9)))
              .groupBy("run").agg(F.collect_list("k").alias("c")).collect()}
    import math
    rate = lambda run, k: max(counts[run].count(k) / len(counts[run]), 0.0001)
    want = sum((rate(3, k) - rate(0, k)) * math.log(rate(3, k) / rate(0, k)) for k in range(10))
    assert got == pytest.approx(want, rel=0.15) and got > 0.2


# fingerprints ---------------------------------------------------------------------
def sets(spark, rows):
    return spark.createDataFrame(rows, "provider_id string, fraud_score double")


@pytest.mark.parametrize("change", ["none", "score", "missing", "extra", "null", "all", "empty"])
def test_parity_by_fingerprint_equals_the_join(spark, change):
    rows = [(f"p{i}", i / 500) for i in range(500)]
    other = {"none": rows, "score": [(p, s + (p == "p7") * 0.25) for p, s in rows], "missing": rows[:-2], "extra": [*rows, ("new", 0.5)],
             "null": [(p, None if p == "p9" else s) for p, s in rows], "all": [(p, s / 2) for p, s in rows], "empty": []}[change]
    base = [(p, None if p == "p9" and change == "null" else s) for p, s in rows]
    a, b = sets(spark, base).repartition(3), sets(spark, other)
    want = sc.score_parity(a, b).collect()[0].asDict()
    for buckets in (1, 16, 4096):
        got = sc.parity_by_fingerprint(a, b, buckets=buckets).collect()[0].asDict()
        assert got == pytest.approx(want), (change, buckets)


def test_equal_tables_join_nothing(spark):
    rows = [(f"p{i}", i / 500) for i in range(500)]
    a, b = sets(spark, rows), sets(spark, rows[::-1]).repartition(5)
    for df in (sc.parity_by_fingerprint(a, b), sc.completeness_by_fingerprint(a.select("provider_id"), b)):
        assert df.collect()[0][-2 if "reason" in df.columns else -1] == "PASS"
        text = plan(df)
        assert not any(j in text for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin"))


@pytest.mark.parametrize("change", ["none", "missing", "extra", "twice", "range", "lost", "nameless", "empty"])
def test_completeness_by_fingerprint_equals_the_join(spark, change):
    rows = [(f"p{i}", i / 500) for i in range(300)]
    raw = {"none": rows, "missing": rows[3:], "extra": [*rows, ("new", 0.1)], "twice": [*rows, rows[5]], "range": [(p, s + (p == "p1") * 9) for p, s in rows],
           "lost": [*rows[1:], (None, 0.1)], "nameless": rows, "empty": []}[change]
    batch = sets(spark, rows + [(None, 0.0)] * (change == "nameless")).select("provider_id")
    want = sc.prediction_completeness(batch, sets(spark, raw)).collect()[0]
    for buckets in (1, 64):
        assert sc.completeness_by_fingerprint(batch, sets(spark, raw), buckets=buckets).collect()[0].asDict() == want.asDict()


def test_fingerprints_see_order_and_repeats(spark):
    a = sets(spark, [("x", 1.0), ("x", 1.0), ("y", 2.0)])
    same, once, moved = sets(spark, [("y", 2.0), ("x", 1.0), ("x", 1.0)]), sets(spark, [("x", 1.0), ("y", 2.0), ("y", 2.0)]), sets(spark, [("x", None), ("x", 1.0), ("y", 2.0)])
    f = lambda d: fp.bucket_fingerprints(d, "provider_id", ["fraud_score"], 1)
    assert fp.differing_buckets(f(a), f(same)) == []
    assert fp.differing_buckets(f(a), f(once)) == fp.differing_buckets(f(a), f(moved)) == [0]


# ledger --------------------------------------------------------------------------
def ledger(spark, events):
    rows = [(k, f"{i:05d}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=t), kind, f and f"res/{f}", f, f"res/{g}", g) for i, (k, t, kind, f, g) in enumerate(events)]
    return spark.createDataFrame(rows, "state_key string, event_id string, event_time timestamp, event_type string, from_model_resource string, "
                                       "from_run_id string, to_model_resource string, to_run_id string")


def fold(events):
    out, active = {}, {}
    for i, (k, t, kind, f, g) in sorted(enumerate(events), key=lambda e: (e[1][1], e[0])):
        if kind not in ("PROMOTION", "ROLLBACK"):
            continue
        ok = k not in active or active[k] == f
        out[f"{i:05d}"] = (ok, active.get(k))
        if ok:
            active[k] = g
    return out, active


def test_stale_and_concurrent_events_do_not_count(spark):
    events = [("k", 0, "PROMOTION", None, "a"), ("k", 1, "PROMOTION", "a", "b"), ("k", 1, "PROMOTION", "a", "c"),  # concurrent
              ("k", 2, "ROLLBACK", "b", "a"), ("k", 3, "PROMOTION", "b", "d"),  # stale
              ("k", 4, "COMMENT", "a", "z"), ("k", 5, "PROMOTION", "a", "e"), ("other", 0, "PROMOTION", "x", "y")]
    got = {r.event_id: r for r in gv.checked_ledger(ledger(spark, events)).collect()}
    assert [got[f"{i:05d}"].accepted for i in (0, 1, 2, 3, 4, 6, 7)] == [True, True, False, True, False, True, True]
    assert got["00002"].active_run_id == "b" and got["00002"].problem and got["00006"].problem is None
    active = {r.state_key: (r.run_id, r.rejected_events) for r in gv.checked_active_model(ledger(spark, events)).collect()}
    assert active == {"k": ("e", 2), "other": ("y", 0)}
    assert gv.checked_ledger(ledger(spark, events).limit(0)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_ledger_equals_a_plain_fold(spark, seed):
    rng = random.Random(seed)
    models = [None, "a", "b", "c"]
    events = [(rng.choice("hhhk"), rng.randint(0, 200), rng.choice(["PROMOTION", "ROLLBACK"]), rng.choice(models), rng.choice(models[1:])) for _ in range(150)]
    want, active = fold(events)
    got = {r.event_id: (r.accepted, r.active_run_id) for r in gv.checked_ledger(ledger(spark, events)).collect()}
    assert got == want and 10 < sum(a for a, _ in want.values()) < 140
    assert {r.state_key: r.run_id for r in gv.checked_active_model(ledger(spark, events)).collect()} == active


# newest partition -------------------------------------------------------------------
def test_newest_rows_scan_one_partition(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="claimscope-monitor-"), "t")
    rows = [(dt.datetime(2024, 1, d, h), d * 100 + h, dt.date(2024, 1, d)) for d in range(1, 9) for h in (3, 9, 9)]
    schema = T.StructType([T.StructField("monitoring_timestamp", T.TimestampType()), T.StructField("v", T.LongType()), T.StructField("monitoring_date", T.DateType())])
    spark.createDataFrame(rows, schema).write.partitionBy("monitoring_date").parquet(path)
    history = spark.read.schema(schema).parquet(path)
    df = mo.latest_stored_rows(history, "monitoring_date")
    assert sorted(r.v for r in df.collect()) == [809, 809]
    filters = [x.split("]")[0] for x in plan(df).split("PartitionFilters: [")[1:]]
    assert any("ubquery" in x for x in filters) and sorted(df.columns) == sorted(history.columns)
    opened = history.where(F.col("monitoring_date") == history.agg(F.max("monitoring_date")).scalar()).select(F.input_file_name().alias("f")).distinct().collect()
    assert all("2024-01-08" in r.f for r in opened)
    assert mo.latest_stored_rows(history.where("v < 0"), "monitoring_date").collect() == []
