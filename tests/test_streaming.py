import datetime as dt
import uuid

from pyspark.sql import functions as F

from claimscope.sources import io
from claimscope.streaming import short_term as st

SCHEMA = ("provider_id string, service_date date, is_high_acuity_em int, is_referral int, "
          "total_paid_amount decimal(18,4), member_provider_distance double")


def _claims(spark, start, days, providers=("p1", "p2")):
    rows = []
    for d in range(days):
        for i, p in enumerate(providers):
            rows.append((p, start + dt.timedelta(days=d), (d + i) % 2, d % 3 == 0, 100 + d, float(d)))
    df = spark.createDataFrame(rows, "provider_id string, service_date date, is_high_acuity_em int, "
                                     "is_referral boolean, amt int, member_provider_distance double")
    return df.select("provider_id", "service_date", "is_high_acuity_em", F.col("is_referral").cast("int").alias("is_referral"),
                     F.col("amt").cast("decimal(18,4)").alias("total_paid_amount"), "member_provider_distance")


def test_stream_restart_is_incremental_and_duplicate_free(spark):
    base = io.shared_path(spark, f"test-stream-{uuid.uuid4().hex[:8]}")
    src, sink, ckpt = f"{base}/claims", f"{base}/out", f"{base}/ckpt"
    first = _claims(spark, dt.date(2024, 1, 1), 20)
    first.write.mode("append").parquet(src)
    st.run_short_term_stream(spark, src, first.schema, sink, ckpt).awaitTermination()
    out1 = spark.read.parquet(sink)
    n1, max1 = out1.count(), out1.agg(F.max("snapshot_date")).first()[0]
    assert max1 == dt.date(2024, 1, 17)  # last claim 01-20, watermark 2 days -> windows ending <= 01-18
    second = _claims(spark, dt.date(2024, 1, 21), 10)
    second.write.mode("append").parquet(src)
    st.run_short_term_stream(spark, src, first.schema, sink, ckpt).awaitTermination()  # restart from checkpoint
    out2 = spark.read.parquet(sink)
    keys = out2.groupBy("snapshot_date", "provider_id").count()
    assert keys.where("count > 1").count() == 0            # no duplicate snapshot rows
    assert out2.count() > n1 and out2.agg(F.max("snapshot_date")).first()[0] == dt.date(2024, 1, 27)
    # every emitted snapshot equals the batch computation over the full claims
    allc = first.unionByName(second)
    d = F.col("snapshot_date")
    exp = (allc.crossJoin(spark.range(7).withColumnRenamed("id", "k"))
               .withColumn("snapshot_date", F.date_add("service_date", F.col("k").cast("int")))
               .groupBy("snapshot_date", "provider_id").agg(F.count(F.lit(1)).alias("claim_count_7d")))
    got = out2.select("snapshot_date", "provider_id", "claim_count_7d")
    assert got.join(exp, ["snapshot_date", "provider_id"], "left_anti").count() == 0
    assert got.join(exp.where(d <= F.lit(dt.date(2024, 1, 27))), ["snapshot_date", "provider_id", "claim_count_7d"],
                    "inner").count() == got.count()
    # completion: open dates come from the claims, and so do dates with claims that came too late
    late = _claims(spark, dt.date(2024, 1, 3), 1, ("p9",))
    late.write.mode("append").parquet(src)
    st.run_short_term_stream(spark, src, first.schema, sink, ckpt).awaitTermination()
    every = allc.unionByName(late)
    done = st.complete(every, spark.read.parquet(sink).select("snapshot_date", "provider_id", *st.MEASURES))
    want = (every.crossJoin(spark.range(7).withColumnRenamed("id", "k"))
                 .withColumn("snapshot_date", F.date_add("service_date", F.col("k").cast("int")))
                 .groupBy("snapshot_date", "provider_id").agg(F.count(F.lit(1)).alias("claim_count_7d")))
    assert sorted(done.select("snapshot_date", "provider_id", "claim_count_7d").collect()) == sorted(want.collect())


def test_a_claim_is_in_the_state_once_and_windows_reach_back_over_batches(spark):
    base = io.shared_path(spark, f"test-stream-{uuid.uuid4().hex[:8]}")
    src, sink, ckpt = f"{base}/claims", f"{base}/out", f"{base}/ckpt"
    first = _claims(spark, dt.date(2024, 1, 1), 12)
    # days without claims, and a provider who has none after the first files
    second = _claims(spark, dt.date(2024, 1, 15), 9, ("p1",)).unionByName(_claims(spark, dt.date(2024, 2, 10), 3, ("p1",)))
    put = 0
    for part in (first, second):
        part.write.mode("append").parquet(src)
        q = st.run_short_term_stream(spark, src, first.schema, sink, ckpt)
        q.awaitTermination()
        put += sum(o.numRowsUpdated for p in q.recentProgress for o in p.stateOperators)
    every = first.unionByName(second)
    assert put == every.select("provider_id", "service_date").distinct().count()  # not seven windows each
    out = spark.read.parquet(sink).select("snapshot_date", "provider_id", *st.MEASURES)
    last = out.agg(F.max("snapshot_date")).first()[0]
    assert last == dt.date(2024, 1, 23)  # the last finished day with a claim
    want = st.complete(every, out.limit(0)).where(F.col("snapshot_date") <= F.lit(last))
    assert sorted(out.collect()) == sorted(want.collect())
    assert out.where("snapshot_date = date'2024-01-18' and provider_id = 'p2'").first().claim_count_7d == 1
    done = st.complete(every, out)
    assert sorted(done.collect()) == sorted(st.complete(every, out.limit(0)).collect())
