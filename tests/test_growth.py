"""Steps whose memory, moved bytes or time must not grow faster than their input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimscope.functions import asof
from claimscope.operators import features as fe
from claimscope.operators import profiling as pr
from claimscope.plans import features as pf
from claimscope.sources import adapters as ad
from claimscope.sources import layout
from claimscope.streaming import short_term as st
from conftest import SMALL

DAY = dt.date(2024, 1, 1)


def days(spark, counts):
    rows = [(None if d is None else DAY + dt.timedelta(days=d), i) for d, n in counts for i in range(n)]
    return spark.createDataFrame(rows, "service_date date, x int")


def test_a_backlog_arrives_in_spans_of_days(spark):
    df = days(spark, [(None, 2), *[(d, 3) for d in range(20)], (30, 1)])
    spans = [df.where(c).agg(F.count(F.lit(1)), F.min("service_date"), F.max("service_date")).first() for c in st.arrivals(df, 9)]
    assert len(spans) == 7 and sum(n for n, _, _ in spans) == df.count() and max(n for n, _, _ in spans) <= 11
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
    assert [df.where(c).count() for c in st.arrivals(df, 1000)] == [df.count()]
    assert [df.limit(0).where(c).count() for c in st.arrivals(df.limit(0), 9)] == [0]
    with pytest.raises(ValueError):
        st.arrivals(df, 0)


def test_claims_are_joined_once_for_days_and_profiles(spark, monkeypatch):
    calls, claims = [], ad.claims
    monkeypatch.setattr(ad, "claims", lambda *a, **k: calls.append(1) or claims(*a, **k))
    for q in (pf.q_f7_all, pf.q_f8_join):
        calls.clear()
        assert q(spark, SMALL).count() > 0
        assert len(calls) == 1


def test_as_of_join_stores_no_left_row(spark, monkeypatch):
    stored, keep = [], asof.materialize
    monkeypatch.setattr(asof, "materialize", lambda df: stored.append(keep(df)) or stored[-1])
    left = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([(0, 10, 1), (1, 2500, 2)], "k long, rt long, v int")
    got = asof.as_of_join(left, right, ["k"], "t", "rt", ["v"], 4)
    assert got.where("v is not null").count() == sum(t % 3 == 0 and t >= 10 or t % 3 == 1 and t >= 2500 for t in range(5000))
    assert sum(df.count() for df in stored) <= 3 * 4


def test_only_wanted_days_are_stored(spark, monkeypatch):
    rows = [(p, DAY + dt.timedelta(days=d), 1, 0, 0, d % 2, 0, None, float(d)) for p in "ab" for d in range(0, 90, 2)]
    claims = spark.createDataFrame(rows, "provider_id string, service_date date, is_high_acuity_em int, is_99214 int, is_99215 int, "
                                         "is_referral int, is_eye_procedure int, total_paid_amount decimal(18,4), member_provider_distance double")
    hist = fe.snapshot_backfill(claims)
    every = fe.short_term_backfill(claims, hist)
    stored, keep = [], fe.materialize
    monkeypatch.setattr(fe, "materialize", lambda df: stored.append(keep(df)) or stored[-1])
    some = fe.short_term_backfill(claims, hist, wanted=lambda d: F.dayofmonth(d) == 15)
    assert sum(df.count() for df in stored) == some.count() == 6
    assert sorted(some.collect()) == sorted(every.where("day(feature_timestamp) = 15").collect())


def test_daily_snapshots_are_neither_moved_nor_stored(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(p, DAY + dt.timedelta(days=d), 1, 0, 0, d % 2, 0, None, float(d)) for p in ("a", "b", None) for d in rng.sample(range(120), 40)]
    daily = fe.daily_partials(spark.createDataFrame(rows, "provider_id string, service_date date, is_high_acuity_em int, is_99214 int, is_99215 int, "
                              "is_referral int, is_eye_procedure int, total_paid_amount decimal(18,4), member_provider_distance double")).checkpoint()
    # profiles of any time: at noon, at the last second of a day and after it, twice on a day, without a value, before all claims
    at = [(p, dt.datetime.combine(DAY, dt.time()) + dt.timedelta(days=d, seconds=s), None if d % 5 == 0 else float(d) + s / 1e6)
          for p in ("a", None) for d in (-9, 3, 10, 17, 30, 31, 44, 58, 90, 91) for s in (43200, 86399, 86399.5)[: 1 + d % 3]]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    hist = spark.createDataFrame([(p, t, *[v] * len(fe.LONG_TERM_FEATURES)) for p, t, v in at],
                                 "provider_id string, feature_timestamp timestamp, " + ", ".join(f"{c} double" for c in fe.LONG_TERM_FEATURES))
    profiles = [r[:3] for r in hist.select("provider_id", F.col("feature_timestamp").cast("string"), "high_acuity_pct").collect()]
    stored, keep = [], fe.materialize
    monkeypatch.setattr(fe, "materialize", lambda df: stored.append(df) or keep(df))
    df = fe.short_term_backfill(None, hist, daily=daily)
    got = {(r.provider_id, r.at[:10]): (r.claim_count_7d, r.high_acuity_pct) for r in df.withColumn("at", F.col("feature_timestamp").cast("string")).collect()}
    want = {}
    for p in ("a", "b", None):
        of_p = [r[1] for r in rows if r[0] == p]
        for d in {x + dt.timedelta(days=k) for x in of_p for k in range(7)}:
            known = [(t, v) for q, t, v in profiles if q == p and p and v is not None and t <= f"{d} 23:59:59"]
            want[p, str(d)] = (sum(0 <= (d - x).days < 7 for x in of_p), max(known)[1] if known else None)
    assert got == want and stored == [] and len({v for _, v in want.values()}) > 5
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    spread = [i for i, line in enumerate(plan) if "Generate explode" in line]
    assert len(spread) == 2 and not any("Exchange hashpartitioning(provider_id" in line for line in plan[:spread[0]])


def test_buckets_follow_the_rows():
    assert layout.buckets_for(0) == layout.buckets_for(600_000) == 16
    assert all(n / layout.buckets_for(n) <= layout.BUCKET_ROWS for n in (10**7, 3 * 10**8, 10**11))


def test_members_of_windows_equal_brute_force(spark):
    rng = random.Random(5)
    ends = [r[0] for r in spark.range(9).select(F.expr("last_day(add_months(date'2023-09-30', cast(id as int)))")).collect()]
    rows = {(rng.choice(["p", "q", None]), rng.choice([None, *"abcde"]), rng.choice([*ends, None])) for _ in range(90)}
    pairs = spark.createDataFrame(sorted(rows, key=str), "provider_id string, member_id string, month_end date")
    got = {(r[0], r[1]): r[2] for r in pr.members_of_windows(pairs, 3, 4).collect()}
    at = {e: i for i, e in enumerate(ends)}
    want = {(p, e): len({m for q, m, x in rows if q == p and m and x and 0 <= at[e] - at[x] < 3}) for p, _, e in rows if p and e}
    assert got == want


def split_claims(spark):
    rows = [("p1" if i % 3 else f"p{i % 40}", "c", "s", f"t{i % 4}" if i % 9 else None, "TEST" if i % 5 else "TRAIN", f"m{i % 70}" if i % 11 else None,
             i % 2, i % 3 == 0 and 1 or 0, 0, 1, None if i % 7 == 0 else 1) for i in range(3000)]
    money = [F.lit(f"{x}.25").cast(f"decimal(18,{s})").alias(c) for x, s, c in
             ((3, 2, "total_billed_amt"), (2, 3, "total_allowed_amt"), (1, 4, "total_paid_amount"))]
    return spark.createDataFrame(rows, "provider_id string, provider_city string, provider_state string, provider_specialty string, "
                                       "dataset_split string, member_id string, is_high_acuity_em int, is_99214 int, is_99215 int, "
                                       "is_referral int, is_eye_procedure int").select("*", *money)


def test_claims_of_the_median_features_move_once_and_narrow(spark, monkeypatch):
    plans, keep = [], fe.materialize
    monkeypatch.setattr(fe, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    claims = split_claims(spark).checkpoint()
    got = sorted(map(str, fe.provider_features_median(claims).collect()))
    exchanges = [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "member_id" not in exchanges[0].split("hashpartitioning", 1)[1].split(")")[0]
    assert plans[0].index("HashAggregate") < plans[0].index("Exchange") and "HashAggregate" not in plans[0][plans[0].index("Exchange"):]
    hot = fe.provider_features_median(claims, rows=3000, hot=["p1", "p4"])
    assert sorted(map(str, hot.collect())) == got
    assert sum(r.total_claims for r in hot.collect()) == 3000


def test_the_last_day_is_found_without_all_claims(spark, tmp_path, monkeypatch):
    starts, claims = [], ad.claims
    monkeypatch.setattr(ad, "claims", lambda s, d, start=None, end=None: starts.append(start) or claims(s, d, start, end))
    want = claims(spark, SMALL).agg(F.max("service_date")).first()[0]
    assert ad.last_service_date(spark, SMALL) == want and None not in starts
    for t in ad.TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{SMALL}/{t}.parquet")
    (tmp_path / "lineitem.parquet").unlink()
    li = ad.read(spark, SMALL, "lineitem")
    late = li.limit(1).withColumn("l_shipdate", F.expr("l_shipdate + interval 3 years")).withColumn("l_orderkey", F.lit(-7).cast("long"))
    no_day = li.limit(2).withColumn("l_shipdate", F.lit(None).cast(li.schema["l_shipdate"].dataType))
    li.unionByName(late).unionByName(no_day).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert ad.last_service_date(spark, str(tmp_path)) == want  # the newest line items have no order
    rows, hot = ad.claim_load(spark, str(tmp_path), hot_rows=5)
    n = ad.read(spark, str(tmp_path), "lineitem").groupBy("l_suppkey").count().collect()
    assert rows == sum(r["count"] for r in n) and sorted(hot) == sorted(str(r.l_suppkey) for r in n if r["count"] > max(5, rows // 1000))


def star_tables(spark, folder):
    """Line items of providers of uneven size, with keys that are null, unknown or repeated on either side."""
    day, n = dt.datetime(2001, 1, 1), 3000

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    put("lineitem", [(i % 400 if i % 17 else None, i % 31 if i % 19 else None, None if i % 23 == 0 else 1 if i % 3 else i % 13, i % 7, 1.0,
                      None if i % 29 == 0 else i % 50 + 0.25, None if i % 37 == 0 else i % 11 / 100, "RAN"[i % 3] if i % 5 else None,
                      day + dt.timedelta(days=i % 300) if i % 41 else None) for i in range(n)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_shipdate timestamp_ntz")
    put("orders", [(k if k % 90 else None, k % 60 if k % 8 else None, day) for k in [*range(390), 5]],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    put("part", [(k, f"n{k}", "b", f"t{k % 4}" if k % 5 else None, k % 20 if k % 6 else None) for k in [*range(29), 3]],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    put("supplier", [(k if k != 7 else None, f"s{k}", k % 4 if k != 6 else None) for k in [*range(11), 4]],
        "s_suppkey long, s_name string, s_nationkey int")
    put("nation", [(k, f"c{k}", k % 2) for k in range(4)], "n_nationkey int, n_name string, n_regionkey int")
    put("region", [(k, f"r{k}") for k in range(2)], "r_regionkey int, r_name string")
    return str(folder)


@pytest.mark.parametrize("hot, broadcast", [([], "10m"), ([], "-1"), (["1", "4"], "10m")])
def test_claims_move_to_their_provider_before_they_are_widened(spark, tmp_path, monkeypatch, hot, broadcast):
    d = star_tables(spark, tmp_path)
    want = sorted(map(str, fe.provider_features_median(pf.full_split(spark, d)).collect()))
    plans, keep = [], fe.materialize
    monkeypatch.setattr(fe, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    monkeypatch.setattr(ad, "claim_load", lambda s, d: (3000, hot))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert len(want) > 30 and sorted(map(str, pf.median_features(spark, d).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    placing = [line for line in plans[0].splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(placing) == 1 and "Exchange hashpartitioning(l_suppkey" in placing[0] and "isnotnull(l_suppkey" in plans[0]
    moved_again = [line for line in plans[0].splitlines() if "Exchange hashpartitioning(provider_" in line]
    assert bool(moved_again) == bool(hot)  # partial aggregates of providers whose claims do not lie together
