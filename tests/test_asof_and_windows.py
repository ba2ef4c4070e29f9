"""As-of join and windows from daily partials: brute force, ties, NULLs, hot keys and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimscope.functions.asof import as_of_join
from claimscope.operators import features as fe


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_of(left, right):
    out = []
    for k, t, x in left:
        known = [(rt, a, b) for rk, rt, a, b in right if rk == k and k is not None and rt is not None and t is not None and rt <= t]
        best = max(known, default=(None, None, None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or ""))
        out.append((k, t, x, best[1], best[2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_as_of_equals_brute_force(spark, slices):
    rng = random.Random(slices)
    hot = ["h"] * 6 + ["a", "b", "c", None]
    left = [(rng.choice(hot), rng.choice([None, *range(60)]), rng.randint(0, 5)) for _ in range(500)]
    right = [(rng.choice(hot[5:]), rng.choice([None, *range(0, 60, 7)]), rng.choice([None, 1, 2]), rng.choice(["x", "y"])) for _ in range(80)]
    l = spark.createDataFrame(left, "k string, t int, x int").repartition(4)
    r = spark.createDataFrame(right, "k string, rt int, a int, b string").repartition(3)
    got = as_of_join(l, r, ["k"], "t", "rt", ["a", "b"], slices)
    assert got.columns == ["k", "t", "x", "a", "b"]
    assert sorted((tuple(x) for x in got.collect()), key=str) == as_of(left, right)


def test_as_of_carries_over_many_slices_and_splits_a_hot_key(spark):
    left = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([("hot", 3, 30), ("hot", 15000, 150)], "k string, rt long, v int")
    seen = []
    import claimscope.functions.asof as m
    keep = m.materialize
    def watch(df):
        seen.append(keep(df))
        return seen[-1]
    m.materialize = watch
    try:
        got = as_of_join(left, right, ["k"], "t", "rt", ["v"], 8)
        rows = got.groupBy("v").count().collect()
    finally:
        m.materialize = keep
    assert {r.v: r["count"] for r in rows} == {None: 3, 30: 14997, 150: 5000}
    assert seen[0].groupBy("__ao_pid").count().count() == 8


def test_as_of_edges(spark):
    l = spark.createDataFrame([("a", 1)], "k string, t int")
    r = spark.createDataFrame([("a", 1, 5)], "k string, rt int, v int")
    assert as_of_join(l.limit(0), r, ["k"], "t", "rt", ["v"]).collect() == []
    assert as_of_join(l, r.limit(0), ["k"], "t", "rt", ["v"]).collect()[0].v is None
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(l, r.withColumnRenamed("v", "t"), ["k"], "t", "rt", ["t"])
    with pytest.raises(ValueError, match="types"):
        as_of_join(l, r.withColumn("rt", F.col("rt").cast("long")), ["k"], "t", "rt", ["v"])


def claims(spark, rows):
    cols = ("provider_id string, service_date date, is_high_acuity_em int, is_99214 int, is_99215 int, is_referral int, is_eye_procedure int, "
            "total_paid_amount decimal(18,4), member_provider_distance double")
    return spark.createDataFrame(rows, cols)


def made(n=400, seed=1):
    import decimal
    rng = random.Random(seed)
    flag = lambda: rng.choice([0, 1, 1, None])
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.choice([rng.randint(0, 400), rng.randint(100, 110)]))
    return [(rng.choice(["h"] * 5 + ["a", "b"]), day(), flag(), flag(), flag(), flag(), flag(),
             rng.choice([None, decimal.Decimal(rng.randint(0, 99999)) / 100]), rng.choice([None, rng.random() * 50])) for _ in range(n)]


def mean(rows, i):
    v = [float(r[i]) for r in rows if r[i] is not None]
    return round(sum(v) / len(v), 6) if v else None


def test_snapshots_from_partials_equal_plain_windows(spark):
    rows = made()
    dates = [dt.date(2024, 2, 29), dt.date(2024, 8, 31), dt.date(2024, 9, 30), dt.date(2025, 1, 31), dt.date(2026, 1, 31)]
    frame = spark.createDataFrame([(d,) for d in dates], "snapshot_date date")
    got = fe.snapshots_from_daily(fe.daily_partials(claims(spark, rows).repartition(3)), frame, 6, 7).collect()
    want = {}
    for d in dates:
        y, m = fe._add_months(d, -6)
        import calendar
        start = dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1])) + dt.timedelta(days=1)
        for p in "hab":
            long = [r for r in rows if r[0] == p and start <= r[1] <= d]
            recent = [r for r in long if r[1] > d - dt.timedelta(days=7)]
            if long:
                want[d, p] = (*[mean(long, i) for i in (2, 3, 4, 5, 6, 7, 8)], len(recent), *[mean(recent, i) for i in (2, 5, 7, 8)])
    assert len(got) == len(want) > 8
    for r in got:
        assert tuple(None if x is None else round(x, 6) for x in r[2:]) == pytest.approx(want[r.snapshot_date, r.provider_id], abs=2e-6)


def test_recent_days_equal_plain_windows(spark):
    rows = made(120, 4)
    got = {(r.snapshot_date, r.provider_id): r for r in fe.recent_from_daily(fe.daily_partials(claims(spark, rows)), 7).collect()}
    want = {}
    for p in "hab":
        for d in {r[1] + dt.timedelta(days=k) for r in rows if r[0] == p for k in range(7)}:
            recent = [r for r in rows if r[0] == p and d - dt.timedelta(days=7) < r[1] <= d]
            want[d, p] = (len(recent), *[mean(recent, i) for i in (2, 5, 7, 8)])
    assert set(got) == set(want)
    for k, w in want.items():
        assert tuple(None if x is None else round(x, 6) for x in got[k][2:]) == pytest.approx(w, abs=2e-6)


def test_partials_are_read_once_whatever_the_window(spark):
    daily = fe.daily_partials(claims(spark, made(50))).checkpoint()
    dates = spark.createDataFrame([(dt.date(2024, 6, 30),), (dt.date(2024, 7, 31),)], "snapshot_date date")
    def moved(months):
        df = fe.snapshots_from_daily(daily, dates, months, 7)
        df.collect()
        return plan(df).count("Exchange hashpartitioning")
    assert moved(1) == moved(24) <= 4


def test_empty_claims_give_no_snapshots(spark):
    none = claims(spark, made(5)).limit(0)
    dates = spark.createDataFrame([(dt.date(2024, 6, 30),)], "snapshot_date date")
    assert fe.snapshot_backfill(none, dates).collect() == []
    assert fe.short_term_backfill(none, fe.snapshot_backfill(none, dates)).collect() == []
