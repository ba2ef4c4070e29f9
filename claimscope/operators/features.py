"""Provider feature engineering.

All aggregations are hash aggregates keyed by provider (plus split/date), so
Spark does partial aggregation map-side before the shuffle; a provider with a
third of the claims sends one partial row per task.  Peer baselines are
aggregates over the already-aggregated provider rows, grouped by split: at most
one row per split (two), so broadcasting them is size-safe.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.asof import SLICES, as_of_join
from ..functions.columns import attach_scalars, count_if, flag_rate, money_avg, money_avg_cents, safe_div
from ..functions.ranking import materialize, quantile_disc, tasks_for

# Configured provider features and their expressions (pipeline config).
FEATURE_SQL: dict[str, str] = {
    "high_acuity_pct": "AVG(CAST(is_high_acuity_em AS DOUBLE))",
    "pct_99214": "AVG(CAST(is_99214 AS DOUBLE))",
    "pct_99215": "AVG(CAST(is_99215 AS DOUBLE))",
    "referral_rate": "AVG(CAST(is_referral AS DOUBLE))",
    "eye_procedure_pct": "AVG(CAST(is_eye_procedure AS DOUBLE))",
    "avg_paid_per_claim": "CAST(SUM(total_paid_amount) AS DOUBLE) / COUNT(total_paid_amount)",
    "avg_member_provider_distance": "AVG(member_provider_distance)",
}
BASELINE_SQL: dict[str, str] = {"expected_high_acuity_pct": "AVG(high_acuity_pct)"}
DERIVED_SQL: dict[str, str] = {
    "high_acuity_oe_ratio": "try_divide(p.high_acuity_pct, b.expected_high_acuity_pct)",
}
# Model feature lists (random forest / xgboost configuration).
RF_FEATURES = ["high_acuity_pct", "pct_99214", "pct_99215", "referral_rate", "eye_procedure_pct",
               "avg_paid_per_claim", "high_acuity_oe_ratio", "avg_member_provider_distance"]
XGB_FEATURES = RF_FEATURES[:-1]
LONG_TERM_FEATURES = ["high_acuity_pct", "pct_99214", "pct_99215", "referral_rate", "eye_procedure_pct",
                      "avg_paid_per_claim", "high_acuity_oe_ratio", "avg_member_provider_distance"]
SHORT_TERM_FEATURES = ["claim_count_7d", "high_acuity_pct_7d", "referral_rate_7d", "avg_paid_per_claim_7d",
                       "avg_member_provider_distance_7d", "high_acuity_oe_ratio_7d"]
SPLITS = ("TRAIN", "TEST")


# --------------------------------------------------------------------------- F1
def _add_months(d: dt.date, k: int) -> tuple[int, int]:
    idx = d.year * 12 + d.month - 1 + k
    return idx // 12, idx % 12 + 1


def window_bounds(current_data_month: dt.date, train_months: int = 6, test_months: int = 3) -> dict[str, dt.date]:
    """Driver-side literal bounds for one month (used to prune scans with literals)."""
    if train_months < 1 or test_months < 1:
        raise ValueError("train_months and test_months must be >= 1")
    y, m = current_data_month.year, current_data_month.month
    test_end = dt.date(y, m, calendar.monthrange(y, m)[1])
    ty, tm = _add_months(current_data_month, -(test_months - 1))
    test_start = dt.date(ty, tm, 1)
    ey, em = _add_months(test_start, -1)
    train_end = dt.date(ey, em, calendar.monthrange(ey, em)[1])
    sy, sm = _add_months(train_end, -(train_months - 1))
    return {"train_start": dt.date(sy, sm, 1), "train_end": train_end,
            "test_start": test_start, "test_end": test_end}


def rolling_window(months: DataFrame, train_months: int = 6, test_months: int = 3,
                   month_col: str = "current_data_month") -> DataFrame:
    """TRAIN/TEST bounds for every month in ``months`` (column-wise, no driver loop)."""
    if train_months < 1 or test_months < 1:
        raise ValueError("train_months and test_months must be >= 1")
    m = F.trunc(F.col(month_col), "month")
    test_start = F.add_months(m, -(test_months - 1))
    train_end = F.date_sub(test_start, 1)
    return months.select(
        F.col(month_col),
        F.add_months(F.trunc(train_end, "month"), -(train_months - 1)).alias("train_start"),
        train_end.alias("train_end"),
        test_start.alias("test_start"),
        F.last_day(m).alias("test_end"),
    )


# --------------------------------------------------------------------------- F2
def assign_split(claims: DataFrame, bounds: Mapping[str, dt.date]) -> DataFrame:
    """keep claims inside [train_start, test_end] and label TRAIN/TEST (inclusive)."""
    sd = F.col("service_date")
    b = {k: F.lit(v) for k, v in bounds.items()}
    split = (F.when(sd.between(b["train_start"], b["train_end"]), F.lit("TRAIN"))
              .when(sd.between(b["test_start"], b["test_end"]), F.lit("TEST")))
    return (claims.where(sd.between(b["train_start"], b["test_end"]))
                  .withColumn("dataset_split", split)
                  .where(F.col("dataset_split").isNotNull()))


# --------------------------------------------------------------------------- F3
def provider_base(split_claims: DataFrame, feature_sql: Mapping[str, str] = FEATURE_SQL) -> DataFrame:
    """configured aggregates per (provider, split) plus dimensions, label and volume."""
    feats = [F.expr(e).alias(n) for n, e in feature_sql.items()]
    return split_claims.groupBy("provider_id", "dataset_split").agg(
        # ANY_VALUE made deterministic: max of the dimension.
        F.max("provider_name").alias("provider_name"),
        F.max("provider_specialty").alias("provider_specialty"),
        F.max("provider_city").alias("provider_city"),
        F.max("provider_state").alias("provider_state"),
        F.max("fraud_provider_label").alias("fraud_label"),
        F.count(F.lit(1)).alias("claim_count"),
        F.count_distinct("member_id").alias("unique_members"),
        *feats,
    )


# --------------------------------------------------------------------------- F4
def derive_features(base: DataFrame, derived_sql: Mapping[str, str] = DERIVED_SQL,
                    baseline_sql: Mapping[str, str] = BASELINE_SQL,
                    feature_names: Sequence[str] = tuple(FEATURE_SQL)) -> DataFrame:
    """per-split peer baseline (<= 2 rows, broadcast) and derived features.

    ``base`` is checkpointed once so the claims scan is not repeated for the baseline.
    """
    base = materialize(base)
    baseline = base.groupBy("dataset_split").agg(*[F.expr(e).alias(n) for n, e in baseline_sql.items()])
    p, b = base.alias("p"), F.broadcast(baseline).alias("b")
    j = p.join(b, F.col("p.dataset_split") == F.col("b.dataset_split"), "left")
    cols = [F.col(f"p.{c}") for c in ("provider_id", "provider_name", "provider_specialty", "provider_city",
                                      "provider_state", "dataset_split", "fraud_label", "claim_count",
                                      "unique_members")]
    cols += [F.col(f"p.{c}") for c in feature_names]
    cols += [F.expr(e).alias(n) for n, e in derived_sql.items()]
    return j.select(*cols)


def provider_features(claims: DataFrame, bounds: Mapping[str, dt.date],
                      feature_sql: Mapping[str, str] = FEATURE_SQL) -> DataFrame:
    """F2 -> F3 -> F4: the TRAIN/TEST provider feature table."""
    return derive_features(provider_base(assign_split(claims, bounds), feature_sql),
                           feature_names=tuple(feature_sql))


# --------------------------------------------------------------------------- F5
def provider_features_median(split_claims: DataFrame, snapshot_ts: Mapping[str, str] | None = None,
                             rows: int = 0, hot: Sequence[str] = (), placed: tuple[DataFrame, str] | None = None) -> DataFrame:
    """16 measures by (provider, city, state, specialty, split); median peer rate.

    A group has few claims and a claim mostly another member, so partial aggregates (one per member) would be wider and
    hardly fewer than the claims.  The claims themselves move, once, to the task of their group: one for about
    ``TASK_ROWS`` of the ``rows`` claims, or the shuffle partitions.  Groups of the ``hot`` providers are aggregated
    partially, by member, so none of them is one task.

    ``placed``: the claims of all but the ``hot`` providers where they lie together already, and the column by which they do.
    Each of its values has one provider_id.  These claims are taken for the same of ``split_claims`` and not moved.

    The median is an exact discrete quantile computed with a range-partitioned
    rank (no single-task sort even if one split holds every row).
    """
    # Snapshot timestamps per split (feature engineering script).
    snapshot_ts = snapshot_ts or {"TRAIN": "2026-06-30 23:59:59", "TEST": "2026-09-30 23:59:59"}
    keys = ["provider_id", "provider_city", "provider_state", "provider_specialty", "dataset_split"]
    ts = F.lit(None).cast("timestamp")
    for split, t in snapshot_ts.items():
        ts = F.when(F.col("dataset_split") == split, F.lit(t).cast("timestamp")).otherwise(ts)
    aggs = [
        F.count(F.lit(1)).alias("total_claims"),
        F.count_distinct("member_id").alias("unique_members"),
        F.sum("is_high_acuity_em").cast("long").alias("high_acuity_claims"),
        flag_rate("is_high_acuity_em").alias("high_acuity_pct"),
        F.sum("is_99214").cast("long").alias("claims_99214"),
        flag_rate("is_99214").alias("pct_99214"),
        F.sum("is_99215").cast("long").alias("claims_99215"),
        flag_rate("is_99215").alias("pct_99215"),
        F.sum("is_referral").cast("long").alias("referral_count"),
        flag_rate("is_referral").alias("referral_rate"),
        F.sum("is_eye_procedure").cast("long").alias("eye_procedure_claims"),
        flag_rate("is_eye_procedure").alias("eye_procedure_pct"),
        money_avg_cents("total_billed_amt").alias("avg_billed_per_claim"),
        money_avg_cents("total_allowed_amt").alias("avg_allowed_per_claim"),
        money_avg_cents("total_paid_amount").alias("avg_paid_per_claim"),
        F.sum("total_paid_amount").alias("total_paid"),
    ]
    cols = [*keys, "member_id", "is_high_acuity_em", "is_99214", "is_99215", "is_referral", "is_eye_procedure",
            "total_billed_amt", "total_allowed_amt", "total_paid_amount"]
    used = split_claims.select(*cols)
    is_hot = F.coalesce(F.col("provider_id").isin(*hot), F.lit(False)) if hot else F.lit(False)
    if placed is not None:
        near, by = placed
        m = near.select(by, *cols).groupBy(by, *keys).agg(*aggs).drop(by)
    else:
        m = used.where(~is_hot).repartition(tasks_for(used, rows), *keys).groupBy(*keys).agg(*aggs)
    if hot:
        m = m.unionByName(used.where(is_hot).groupBy(*keys).agg(*aggs))
    m = materialize(m.withColumn("feature_timestamp", ts))
    base = quantile_disc(m, ["dataset_split"], "high_acuity_pct", 0.5, "peer_high_acuity_rate")
    p, b = m.alias("p"), F.broadcast(base).alias("b")
    expected = F.col("p.total_claims") * F.col("b.peer_high_acuity_rate")
    return p.join(b, F.col("p.dataset_split") == F.col("b.dataset_split"), "left").select(
        F.col("p.provider_id").alias("entity_id"), *[F.col(f"p.{k}") for k in keys], F.col("p.feature_timestamp"),
        "p.total_claims", "p.unique_members", "p.high_acuity_claims", "p.high_acuity_pct",
        "p.claims_99214", "p.pct_99214", "p.claims_99215", "p.pct_99215", "p.referral_count",
        "p.referral_rate", "p.eye_procedure_claims", "p.eye_procedure_pct",
        "p.avg_billed_per_claim", "p.avg_allowed_per_claim", "p.avg_paid_per_claim",
        F.round(F.col("p.total_paid"), 2).cast("decimal(18,2)").alias("total_paid"),
        F.col("b.peer_high_acuity_rate"),
        expected.alias("expected_high_acuity_claims"),
        safe_div(F.col("p.high_acuity_claims"), expected).alias("high_acuity_oe_ratio"),
    )


# --------------------------------------------------------------------------- F6
def _long_term_start(snapshot_date, months: int):
    return F.date_add(F.add_months(snapshot_date, -months), 1)


def _snapshot_ts(snapshot_date):
    return F.make_timestamp(F.year(snapshot_date), F.month(snapshot_date), F.dayofmonth(snapshot_date),
                            F.lit(23), F.lit(59), F.lit(59))


def long_term_snapshot(claims: DataFrame, snapshot_date: dt.date, months: int = 6, days: int = 7) -> DataFrame:
    """trailing ``months`` and trailing ``days`` measures in one scan/aggregate."""
    return snapshot_backfill(claims, [snapshot_date], months, days)


def month_ends(claims: DataFrame) -> DataFrame:
    """The ``snapshot_date`` frame of a full backfill: the end of every month with a claim (or a daily partial)."""
    return claims.select(F.last_day("service_date").alias("snapshot_date")).distinct()


#: Additive measures of a claim: name -> column.  Flags are counted, amounts summed.
_ADDED = {"high_acuity": "is_high_acuity_em", "em_99214": "is_99214", "em_99215": "is_99215", "referral": "is_referral",
          "eye": "is_eye_procedure", "paid": "total_paid_amount", "distance": "member_provider_distance"}
# measure -> what it is the mean of; the recent ones are the same means over fewer days
_LONG_OF = {"high_acuity_pct": "high_acuity", "pct_99214": "em_99214", "pct_99215": "em_99215", "referral_rate": "referral",
            "eye_procedure_pct": "eye", "avg_paid_per_claim": "paid", "avg_member_provider_distance": "distance"}
_RECENT_OF = {"high_acuity_pct_7d": "high_acuity", "referral_rate_7d": "referral", "avg_paid_per_claim_7d": "paid",
              "avg_member_provider_distance_7d": "distance"}


def daily_partials(claims: DataFrame) -> DataFrame:
    """Sums and counts per (provider, day): every window's measures follow from them.

    Doubles are summed per day and kept to nine decimals, so that differences of running sums
    are exact from there on.
    """
    aggs = [F.count(F.lit(1)).alias("claims")]
    for name, c in _ADDED.items():
        total = F.sum(c)
        if isinstance(claims.schema[c].dataType, (T.DoubleType, T.FloatType)):
            total = total.cast("decimal(28,9)")
        aggs += [total.alias(f"sum_{name}"), F.count(c).alias(f"n_{name}")]
    return claims.groupBy("provider_id", "service_date").agg(*aggs)


def _additive(daily: DataFrame) -> list[str]:
    return [c for c in daily.columns if c not in ("provider_id", "service_date")]


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def snapshots_from_daily(daily: DataFrame, dates: DataFrame, months: int = 6, days: int = 7) -> DataFrame:
    """Measures of the trailing ``months`` and ``days`` per (snapshot_date, provider) with a claim in the long one.

    A provider's running sums over its days are looked up at the ends of each window and
    subtracted: every partial is read once, however long the windows are and however many of them it is in.
    A provider's group has one row per day and three per snapshot date.
    """
    d = F.col("snapshot_date")
    all_dates = dates.agg(F.array_sort(F.collect_set("snapshot_date")).alias("__dates"))  # one row: the snapshot dates
    spans = daily.groupBy("provider_id").agg(F.min("service_date").alias("__first"), F.max("service_date").alias("__last"))
    within = F.filter("__dates", lambda x: (x >= F.col("__first")) & (_long_term_start(x, months) <= F.col("__last")))
    pairs = attach_scalars(spans, all_dates).select("provider_id", F.explode(within).alias("snapshot_date"))
    ends = F.array(F.struct(d.alias("service_date"), F.lit(1).alias("__long"), F.lit(1).alias("__recent")),
                   F.struct(F.date_sub(_long_term_start(d, months), 1).alias("service_date"), F.lit(-1).alias("__long"), F.lit(0).alias("__recent")),
                   F.struct(F.date_sub(d, days).alias("service_date"), F.lit(0).alias("__long"), F.lit(-1).alias("__recent")))
    asked = pairs.select("provider_id", "snapshot_date", F.inline(ends))
    names = _additive(daily)
    running = Window.partitionBy("provider_id").orderBy("service_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = daily.unionByName(asked, allowMissingColumns=True).select(
        "provider_id", "snapshot_date", "__long", "__recent", *[F.sum(c).over(running).alias(c) for c in names])
    both = rows.where(d.isNotNull()).groupBy("provider_id", "snapshot_date").agg(
        *[F.sum(F.col(c) * F.col("__long")).alias(c) for c in names],
        *[F.sum(F.col(c) * F.col("__recent")).alias(f"recent_{c}") for c in names])
    return both.where(F.col("claims") > 0).select(
        "snapshot_date", "provider_id",
        *[_mean(F.col(f"sum_{a}"), F.col(f"n_{a}")).alias(m) for m, a in _LONG_OF.items()],
        F.coalesce("recent_claims", F.lit(0)).cast("long").alias("claim_count_7d"),
        *[_mean(F.col(f"recent_sum_{a}"), F.col(f"recent_n_{a}")).alias(m) for m, a in _RECENT_OF.items()])


def snapshot_backfill(claims: DataFrame | None, dates: Sequence[dt.date] | DataFrame | None = None, months: int = 6,
                      days: int = 7, daily: DataFrame | None = None) -> DataFrame:
    """many long-term snapshots at once.

    ``dates``: a short list or a 1-column ``snapshot_date`` frame, bounded by the number of
    snapshot dates; without it, the end of every month with a claim.  Claims are aggregated once per (provider, day);
    all windows come from those.  ``daily``: stored ``daily_partials`` of the claims, which are then not read.
    """
    if months < 1 or days < 1:
        raise ValueError("months and days must be >= 1")
    spark = (claims if daily is None else daily).sparkSession
    if dates is not None and not isinstance(dates, DataFrame):
        if not dates:
            raise ValueError("no snapshot dates")
        lo, hi = min(dates), max(dates)
        dates = spark.createDataFrame([(d,) for d in sorted(set(dates))], "snapshot_date date")
        # literal pruning of the claims scan
        lo_bound = min(dt.date(*_add_months(lo, -months), 1), lo - dt.timedelta(days=days))
        if daily is None:
            claims = claims.where(F.col("service_date").between(F.lit(lo_bound), F.lit(hi)))
    if daily is None:
        daily = materialize(daily_partials(claims))
    if dates is None:
        dates = month_ends(daily)
    return with_peer_ratios(materialize(snapshots_from_daily(daily, dates, months, days)))


def with_peer_ratios(prov: DataFrame) -> DataFrame:
    """The snapshot table's columns: measures with their ratio to the mean of all providers of the date."""
    # one baseline row per snapshot date: broadcast, so that the providers' rows do not move to meet it
    base = prov.groupBy("snapshot_date").agg(
        F.avg("high_acuity_pct").alias("expected_high_acuity_pct"),
        F.avg("high_acuity_pct_7d").alias("expected_high_acuity_pct_7d"))
    out = prov.join(F.broadcast(base), "snapshot_date", "inner")
    return out.select(
        F.col("provider_id").alias("entity_id"), "provider_id",
        _snapshot_ts(F.col("snapshot_date")).alias("feature_timestamp"),
        "high_acuity_pct", "pct_99214", "pct_99215", "referral_rate", "eye_procedure_pct", "avg_paid_per_claim",
        safe_div("high_acuity_pct", "expected_high_acuity_pct").alias("high_acuity_oe_ratio"),
        "avg_member_provider_distance", "claim_count_7d", "high_acuity_pct_7d", "referral_rate_7d",
        "avg_paid_per_claim_7d", "avg_member_provider_distance_7d",
        safe_div("high_acuity_pct_7d", "expected_high_acuity_pct_7d").alias("high_acuity_oe_ratio_7d"),
    )


# --------------------------------------------------------------------------- F8
def latest_as_of(history: DataFrame, as_of: dt.date, key: str = "entity_id", ts: str = "feature_timestamp",
                 not_null_col: str = "high_acuity_pct") -> DataFrame:
    """F8: latest non-null row per entity with DATE(ts) <= as_of (as-of lookup).

    ``max_by`` aggregate: map-side partial aggregation, no per-entity sort.
    """
    from ..functions.ranking import latest_per
    h = history.where((F.to_date(F.col(ts)) <= F.lit(as_of)) & F.col(not_null_col).isNotNull())
    # rows of one time: the last in column order, so that the choice is always the same
    return latest_per(h, [key], [ts, *[c for c in history.columns if c not in (key, ts)]])


def profiles_as_of(rows: DataFrame, history: DataFrame, row_time: str, key: str = "provider_id", ts: str = "feature_timestamp",
                   not_null_col: str = "high_acuity_pct", take: Sequence[str] = tuple(LONG_TERM_FEATURES),
                   num_slices: int = SLICES) -> DataFrame:
    """F8 for many rows: each row with the latest non-null profile of its entity at its own time.

    ``row_time`` is a timestamp; a profile of the same time counts.  ``num_slices``: as in ``as_of_join``.
    """
    known = history.where(F.col(not_null_col).isNotNull())
    return as_of_join(rows, known, [key], row_time, ts, take, num_slices)


# --------------------------------------------------------------------------- F7
def short_term_snapshot(claims: DataFrame, history: DataFrame, snapshot_date: dt.date, days: int = 7) -> DataFrame:
    """providers with a claim in the last ``days``; carries the latest long-term profile."""
    if days < 1:
        raise ValueError("days must be >= 1")
    d = F.lit(snapshot_date)
    recent = claims.where(F.col("service_date").between(F.date_sub(d, days - 1), d))
    s = recent.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("claim_count_7d"),
        flag_rate("is_high_acuity_em").alias("high_acuity_pct_7d"),
        flag_rate("is_referral").alias("referral_rate_7d"),
        money_avg("total_paid_amount").alias("avg_paid_per_claim_7d"),
        F.avg("member_provider_distance").alias("avg_member_provider_distance_7d"),
    )
    s = materialize(s)
    base = s.agg(F.avg("high_acuity_pct_7d").alias("expected_high_acuity_pct_7d"))  # exactly one row
    latest = latest_as_of(history, snapshot_date).select("provider_id", *LONG_TERM_FEATURES)
    j = attach_scalars(s.join(latest, "provider_id", "left"), base)
    return j.select(
        F.col("provider_id").alias("entity_id"), "provider_id",
        _snapshot_ts(d).alias("feature_timestamp"), *LONG_TERM_FEATURES,
        "claim_count_7d", "high_acuity_pct_7d", "referral_rate_7d", "avg_paid_per_claim_7d",
        "avg_member_provider_distance_7d",
        safe_div("high_acuity_pct_7d", "expected_high_acuity_pct_7d").alias("high_acuity_oe_ratio_7d"),
    )


_RECENT_SUMS = ["claims", *[f"{k}_{a}" for a in _RECENT_OF.values() for k in ("sum", "n")]]


def recent_from_daily(daily: DataFrame, days: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """Measures of the trailing ``days`` for every (snapshot_date, provider) with a claim in them.

    Each day with claims is followed by the days up to the next one, ``days`` - 1 at most; a range frame
    over the days adds the partials up.  A provider's group has one row per day.

    ``keep``: columns that a snapshot takes from the last row up to its date.  They may change on days without
    claims: such a row has no ``claims``.
    """
    if days < 1:
        raise ValueError("days must be >= 1")
    claimed = F.col("claims").isNotNull()
    w = Window.partitionBy("provider_id").orderBy("service_date", claimed)
    newest = F.last(F.when(claimed, F.col("service_date")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    upto = F.least(F.date_add("__newest", days - 1), F.coalesce(F.date_sub("__next", 1), F.lit(dt.date.max)))
    spread = daily.select("provider_id", "service_date", *_RECENT_SUMS, *keep, newest.alias("__newest"), F.lead("service_date").over(w).alias("__next")).where(
        F.col("__newest").isNotNull() & (upto >= F.col("service_date"))).select(
        "provider_id", F.explode(F.sequence("service_date", upto)).alias("snapshot_date"), "service_date", *_RECENT_SUMS, *keep)
    own = F.col("service_date") == F.col("snapshot_date")  # the partials stand on their own day only
    frame = Window.partitionBy("provider_id").orderBy(F.unix_date("snapshot_date")).rangeBetween(-(days - 1), 0)
    added = spread.select("provider_id", "snapshot_date", *keep, *[F.sum(F.when(own, F.col(c))).over(frame).alias(c) for c in _RECENT_SUMS])
    return added.select("snapshot_date", "provider_id", F.col("claims").cast("long").alias("claim_count_7d"),
                        *[_mean(F.col(f"sum_{a}"), F.col(f"n_{a}")).alias(m) for m, a in _RECENT_OF.items()], *keep)


def _days_with_profiles(daily: DataFrame, history: DataFrame) -> DataFrame:
    """Partials of each day, and a row without claims for each day on which a profile becomes known, with the profile known then.

    One row per provider and day on the left and one per provider and snapshot on the right: the groups are bounded.
    """
    ts = F.col("feature_timestamp")
    known_on = F.date_add(F.to_date(ts), F.when(ts > _snapshot_ts(F.to_date(ts)), 1).otherwise(0))
    marks = history.select("provider_id", known_on.alias("service_date"))
    rows = daily.select("provider_id", "service_date", *_RECENT_SUMS).unionByName(marks, allowMissingColumns=True)
    profile = history.select("provider_id", ts.alias("__profile_ts"), *LONG_TERM_FEATURES)
    return profiles_as_of(rows.withColumn("__at", _snapshot_ts(F.col("service_date"))), profile, "__at", ts="__profile_ts", num_slices=1)


def short_term_backfill(claims: DataFrame | None, history: DataFrame, days: int = 7, daily: DataFrame | None = None,
                        wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """F7 for every day: each (day, provider) with a claim in the last ``days``, the peer ratio of the
    day, and the long-term profile as it was known on that day.

    Profiles are joined to the days with claims, before these are followed by the days up to the next one: the
    snapshots, several for each such day, are neither moved nor stored.

    ``daily``: stored ``daily_partials`` of the claims, which are then not read.  ``wanted``: a condition on the
    day; only the rows of such days are stored.
    """
    daily = daily_partials(claims) if daily is None else daily
    s = recent_from_daily(_days_with_profiles(daily, history), days, LONG_TERM_FEATURES)
    if wanted is None:
        peers = recent_from_daily(daily, days)  # added up again: narrow, and nothing is stored
    else:
        s = peers = materialize(s.where(wanted(F.col("snapshot_date"))))
    # one row per day; summed as decimals, so that a mean does not depend on the order of its rows
    rate = F.col("high_acuity_pct_7d")
    base = peers.groupBy("snapshot_date").agg(money_avg(rate.cast("decimal(20,12)")).alias("expected_high_acuity_pct_7d"))
    j = s.withColumn("feature_timestamp", _snapshot_ts(F.col("snapshot_date"))).join(F.broadcast(base), "snapshot_date")
    return j.select(
        F.col("provider_id").alias("entity_id"), "provider_id", "feature_timestamp", *LONG_TERM_FEATURES,
        "claim_count_7d", "high_acuity_pct_7d", "referral_rate_7d", "avg_paid_per_claim_7d", "avg_member_provider_distance_7d",
        safe_div("high_acuity_pct_7d", "expected_high_acuity_pct_7d").alias("high_acuity_oe_ratio_7d"))


# --------------------------------------------------------------------------- F10
def default_snapshot_dates(df: DataFrame, date_col: str = "run_date") -> DataFrame:
    """previous month end (long-term) and yesterday (short-term) per run date."""
    d = F.col(date_col)
    return df.select(d, F.last_day(F.add_months(d, -1)).alias("long_term_snapshot_date"),
                     F.date_sub(d, 1).alias("short_term_snapshot_date"))


# --------------------------------------------------------------------------- F11
def snapshot_stats(history: DataFrame, snapshot_date: dt.date, ts: str = "feature_timestamp") -> DataFrame:
    """providers and min/max timestamp written for one snapshot date."""
    h = history.where(F.to_date(F.col(ts)) == F.lit(snapshot_date))
    return h.agg(F.count(F.lit(1)).alias("providers"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


# --------------------------------------------------------------------------- F12
def refresh_summary(features: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """per split rows, claims used, fraud/normal providers; missing splits flagged."""
    spark = features.sparkSession
    agg = features.groupBy("dataset_split").agg(
        F.count(F.lit(1)).alias("provider_rows"),
        F.sum("claim_count").cast("long").alias("claims_used"),
        count_if(F.col("fraud_label") == 1).alias("fraud_providers"),
        count_if(F.col("fraud_label") == 0).alias("normal_providers"))
    wanted = spark.createDataFrame([(s,) for s in splits], "dataset_split string")
    j = wanted.join(agg, "dataset_split", "full_outer")
    return j.select(
        "dataset_split",
        F.coalesce("provider_rows", F.lit(0)).cast("long").alias("provider_rows"),
        F.coalesce("claims_used", F.lit(0)).cast("long").alias("claims_used"),
        F.coalesce("fraud_providers", F.lit(0)).cast("long").alias("fraud_providers"),
        F.coalesce("normal_providers", F.lit(0)).cast("long").alias("normal_providers"),
        F.col("provider_rows").isNull().alias("is_missing"),
    )


# --------------------------------------------------------------------------- F13
def feature_null_gate(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per feature (one scan), long form with PASS/FAIL."""
    if not cols:
        raise ValueError("no feature columns")
    wide = features.agg(*[count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "feature_name", "null_count")
    return long.select("feature_name", F.col("null_count").cast("long").alias("null_count"),
                       F.when(F.col("null_count") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))
