"""Mergeable sketches: distinct members and score quantiles without reading rows again.

A sketch per (provider, day) or per run is stored once; any window or group of runs is a merge of
sketches, whose size does not depend on the rows behind them.  Exact paths stay the default elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 1000


# distinct counts --------------------------------------------------------------
def distinct_error(lg_k: int = LG_K, sigmas: float = 4.0) -> float:
    """Relative error that an estimate exceeds with the probability of ``sigmas`` standard deviations."""
    return sigmas * 1.04 / math.sqrt(1 << lg_k)


def distinct_sketches(rows: DataFrame, by: Sequence[str], col: str, out: str = "members", lg_k: int = LG_K) -> DataFrame:
    """One HyperLogLog sketch of the distinct non-null ``col`` per group (combined before the shuffle)."""
    if not 4 <= lg_k <= 21:
        raise ValueError("lg_k must be in 4..21")
    return rows.where(F.col(col).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(col, lg_k).alias(out))


def distinct_estimates(sketches: DataFrame, by: Sequence[Column | str], sketch: str = "members", out: str = "unique_members") -> DataFrame:
    """Estimated distinct values per group of sketches: a merge, no row is read again."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))


def distinct_in_bound(estimate: Column, exact: Column, lg_k: int = LG_K) -> Column:
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(distinct_error(lg_k)))


# quantiles --------------------------------------------------------------------
def rank_error(k: int = KLL_K, times: float = 3.0) -> float:
    """``times`` the normalised rank error that a KLL sketch of size ``k`` states for 99 % confidence."""
    return times * 2.446 / k ** 0.9433


def score_sketches(scores: DataFrame, by: Sequence[str], col: str = "fraud_score", out: str = "scores", k: int = KLL_K) -> DataFrame:
    """One KLL sketch, the row count and the mean of the non-null, non-NaN ``col`` per group."""
    known = scores.where(F.col(col).isNotNull() & ~F.isnan(col))
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(col), F.lit(k)).alias(out), F.count(F.lit(1)).alias("row_count"),
                                  F.sum(col).alias("score_sum"))


def merged_sketches(sketches: DataFrame, by: Sequence[str], out: str = "scores", k: int = KLL_K) -> DataFrame:
    """Sketches of larger groups from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double(F.col(out), F.lit(k)).alias(out), F.sum("row_count").alias("row_count"),
                                     F.sum("score_sum").alias("score_sum"))


def sketch_summary(sketches: DataFrame, qs: Sequence[float] = (0.5, 0.9, 0.95), names: Sequence[str] = ("p50", "p90", "p95"),
                   sketch: str = "scores") -> DataFrame:
    """M7 from stored sketches: count, mean and quantiles; the sketch column goes."""
    got = F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*[F.lit(float(q)) for q in qs]))
    return (sketches.withColumn("__q", got).withColumn("mean_score", F.try_divide("score_sum", F.col("row_count").cast("double")))
                    .select(*[c for c in sketches.columns if c not in (sketch, "score_sum")], "mean_score",
                            *[F.col("__q")[i].alias(n) for i, n in enumerate(names)]))


def sketch_psi(current: Column, baseline: Column, buckets: int = 10, floor_rate: float = 0.0001) -> Column:
    """M8 from two stored sketches: the index over ``buckets`` equal score buckets of [0, 1], from ranks at their borders.

    The last bucket takes what lies above 1 too; what lies below 0 counts to the first.
    """
    if buckets < 2:
        raise ValueError("buckets must be >= 2")
    # values equal to a border belong above it
    borders = F.array(*[F.lit(i / buckets - 1e-12) for i in range(1, buckets)])

    def rates(sketch: Column) -> Column:
        upto = F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_double(sketch, borders), F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.lit(buckets)), lambda i: F.greatest(F.get(upto, i) - F.get(upto, i - 1), F.lit(floor_rate)))
    pairs = F.zip_with(rates(current), rates(baseline), lambda c, b: (c - b) * F.ln(c / b))
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)
