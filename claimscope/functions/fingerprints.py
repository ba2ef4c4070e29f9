"""Reconciliation of two large tables by fingerprints of id buckets.

Every row has a 64-bit hash of its id and values.  Rows are dealt to buckets by their id, and a bucket's
fingerprint is its row count and two order-independent sums of such hashes.  Equal fingerprints mean
equal buckets (but for a chance of about 2^-64 a bucket); only rows of the other buckets are joined.
What both sides send is one small row per bucket, and equal tables join nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets: what reaches the driver is at most this many numbers.
BUCKETS = 4096


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def bucket_fingerprints(df: DataFrame, key: str, cols: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, f1, f2), combined before the shuffle.  Rows without an id are left out."""
    values = [F.col(key).cast("string"), *[F.col(c) for c in cols]]
    # a null value hashes like nothing at all, so its place is said too
    nulls = [F.col(c).isNull() for c in cols]
    return (df.where(F.col(key).isNotNull())
              .select(bucket_of(key, buckets).alias("bucket"), F.xxhash64(*values, *nulls).alias("h"), F.xxhash64(F.lit(1), *values, *nulls).alias("g"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("f1"),
                                     F.sum(F.col("g").cast("decimal(38,0)")).alias("f2")))


def differing_buckets(a: DataFrame, b: DataFrame) -> list[int]:
    """The buckets whose fingerprints are not the same, in order."""
    x = a.select("bucket", F.struct("n", "f1", "f2").alias("a"))
    y = b.select("bucket", F.struct("n", "f1", "f2").alias("b"))
    return sorted(r.bucket for r in x.join(y, "bucket", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket").collect())


def rows_of(df: DataFrame, key: str, wanted: Sequence[int], buckets: int = BUCKETS) -> DataFrame:
    """The rows whose id lies in the buckets ``wanted``: a filter on a set of numbers, no join."""
    return df.where(bucket_of(key, buckets).isin([int(x) for x in wanted]))
