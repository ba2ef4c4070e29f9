"""Claims stored in buckets by provider, so that provider aggregates and joins need no shuffle.

The table is written once; every later aggregate by provider reads a bucket per task and combines in place.
A bucket holds whole providers: choose the number of buckets so that the largest provider fits a
task, or keep to the plain tables (whose aggregates combine before they shuffle) where one provider holds a large
share of all claims.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .io import shared_path


#: Rows that a bucket is meant to hold, and buckets of a small table.
BUCKET_ROWS, LEAST_BUCKETS = 400_000, 16


def buckets_for(rows: int) -> int:
    """Number of buckets that keeps one bucket, and so the memory of one task, the same at any table size."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def write_bucketed(df: DataFrame, key: str = "provider_id", buckets: int = 64, name: str = "claims") -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key`` in the shared folder, read back with its layout.

    Rows are shuffled once, to one task per bucket, so there is one file per bucket.
    """
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    # the expression of Spark's own bucketing, so that every bucket is written by one task
    (df.repartition(buckets, F.col(key)).write.format("parquet").option("path", shared_path(spark, f"claimscope/{name}"))
       .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)
