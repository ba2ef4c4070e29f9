"""MERGE and slice replacement on stored tables, touching only the partitions concerned.

The target is a Parquet table partitioned by date (S5) or by the slice keys (S4).  What a step will write is
first computed into a staging folder, and the affected partitions are then overwritten from
there (dynamic partition overwrite).  A step that dies half-way is run again: the staged
rows are a function of the source and of rows that are either old or already merged, and merging twice
changes nothing.  Files of other partitions are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .io import partition_layout, shared_path, upsert
from .schemas import align_schema


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned table read with its declared types (partition values are never guessed)."""
    return spark.read.schema(schema).parquet(path)


def merge_dates(path: str, source: DataFrame, schema: T.StructType, keys: Sequence[str], update_cols: Sequence[str],
                ts_col: str = "feature_timestamp", cluster_col: str = "provider_id", date_col: str = "feature_date",
                files_per_date: int = 4) -> list[dt.date]:
    """S5 on storage: MERGE ``source`` into the table at ``path``; returns the dates it touched.

    ``schema``: the table's columns, ``date_col`` included, which is ``DATE(ts_col)``.  ``ts_col`` must be one of
    the keys, so that a matched row stays in its partition.  The dates of the source prune the target's
    partitions before anything is joined.  A key that the source holds twice, or one without a time, is an error.
    """
    if ts_col not in keys:
        raise ValueError(f"{ts_col} must be a merge key: it decides the partition")
    if not update_cols:
        raise ValueError("no columns to update")
    spark = source.sparkSession
    # as many values as the source has dates, each a folder of the table
    dates = [r[0] for r in source.select(F.to_date(ts_col).alias("d")).distinct().orderBy("d").collect()]
    if None in dates:
        raise ValueError(f"the source has rows without {ts_col}")
    if not dates:
        return []
    plain = T.StructType([f for f in schema if f.name != date_col])
    target = stored(spark, path, schema).where(F.col(date_col).isin(dates)).select(*plain.names)
    merged = upsert(target, source, keys, update_cols)
    staging = shared_path(spark, "claimscope/merge-staging")
    partition_layout(merged, ts_col, cluster_col, date_col, files_per_date).write.partitionBy(date_col).parquet(staging)
    staged = stored(spark, staging, schema).select(*plain.names)
    _overwrite(partition_layout(staged, ts_col, cluster_col, date_col, files_per_date), path, [date_col])
    return dates


def replace_slices(path: str, new: DataFrame, schema: T.StructType, keys: Sequence[str], tasks_per_slice: int = 4) -> None:
    """S4 on storage: the slices (key values) present in ``new`` are replaced by its rows, others stay as they are.

    A slice is a partition folder; its rows go to ``tasks_per_slice`` tasks by a hash of the row.  Key values that are
    null or empty are an error: storage can't tell them apart.
    """
    keys = list(keys)
    bad = None
    for c in keys:
        empty = F.col(c).isNull() | (F.col(c).cast("string") == "")
        bad = empty if bad is None else bad | empty
    if new.where(bad).head(1):
        raise ValueError(f"slices need values in {keys}")
    rows = align_schema(new, schema).select(*[f.name for f in schema])
    spark = new.sparkSession
    staging = shared_path(spark, "claimscope/slice-staging")
    rows.write.parquet(staging)
    staged = spark.read.schema(schema).parquet(staging)
    spread = F.pmod(F.xxhash64(*[f.name for f in schema if f.name not in keys]), F.lit(tasks_per_slice))
    n = max(tasks_per_slice, int(spark.conf.get("spark.sql.shuffle.partitions")))
    _overwrite(staged.repartition(n, *keys, spread), path, keys)
