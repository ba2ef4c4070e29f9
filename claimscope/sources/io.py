"""Append-only history, idempotent slice replacement, keyed upsert and
partitioned writes (S3-S6).

Plain Parquet has no MERGE/UPDATE/DELETE, so each mutation is a pure function
returning the new table; persisting it is a separate, atomic-per-partition
write (dynamic partition overwrite) into the shared checkpoint/warehouse path
the cluster names -- never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import align_schema


# S3 -----------------------------------------------------------------------------
def append_history(history: DataFrame, new_rows: DataFrame) -> DataFrame:
    """S3: history + new rows; old rows are never rewritten.  Column sets may differ
    (schema widening): missing columns are NULL on either side."""
    return history.unionByName(new_rows, allowMissingColumns=True)


def append_history_to(path: str, new_rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
    """S3 on storage: write ``new_rows`` in append mode (existing files untouched)."""
    w = new_rows.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# S4 -----------------------------------------------------------------------------
def replace_slice(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the ``keys`` slices present in ``new`` (left anti join on the
    distinct slice keys -- a handful of runs, broadcast by AQE) then insert ``new``.
    Re-running with the same input gives the same table (idempotent)."""
    slices = new.select(*keys).distinct()
    kept = target.join(slices, list(keys), "left_anti")
    return kept.unionByName(align_schema(new, target.schema).select(*target.columns))


# S5 -----------------------------------------------------------------------------
def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """S5 (MERGE): matched keys -> only ``update_cols`` take the source value;
    unmatched source rows are inserted (all target columns, missing ones NULL);
    unmatched target rows are kept.  One full outer join on the keys.  As in a MERGE, a
    key that the source holds twice is an error.
    """
    keys, update_cols = list(keys), list(update_cols)
    bad = [c for c in update_cols if c in keys]
    if bad:
        raise ValueError(f"cannot update key columns {bad}")
    twice = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys).head(1)
    if twice:
        raise ValueError(f"the source holds a key more than once: {twice[0].asDict()}")
    t = target.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("__t"))
    src_cols = [c for c in source.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in src_cols], F.lit(True).alias("__s"))
    j = t.join(s, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        tgt = F.col(f"__t_{c}")
        src = F.col(f"__s_{c}") if c in src_cols else F.lit(None).cast(target.schema[c].dataType)
        matched = F.col("__t").isNotNull() & F.col("__s").isNotNull()
        inserted = F.col("__t").isNull()
        if c in update_cols:
            val = F.when(matched | inserted, src).otherwise(tgt)
        else:
            val = F.when(inserted, src).otherwise(tgt)
        out.append(val.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


# S6 -----------------------------------------------------------------------------
def partition_layout(df: DataFrame, ts_col: str, cluster_col: str, date_col: str = "feature_date",
                     files_per_date: int = 4) -> DataFrame:
    """S6 layout: a physical date partition column and rows clustered by entity
    inside each file (``sortWithinPartitions``), so readers prune by date and
    skip row groups by entity.  A date's rows go to ``files_per_date`` tasks by a hash of the
    entity, so one daily snapshot is not written by a single task."""
    if files_per_date < 1:
        raise ValueError("files_per_date must be >= 1")
    d = df.withColumn(date_col, F.to_date(F.col(ts_col)))
    part = F.pmod(F.xxhash64(cluster_col), F.lit(files_per_date))
    n = max(files_per_date, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return d.repartition(n, F.col(date_col), part).sortWithinPartitions(date_col, cluster_col)


def write_partitioned(df: DataFrame, path: str, ts_col: str = "feature_timestamp", cluster_col: str = "provider_id",
                      date_col: str = "feature_date", files_per_date: int = 4) -> None:
    """Write by date partition; only the dates present in ``df`` are replaced
    (dynamic partition overwrite), like ``CREATE OR REPLACE`` of one snapshot."""
    (partition_layout(df, ts_col, cluster_col, date_col, files_per_date).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir`` (shared storage)."""
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
