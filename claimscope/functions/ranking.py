"""Distributed ranking, exact quantiles and top-k.

``ROW_NUMBER() OVER (ORDER BY ...)`` without ``PARTITION BY`` (or partitioned by a
key that may hold most rows, such as one scoring run) moves every row into one
task.  ``row_number_by`` avoids that:

1. range-partition on (group keys, order keys) -> every task holds a contiguous
   slice of the global order, so one hot group is split over many tasks;
2. number rows inside each task (``monotonically_increasing_id`` is
   ``partition_index << 33 | position`` after ``sortWithinPartitions``);
3. aggregate (partition, group) -> first id and row count.  That table has at most
   ``partitions + groups`` rows; an exclusive running sum over it gives each
   slice's offset within its group, joined back (Spark broadcasts it when it is small).

The result equals ``row_number() over (partition by g order by o)`` with a total
order (callers end every ordering with an id column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "__rk_pid"
_MID = "__rk_mid"


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def row_number_by(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str],
                  out: str = "rn", num_partitions: int | None = None, count_col: str | None = None) -> DataFrame:
    """Exact per-group row_number without a single-task window.

    ``count_col`` also attaches the group's row count, taken from the same small
    slice table (no separate count aggregate and no join against the rows).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in partition_by]
    order = _sort_cols(order_by)
    ranged = (df.repartitionByRange(n, *keys, *order)
                .sortWithinPartitions(*keys, *order)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    # The numbered slices are read twice (offset table + rows).  Range bounds are
    # sampled per execution, so two executions may cut different slices: the
    # numbered rows are checkpointed once (reliable storage under
    # spark.checkpoint.dir), which also cuts the lineage for recovery.
    ranged = _materialize(ranged)
    slices = (ranged.groupBy(_PID, *partition_by)
                    .agg(F.min(_MID).alias("__rk_first"), F.count(F.lit(1)).alias("__rk_cnt")))
    w = Window.partitionBy(*partition_by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__rk_off", F.coalesce(F.sum("__rk_cnt").over(w), F.lit(0)))
    if count_col:
        tot = Window.partitionBy(*partition_by)
        slices = slices.withColumn(count_col, F.sum("__rk_cnt").over(tot))
    # slices holds <= partitions + groups rows; groups may be many, so the join strategy is Spark's choice
    joined = _join_slices(ranged, slices.drop("__rk_cnt"), partition_by)
    rn = (F.col(_MID) - F.col("__rk_first") + F.col("__rk_off") + F.lit(1)).cast("long")
    return joined.withColumn(out, rn).drop(_PID, _MID, "__rk_first", "__rk_off")


def _join_slices(rows: DataFrame, slices: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows with the columns of their (partition, group) slice; a NULL group key is a group."""
    keys = [_PID, *partition_by]
    right = slices.withColumnsRenamed({c: f"__s_{c}" for c in keys})
    on = [rows[c].eqNullSafe(right[f"__s_{c}"]) for c in keys]
    return rows.join(right, on, "inner").drop(*[f"__s_{c}" for c in keys])


def materialize(df: DataFrame) -> DataFrame:
    """Reliable eager checkpoint under ``spark.checkpoint.dir`` (shared storage).

    Used where a provider-level aggregate of the claims feeds two branches (a
    peer baseline and the rows): Catalyst prunes the branches differently, so
    without it the claims scan and joins would run twice.  Also cuts lineage.
    """
    return _materialize(df)


def _materialize(df: DataFrame) -> DataFrame:
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows that a task of an explicit shuffle is meant to hold.
TASK_ROWS = 500_000


def tasks_for(df: DataFrame, rows: int) -> int:
    """Tasks for a shuffle of ``rows`` rows: the session's, or more where those would grow with the table."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def top_k(df: DataFrame, order_by: Sequence[Column | str], k: int, rank_col: str | None = None) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: each task keeps k rows) plus optional rank.

    The rank is computed on the <= k survivors only, so the window is bounded.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    order = _sort_cols(order_by)
    top = df.orderBy(*order).limit(k)
    if rank_col:
        top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return top


def top_k_per_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column | str], k: int,
                    rank_col: str = "rn") -> DataFrame:
    """Top-k rows of every group.

    ``row_number() <= k`` is planned with a group limit on both sides of the shuffle: a
    task sends at most ``k`` rows of a group, however many it has.
    """
    w = Window.partitionBy(*group_by).orderBy(*_sort_cols(order_by))
    return (df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
              .withColumn(rank_col, F.col(rank_col).cast("long")))


def latest_per(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_desc DESC) = 1``.

    Written as ``max_by(struct(row), struct(order))``: a hash aggregate whose
    partial (map-side) step keeps one candidate per key per task, so a key that
    holds a third of all rows is never gathered into one group.  NULL order
    values sort lowest, as ``DESC NULLS LAST`` does.  End ``order_desc`` with a
    unique column so ties are deterministic.
    """
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    key = F.struct(*[F.col(c) for c in order_desc])
    agg = df.groupBy(*keys).agg(F.max_by(row, key).alias("__lp"))
    return agg.select(*[F.col("__lp")[c].alias(c) for c in cols])


def _positions(df: DataFrame, group_by: Sequence[str], value: str) -> tuple[DataFrame, Column]:
    """Distinct values with their last 1-based position ``__q_hi``, count ``__q_c`` and the group's ``__q_n``.

    Values are counted before they are ordered, so a value that most rows share is one
    row.  Also returns a test: does position ``p`` fall on this value?
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(*group_by, value)
                .agg(F.count(F.lit(1)).alias("__q_c")))
    j = running_sums(counts, group_by, [F.col(value)], ["__q_c"], prefix="__q_hi", total_prefix="__q_n")
    j = j.withColumnsRenamed({"__q_hi__q_c": "__q_hi", "__q_n__q_c": "__q_n"})
    return j, lambda p: (F.col("__q_hi") - F.col("__q_c") < p) & (p <= F.col("__q_hi"))


def quantile_disc(df: DataFrame, group_by: Sequence[str], value: str, q: float | Sequence[float],
                  out: str | Sequence[str]) -> DataFrame:
    """Exact discrete quantile(s) per group: the value at 1-based position ceil(q * n).

    Same definition as DuckDB ``quantile_disc`` / SQL ``PERCENTILE_DISC``.  Distinct values
    are ordered by many tasks; only those at the wanted positions reach the final aggregate.
    """
    qs = [q] if isinstance(q, (int, float)) else list(q)
    outs = [out] if isinstance(out, str) else list(out)
    if any(not 0 <= x <= 1 for x in qs):
        raise ValueError("q must be in [0, 1]")
    j, at = _positions(df, group_by, value)
    pos = [F.greatest(F.ceil(F.lit(float(x)) * F.col("__q_n")), F.lit(1)) for x in qs]
    keep = F.lit(False)
    for p in pos:
        keep = keep | at(p)
    aggs = [F.max(F.when(at(p), F.col(value))).alias(o) for p, o in zip(pos, outs)]
    sel = j.where(keep)
    return sel.groupBy(*group_by).agg(*aggs) if group_by else sel.agg(*aggs)


def quantile_cont(df: DataFrame, group_by: Sequence[str], value: str, qs: Sequence[float],
                  names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per group (pandas ``quantile`` /
    ``percentile`` / DuckDB ``quantile_cont``), one column per q.

    position h = (n - 1) * q; result = v[floor h] + (h - floor h) * (v[ceil h] - v[floor h]).
    Only the <= 2 distinct values per (group, q) at those positions reach the last aggregate.
    """
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    if any(not 0 <= q <= 1 for q in qs):
        raise ValueError("quantiles must be in [0, 1]")
    j, at = _positions(df, group_by, value)
    outs, keep = [], F.lit(False)
    for q, name in zip(qs, names):
        h = (F.col("__q_n") - 1).cast("double") * F.lit(float(q))
        lo, hi = F.floor(h) + 1, F.ceil(h) + 1
        v_lo = F.max(F.when(at(lo), F.col(value)))
        v_hi = F.max(F.when(at(hi), F.col(value)))
        outs.append((v_lo + F.max(h - F.floor(h)) * (v_hi - v_lo)).alias(name))
        keep = keep | at(lo) | at(hi)
    sel = j.where(keep)
    return sel.groupBy(*group_by).agg(*outs) if group_by else sel.agg(*outs)


def running_sums(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str],
                 cols: Sequence[str], prefix: str = "cum_", num_partitions: int | None = None,
                 total_prefix: str | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` per group in ``order_by`` order, distributed.

    ``total_prefix`` also attaches each group's grand totals from the slice table.
    Same slicing as ``row_number_by``: range partitions give contiguous slices,
    a window sums inside each (partition, group) slice -- bounded by the slice
    size -- and a table of slice totals (<= partitions + groups rows)
    supplies each slice's offset.  ``order_by`` must be a total order.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in partition_by]
    order = _sort_cols(order_by)
    ranged = _materialize(df.repartitionByRange(n, *keys, *order).withColumn(_PID, F.spark_partition_id()))
    w_local = Window.partitionBy(_PID, *partition_by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(w_local).alias(f"__loc_{c}") for c in cols])
    tot = ranged.groupBy(_PID, *partition_by).agg(*[F.sum(c).alias(f"__tot_{c}") for c in cols])
    w_off = Window.partitionBy(*partition_by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*partition_by)
    extra = [F.sum(f"__tot_{c}").over(w_all).alias(f"{total_prefix}{c}") for c in cols] if total_prefix else []
    off = tot.select(_PID, *partition_by,
                     *[F.coalesce(F.sum(f"__tot_{c}").over(w_off), F.lit(0)).alias(f"__off_{c}") for c in cols], *extra)
    j = _join_slices(local, off, partition_by)
    totals = [F.col(f"{total_prefix}{c}") for c in cols] if total_prefix else []
    return j.select(*df.columns, *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"{prefix}{c}") for c in cols],
                    *totals)
