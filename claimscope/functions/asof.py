"""Point-in-time (as-of) join of two time series, however many rows one key has.

Both sides are put together and hashed by (key, time slice): a key that holds a third of all rows spans many
slices, and whole rows move once.  The last right row before each left row is a window over (slice, key).  What a slice
takes over from the ones before it is a right row at its beginning, from a table of one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import materialize

_T, _SIDE, _LEFT, _RIGHT, _PID = "__ao_t", "__ao_side", "__ao_left", "__ao_right", "__ao_pid"
#: Slices of the time axis when none are asked for.
SLICES = 16


def as_of_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
               take: Sequence[str], num_slices: int = SLICES) -> DataFrame:
    """Every row of ``left`` with the columns ``take`` of the latest row of ``right`` that has the
    same ``by`` and a time not after its own; NULL when there is none.

    The two time columns have one type.  NULL keys and times match nothing, as in a join.  Of right rows
    of one key and time the one with the largest ``take`` values (in that order) counts.  ``left`` is read
    three times, and whole rows of it only once: store it first where it is costly to make.  With one slice it is
    read once, and a key's rows are one group, which must be bounded.
    """
    by, take = list(by), list(take)
    clash = sorted(set(take) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    if left.schema[left_time].dataType != right.schema[right_time].dataType:
        raise ValueError(f"{left_time} and {right_time} have different types")
    known = right.where(F.col(right_time).isNotNull())
    for c in by:
        known = known.where(F.col(c).isNotNull())
    # one row per key and time, combined before the shuffle
    known = known.groupBy(*by, F.col(right_time).alias(_T)).agg(F.max(F.struct(*take)).alias(_RIGHT))
    kind = left.schema[left_time].dataType
    own = [c for c in left.columns if c not in by and c != left_time]
    rows = left.select(*by, F.col(left_time).alias(_T), *([F.struct(*own).alias(_LEFT)] if own else []))
    order = [F.col(_T).asc_nulls_first(), _SIDE]
    if num_slices == 1:
        u = rows.withColumn(_SIDE, F.lit(2)).unionByName(known.withColumn(_SIDE, F.lit(1)), allowMissingColumns=True)
        before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    else:
        # one row of at most num_slices - 1 times: where the slices begin
        at = [i / num_slices for i in range(1, num_slices)]
        cuts = left.agg(F.percentile_approx(left_time, at).alias("__c")).first()[0] or []
        pid = F.lit(0)
        for c in sorted(set(cuts)):
            pid = pid + F.when(F.col(_T) > F.lit(c).cast(kind), 1).otherwise(0)
        rows, known = rows.withColumn(_PID, pid), known.withColumn(_PID, pid)
        # per key and slice with rows of either side: its last right row, and from it what the slice takes over
        ends = known.groupBy(_PID, *by).agg(F.max_by(_RIGHT, _T).alias("__ao_last")).unionByName(
            rows.select(_PID, *by).distinct(), allowMissingColumns=True)
        ends = materialize(ends.groupBy(_PID, *by).agg(F.first("__ao_last", ignorenulls=True).alias("__ao_last")))
        earlier = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
        opening = ends.select(_PID, *by, F.last("__ao_last", ignorenulls=True).over(earlier).alias(_RIGHT)).where(F.col(_RIGHT).isNotNull())
        u = (rows.withColumn(_SIDE, F.lit(2)).unionByName(known.withColumn(_SIDE, F.lit(1)), allowMissingColumns=True)
                 .unionByName(opening.withColumn(_SIDE, F.lit(0)), allowMissingColumns=True))
        before = Window.partitionBy(_PID, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(F.col(_T).isNotNull(), F.last(_RIGHT, ignorenulls=True).over(before))
    j = u.withColumn("__ao_found", found).where(F.col(_SIDE) == 2)
    back = {left_time: F.col(_T), **{c: F.col(c) for c in by}, **{c: F.col(f"{_LEFT}.`{c}`") for c in own}}
    # a key may also be the time column
    return j.select(*[back[c].alias(c) for c in left.columns], *[F.col("__ao_found")[c].alias(c) for c in take])
