"""Incremental short-term provider snapshots with Structured Streaming.

The batch job (F7) recomputes one snapshot date per run.  As a stream, every
claim updates the sums of its provider's day; a day is emitted once the watermark
passes its end, i.e. when no claim of that day is still expected, and with it the
7-day window that it ends.  All providers of one day are finalised by the same
watermark advance, so each micro-batch holds complete days: ``foreachBatch`` stores
them with the days before that their windows reach back to, adds them up to
snapshots, computes the per-date peer baseline (for the 7-day O/E ratio) and
writes the rows to the (idempotent) sink.

State is bounded by (open days x active providers) plus what one run reads; the watermark evicts it.  A claim is in
it once, not once for each of the windows it is in.  Files must not arrive all at once: ``arrivals`` cuts a backlog into
spans of days, each taken up by a run of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..functions.ranking import materialize

MEASURES = ["claim_count_7d", "high_acuity_pct_7d", "referral_rate_7d", "avg_paid_per_claim_7d",
            "avg_member_provider_distance_7d", "high_acuity_oe_ratio_7d"]

CLAIM_COLS = ["provider_id", "service_date", "is_high_acuity_em", "is_referral", "total_paid_amount", "member_provider_distance"]

SUMS = ["claim_count_7d", "__ha", "__ref", "__paid", "__npaid", "__dist", "__ndist"]


def arrivals(claims: DataFrame, most: int) -> list[Column]:
    """Conditions on ``claims`` that cut them into spans of days in their order, of about ``most`` rows each.

    A span ends with the day that fills it, so a day is never cut.  Rows without a day come with the first.
    """
    if most < 1:
        raise ValueError("most must be >= 1")
    # one row per day
    days = claims.groupBy("service_date").agg(F.count(F.lit(1)).alias("n")).orderBy("service_date").collect()
    ends, n = [], 0
    for d in days:
        n += d["n"]
        if n >= most and d["service_date"] is not None:
            ends.append(d["service_date"])
            n = 0
    if n and ends:
        ends.append(days[-1]["service_date"])  # nulls come first, so this is a day
    c = F.col("service_date")
    if len(ends) < 2:
        return [F.lit(True)]
    spans = [c.isNull() | (c <= F.lit(ends[0]))]
    return spans + [(c > F.lit(a)) & (c <= F.lit(b)) for a, b in zip(ends, ends[1:])]


def _sums() -> list:
    return [F.count(F.lit(1)).alias("claim_count_7d"),
            F.sum("is_high_acuity_em").cast("long").alias("__ha"),
            F.sum("is_referral").cast("long").alias("__ref"),
            F.sum("total_paid_amount").alias("__paid"), F.count("total_paid_amount").alias("__npaid"),
            F.sum("member_provider_distance").alias("__dist"),
            F.count("member_provider_distance").alias("__ndist")]


def day_sums(claims: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Per (service_date, provider) sums (streaming-safe: only stateful aggregation, finalised by the watermark)."""
    ts = F.col("service_date").cast("timestamp")
    w = F.window(F.col("service_ts"), "1 day")
    g = (claims.select("provider_id", ts.alias("service_ts"), "is_high_acuity_em", "is_referral",
                       "total_paid_amount", "member_provider_distance")
               .withWatermark("service_ts", watermark)
               .groupBy(w.alias("w"), "provider_id").agg(*_sums()))
    return g.select(F.to_date(F.col("w.start")).alias("service_date"), "provider_id", *SUMS)


def trailing_sums(daily: DataFrame, days: int = 7) -> DataFrame:
    """Per (snapshot_date, provider) sums over the trailing ``days`` of sums per (service_date, provider).

    The days move once, to the task of their provider, and are added up there.  A provider's group has one row per day.
    """
    if days < 1:
        raise ValueError("days must be >= 1")
    later = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("__k")
    return (daily.repartition("provider_id").select("*", later)
                 .groupBy(F.date_add("service_date", F.col("__k")).alias("snapshot_date"), "provider_id")
                 .agg(*[F.sum(c).alias(c) for c in SUMS]))


def finalize_measures(sums: DataFrame) -> DataFrame:
    """Rates and the per-date 7-day O/E ratio from finalised window sums (batch)."""
    r = sums.select(
        "snapshot_date", "provider_id", "claim_count_7d",
        (F.col("__ha") / F.col("claim_count_7d")).alias("high_acuity_pct_7d"),
        (F.col("__ref") / F.col("claim_count_7d")).alias("referral_rate_7d"),
        (F.col("__paid").cast("double") / F.col("__npaid")).alias("avg_paid_per_claim_7d"),
        (F.col("__dist") / F.col("__ndist")).alias("avg_member_provider_distance_7d"))
    # one baseline row per snapshot date in the batch: bounded by the dates, broadcast
    base = r.groupBy("snapshot_date").agg(F.avg("high_acuity_pct_7d").alias("__e7"))
    return r.join(F.broadcast(base), "snapshot_date").select(
        "snapshot_date", "provider_id", *MEASURES[:-1],
        safe_div("high_acuity_pct_7d", "__e7").alias("high_acuity_oe_ratio_7d"))


def complete(claims: DataFrame, snapshots: DataFrame, days: int = 7) -> DataFrame:
    """Every daily snapshot: those the stream finished, and all others from the claims.

    A date is made anew when the stream has not finished it (the watermark never passes
    the last days) or when the claims of its window are more than the stream counted (claims
    that came after the watermark).  So the result does not depend on the order of the files.
    """
    later = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("__k")
    per_day = claims.groupBy("service_date").agg(F.count(F.lit(1)).alias("__n"))
    due = (per_day.select("service_date", "__n", later).select(F.date_add("service_date", F.col("__k")).alias("snapshot_date"), "__n")
                  .groupBy("snapshot_date").agg(F.sum("__n").alias("__due")))
    seen = snapshots.groupBy("snapshot_date").agg(F.sum("claim_count_7d").alias("__seen"))
    # one row per date: broadcast, so that neither claims nor snapshots move to meet it
    redo = F.broadcast(materialize(due.join(seen, "snapshot_date", "left").where(F.coalesce("__seen", F.lit(0)) != F.col("__due"))
                                      .select("snapshot_date")))
    window = F.explode(F.sequence(F.date_sub("snapshot_date", days - 1), "snapshot_date")).alias("service_date")
    of_redo = F.broadcast(redo.select(window).distinct())
    daily = claims.join(of_redo, "service_date", "left_semi").groupBy("service_date", "provider_id").agg(*_sums())
    sums = trailing_sums(daily, days).join(redo, "snapshot_date", "left_semi")
    return snapshots.join(redo, "snapshot_date", "left_anti").unionByName(finalize_measures(sums).select(*snapshots.columns))


def run_short_term_stream(spark: SparkSession, source_path: str, schema, sink_path: str, checkpoint_path: str,
                          days: int = 7, watermark: str = "2 days", available_now: bool = True):
    """Start the stream: parquet claims folder -> finalised daily 7-day snapshots
    written under ``sink_path`` (``batch=<id>/snapshot_month=<m>``).  With
    ``checkpoint_path`` on shared storage a restarted driver resumes where it
    stopped, and a replayed batch overwrites its own folders (idempotent sink).

    The finished days lie beside the snapshots, in ``<sink_path>-days/batch=<id>``: those of the batch and, from the
    batch before, those that its windows reach back to.  Dates without any claim come with the next finished day."""
    if days < 1:
        raise ValueError("days must be >= 1")
    src = spark.readStream.schema(schema).parquet(source_path)
    finished = f"{sink_path.rstrip('/')}-days"
    day = F.col("service_date")

    def sink(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch, overwritten on replay: a batch re-run after a
        # failure replaces its own output instead of appending duplicates.  Month
        # partitions keep a multi-year backfill from exploding into daily folders.
        newest = F.max(day)
        before = None
        if batch_id > 0:
            known = batch.sparkSession.read.schema(batch.schema).parquet(f"{finished}/batch={batch_id - 1}")
            before = known.agg(newest).first()[0]
        mine = batch if before is None else batch.unionByName(known.where(day > F.date_sub(F.lit(before), days - 1)))
        # stored before anything reads it twice: each reader of the batch goes through the state
        mine.write.mode("overwrite").parquet(f"{finished}/batch={batch_id}")
        mine = spark.read.schema(batch.schema).parquet(f"{finished}/batch={batch_id}")
        last = F.lit(mine.agg(newest).first()[0]).cast("date")
        at = F.col("snapshot_date")
        done = trailing_sums(mine, days).where((at <= last) & (F.lit(True) if before is None else at > F.lit(before)))
        out = finalize_measures(done).withColumn("snapshot_month", F.trunc("snapshot_date", "month"))
        out.write.mode("overwrite").partitionBy("snapshot_month").parquet(f"{sink_path}/batch={batch_id}")

    w = (day_sums(src, watermark).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint_path).foreachBatch(sink))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
