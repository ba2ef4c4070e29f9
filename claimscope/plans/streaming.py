"""Registered streaming query: daily 7-day snapshots maintained by a stream."""

from __future__ import annotations

import uuid

from ..functions.columns import round_doubles
from ..sources import adapters as ad
from ..sources import io
from ..streaming import short_term as st
from .catalog import ctes, register

WATERMARK_DAYS = 2
# Rows that arrive together: with the open windows they are what the state of one run holds.
CLAIMS_PER_ARRIVAL = 2_000_000
STREAM_SQL = ctes(claims=ad.CLAIMS_SQL) + """,
x AS (SELECT CAST(c.service_date + INTERVAL (k.k) DAY AS DATE) AS snapshot_date, c.*
      FROM claims c CROSS JOIN range(0, 7) k(k)),
s AS (SELECT snapshot_date, provider_id, COUNT(*) AS claim_count_7d,
        SUM(is_high_acuity_em) / COUNT(*) AS high_acuity_pct_7d, SUM(is_referral) / COUNT(*) AS referral_rate_7d,
        CAST(SUM(total_paid_amount) AS DOUBLE) / COUNT(total_paid_amount) AS avg_paid_per_claim_7d,
        SUM(member_provider_distance) / COUNT(member_provider_distance) AS avg_member_provider_distance_7d
      FROM x GROUP BY 1, 2),
b AS (SELECT snapshot_date, AVG(high_acuity_pct_7d) AS e7 FROM s GROUP BY 1)
SELECT s.snapshot_date, provider_id, claim_count_7d, ROUND(high_acuity_pct_7d, 6) AS high_acuity_pct_7d,
  ROUND(referral_rate_7d, 6) AS referral_rate_7d, ROUND(avg_paid_per_claim_7d, 6) AS avg_paid_per_claim_7d,
  ROUND(avg_member_provider_distance_7d, 6) AS avg_member_provider_distance_7d,
  ROUND(CASE WHEN b.e7 = 0 THEN NULL ELSE high_acuity_pct_7d / b.e7 END, 6) AS high_acuity_oe_ratio_7d
FROM s JOIN b USING (snapshot_date)
"""


@register("f7_short_term_stream", STREAM_SQL)
def q_stream(spark, sf_dir):
    """Claims arrive as files, a span of days at a time, and the stream takes up each arrival where it stopped; the finished
    daily snapshots are read back from the sink, and open dates are completed from the claims."""
    base = io.shared_path(spark, f"claimscope/short-term-stream-{uuid.uuid4().hex[:12]}")
    inbox = f"{base}/inbox"
    # ordered by day, so that an arrival reads only the pages of its days; not by range, whose bounds need all joins run twice
    ad.claims(spark, sf_dir).select(*st.CLAIM_COLS).repartition("service_date").sortWithinPartitions("service_date").write.parquet(inbox)
    claims = spark.read.parquet(inbox)
    for span in st.arrivals(claims, CLAIMS_PER_ARRIVAL):
        claims.where(span).write.mode("append").parquet(f"{base}/claims")
        st.run_short_term_stream(spark, f"{base}/claims", claims.schema, f"{base}/snapshots", f"{base}/checkpoint",
                                 watermark=f"{WATERMARK_DAYS} days").awaitTermination()
    out = spark.read.parquet(f"{base}/snapshots").select("snapshot_date", "provider_id", *st.MEASURES)
    return round_doubles(st.complete(claims, out), 6)
