"""Registered source / sink queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_doubles
from ..functions.ranking import materialize
from ..operators import features as fe
from ..operators import investigation as iv
from ..operators import scoring as sc
from ..sources import adapters as ad
from ..sources import io, merge
from ..sources import schemas as sch
from . import features as pf
from . import monitoring as pm
from . import scoring as ps
from .catalog import ctes, register

CUTOFF = "2001-07-01 00:00:00"
OLD_DQ_COLS = ["monitoring_timestamp", "model_name", "total_rows", "unique_providers", "monitoring_status"]
DQ_COLS = [f.name for f in sch.DATA_QUALITY.fields]


@register("s1_read_table", "SELECT * FROM lineitem")
def q_s1(spark, sf_dir):
    return sch.read_table(spark, f"{sf_dir}/lineitem.parquet", sch.LINEITEM)


def _old_new(spark, sf_dir):
    h = pm.dq_history(spark, sf_dir)
    old = h.where(F.col("monitoring_timestamp") < F.lit(CUTOFF).cast("timestamp")).select(*OLD_DQ_COLS)
    new = h.where(F.col("monitoring_timestamp") >= F.lit(CUTOFF).cast("timestamp"))
    return old, new


ALIGN_SQL = pm.DQ_HIST_SQL + "SELECT " + ", ".join(
    c if c in OLD_DQ_COLS else f"CAST(NULL AS {'VARCHAR' if c == 'dataset_name' else 'BIGINT'}) AS {c}" for c in DQ_COLS) + \
    f" FROM dqh WHERE monitoring_timestamp < TIMESTAMP '{CUTOFF}' UNION ALL SELECT " + ", ".join(DQ_COLS) + \
    f" FROM dqh WHERE monitoring_timestamp >= TIMESTAMP '{CUTOFF}'"


@register("s2_align_schema", ALIGN_SQL)
def q_s2(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return sch.align_schema(old, sch.DATA_QUALITY).unionByName(sch.align_schema(new, sch.DATA_QUALITY))


@register("s3_append_history", ALIGN_SQL)
def q_s3(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return io.append_history(old, new).select(*DQ_COLS)


# Re-run of the latest scoring run with scores floored to one decimal replaces its slice
def _rerun_slice(spark, sf_dir):
    raw = ps.raw_output(spark, sf_dir)
    run = iv.latest_scored_run(ad.raw_predictions(spark, sf_dir))
    r = raw.join(F.broadcast(run.select("run_id", "model_version")), ["run_id", "model_version"], "left_semi")
    r = r.withColumn("prediction", (F.floor(F.col("prediction").cast("double") * 10) / 10).cast("string"))
    return sc.curate_predictions(r)


@register("s4_replace_slice", ctes(**{"preds": ad.RAW_PREDICTIONS_SQL, "cur": ps.CURATED_SQL}) + """,
lr AS (SELECT model_name, model_version, run_id FROM preds GROUP BY 1, 2, 3
       ORDER BY MAX(created_at) DESC, model_name DESC, run_id DESC LIMIT 1),
np AS (SELECT p.* EXCLUDE (fraud_score), FLOOR(p.fraud_score * 10) / 10 AS fraud_score
       FROM preds p JOIN lr USING (run_id, model_version)),
nw AS (""" + ps.CURATED_SQL.replace("FROM preds", "FROM np") + """)
SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM nw WHERE nw.run_id = cur.run_id AND nw.model_version = cur.model_version)
UNION ALL SELECT * FROM nw""")
def q_s4(spark, sf_dir):
    return io.replace_slice(ps.curated(spark, sf_dir), _rerun_slice(spark, sf_dir), ["run_id", "model_version"])


# MERGE short-term snapshots into the long-term history (7-day columns only)
S5_DATES = [dt.date(2001, 7, 31), dt.date(2001, 8, 31), dt.date(2001, 9, 30)]
S5_SNAPS = [dt.date(2001, 9, 30), dt.date(2001, 10, 7)]


def _merge_sql():
    parts = {}
    for i, snap in enumerate(S5_SNAPS):
        parts[f"lt{i}"] = pf.LATEST_SQL.format(as_of=pf._d(snap))
        parts[f"st{i}"] = pf.short_sql(snap)
    src = " UNION ALL ".join(f"({pf.f7_select(snap, f'lt{i}', f'st{i}')})" for i, snap in enumerate(S5_SNAPS))
    upd = set(fe.SHORT_TERM_FEATURES)
    sel = []
    for c in pf.HIST_COLS:
        if c in ("entity_id", "feature_timestamp"):
            sel.append(f"COALESCE(t.{c}, s.{c}) AS {c}")
        elif c in upd:
            sel.append(f"CASE WHEN s.entity_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.entity_id IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    body = ("SELECT " + ", ".join(sel) + " FROM hist t FULL OUTER JOIN src s ON t.entity_id = s.entity_id "
            "AND t.feature_timestamp = s.feature_timestamp")
    return ctes(**pf.hist_ctes(S5_DATES), **parts, src=src, m=body) + \
        "SELECT " + pf.rounded_select(pf.HIST_COLS, 6, pf.HIST_DOUBLES) + " FROM m"


@register("s5_upsert", _merge_sql())
def q_s5(spark, sf_dir):
    claims = ad.claims(spark, sf_dir)
    target = fe.snapshot_backfill(claims, S5_DATES)
    src = None
    for snap in S5_SNAPS:
        x = fe.short_term_snapshot(claims, target, snap)
        src = x if src is None else src.unionByName(x)
    out = io.upsert(target, src, ["entity_id", "feature_timestamp"], fe.SHORT_TERM_FEATURES)
    return round_doubles(out, 6)


# Date-partitioned, provider-clustered write; every date is read back
@register("s6_write_partitioned", ctes(**pf.hist_ctes(pf.BACKFILL_DATES)) + "SELECT "
          + pf.rounded_select(pf.HIST_COLS, 6, pf.HIST_DOUBLES)
          + ", CAST(feature_timestamp AS DATE) AS feature_date FROM hist")
def q_s6(spark, sf_dir):
    hist = fe.snapshot_backfill(ad.claims(spark, sf_dir), pf.BACKFILL_DATES)
    path = io.shared_path(spark, "claimscope/provider_feature_history")
    io.write_partitioned(hist, path)
    back = spark.read.parquet(path)
    return round_doubles(back.select(*pf.HIST_COLS, "feature_date"), 6)


# S5 / S4 on storage: only the partitions concerned are read and written
HISTORY_SCHEMA = T.StructType([T.StructField("entity_id", T.StringType()), T.StructField("provider_id", T.StringType()),
                               T.StructField("feature_timestamp", T.TimestampType())]
                              + [T.StructField(c, T.LongType() if c == "claim_count_7d" else T.DoubleType())
                                 for c in [*fe.LONG_TERM_FEATURES, *fe.SHORT_TERM_FEATURES]]
                              + [T.StructField("feature_date", T.DateType())])
# the merge brings the short-term rows of every month's last day (matched) and 15th (inserted)
MERGE_DAYS_SQL = "day = last_day(day) OR date_part('day', day) = 15"


def _merged_all_sql():
    upd = set(fe.SHORT_TERM_FEATURES)
    sel = ["COALESCE(t.{0}, s.{0}) AS {0}".format(c) if c in ("entity_id", "feature_timestamp") else
           f"CASE WHEN {'s.entity_id IS NOT NULL' if c in upd else 't.entity_id IS NULL'} THEN s.{c} ELSE t.{c} END AS {c}" for c in pf.HIST_COLS]
    parts = {**pf.SHORT_ALL_CTES, "src": f"SELECT * FROM (SELECT *, CAST(feature_timestamp AS DATE) AS day FROM st) WHERE {MERGE_DAYS_SQL}",
             "m": "SELECT " + ", ".join(sel) + " FROM hist t FULL OUTER JOIN src s ON t.entity_id = s.entity_id AND t.feature_timestamp = s.feature_timestamp"}
    return ctes(**parts) + "SELECT " + pf.rounded_select(pf.HIST_COLS, 6, pf.HIST_DOUBLES) + ", CAST(feature_timestamp AS DATE) AS feature_date FROM m"


@register("s5_merge_dates", _merged_all_sql())
def q_s5_dates(spark, sf_dir):
    """The history of all month ends lies on storage; short-term snapshots of many days are merged into it, twice."""
    daily = pf.daily_claims(spark, sf_dir)
    hist = materialize(pf.full_history(spark, sf_dir, daily))
    path = io.shared_path(spark, "claimscope/merged_history")
    io.write_partitioned(hist, path)
    src = materialize(pf.short_all(daily, hist, lambda day: (day == F.last_day(day)) | (F.dayofmonth(day) == 15)))
    for _ in range(2):  # a repeated MERGE changes nothing
        merge.merge_dates(path, src, HISTORY_SCHEMA, ["entity_id", "feature_timestamp"], fe.SHORT_TERM_FEATURES)
    return round_doubles(merge.stored(spark, path, HISTORY_SCHEMA), 6)


@register("s4_replace_slices", ctes(**{"preds": ad.RAW_PREDICTIONS_SQL, "cur": ps.CURATED_SQL}) + """,
lr AS (SELECT model_name, model_version, run_id FROM preds GROUP BY 1, 2, 3
       ORDER BY MAX(created_at) DESC, model_name DESC, run_id DESC LIMIT 1),
np AS (SELECT p.* EXCLUDE (fraud_score), FLOOR(p.fraud_score * 10) / 10 AS fraud_score
       FROM preds p JOIN lr USING (run_id, model_version)),
nw AS (""" + ps.CURATED_SQL.replace("FROM preds", "FROM np") + """)
SELECT * FROM cur WHERE (run_id, model_version) NOT IN (SELECT (run_id, model_version) FROM nw) UNION ALL SELECT * FROM nw""")
def q_s4_storage(spark, sf_dir):
    """All curated predictions on storage by run; the latest run is scored again and replaces its own slice."""
    cur = materialize(ps.curated(spark, sf_dir))
    path = io.shared_path(spark, "claimscope/predictions")
    cur.write.partitionBy("run_id", "model_version").parquet(path)
    merge.replace_slices(path, _rerun_slice(spark, sf_dir), cur.schema, ["run_id", "model_version"])
    return merge.stored(spark, path, cur.schema).select(*cur.columns)
