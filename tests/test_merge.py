"""MERGE and slice replacement on storage: untouched files, repeatability, errors."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.sources import io, merge

SCHEMA = T.StructType([T.StructField("entity_id", T.StringType()), T.StructField("provider_id", T.StringType()),
                       T.StructField("feature_timestamp", T.TimestampType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                       T.StructField("feature_date", T.DateType())])
COLS = "entity_id string, provider_id string, feature_timestamp timestamp, a long, b long"
KEYS = ["entity_id", "feature_timestamp"]


def at(day, hour=23):
    return dt.datetime(2024, 1, day, hour)


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(folder, n)
                out[os.path.relpath(p, path)] = os.stat(p).st_mtime_ns
    return out


def table(spark, path):
    return sorted(tuple(r) for r in merge.stored(spark, path, SCHEMA).select("entity_id", "feature_timestamp", "a", "b").collect())


@pytest.fixture
def path(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="claimscope-merge-"), "t")
    rows = [(f"e{i}", f"e{i}", at(d), i, d) for i in range(6) for d in (1, 2, 3, 4)]
    io.write_partitioned(spark.createDataFrame(rows, COLS), p)
    return p


def test_merge_touches_its_dates_only_and_repeats(spark, path):
    before = files(path)
    src = spark.createDataFrame([("e1", "e1", at(2), 100, 200), ("new", "new", at(2), 7, 8), ("new", "new", at(9, 5), 1, 2)], COLS)
    assert merge.merge_dates(path, src, SCHEMA, KEYS, ["b"]) == [dt.date(2024, 1, 2), dt.date(2024, 1, 9)]
    after = files(path)
    kept = {f for f in before if "2024-01-02" not in f}
    assert all(after[f] == before[f] for f in kept) and {f for f in after if f not in kept and "01-02" not in f and "01-09" not in f} == set()
    want = [(f"e{i}", at(d), i, 200 if (i, d) == (1, 2) else d) for i in range(6) for d in (1, 2, 3, 4)]
    want += [("new", at(2), 7, 8), ("new", at(9, 5), 1, 2)]
    assert table(spark, path) == sorted(want)
    merge.merge_dates(path, src, SCHEMA, KEYS, ["b"])
    assert table(spark, path) == sorted(want)


def test_merge_prunes_partitions_by_the_sources_dates(spark, path):
    target = merge.stored(spark, path, SCHEMA).where(F.col("feature_date").isin([dt.date(2024, 1, 2)]))
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "feature_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0].split("feature_date=")[1][:10] for r in target.select(F.input_file_name()).distinct().collect()} == {"2024-01-02"}


def test_merge_errors_leave_the_table(spark, path):
    before = files(path)
    twice = spark.createDataFrame([("e1", "e1", at(2), 1, 1)] * 2, COLS)
    with pytest.raises(ValueError, match="more than once"):
        merge.merge_dates(path, twice, SCHEMA, KEYS, ["b"])
    with pytest.raises(ValueError, match="without"):
        merge.merge_dates(path, spark.createDataFrame([("e1", "e1", None, 1, 1)], COLS), SCHEMA, KEYS, ["b"])
    with pytest.raises(ValueError, match="key"):
        merge.merge_dates(path, twice, SCHEMA, ["entity_id"], ["b"])
    assert merge.merge_dates(path, twice.limit(0), SCHEMA, KEYS, ["b"]) == []
    assert files(path) == before


def test_replace_slices_leaves_other_slices(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="claimscope-slices-"), "t")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("extra", T.StringType()), T.StructField("run", T.StringType())])
    spark.createDataFrame([(i, "x", f"r/{i % 3}") for i in range(30)], schema).write.partitionBy("run").parquet(path)
    before = files(path)
    new = spark.createDataFrame([(100, "r/1"), (101, "r/1"), (5, "0009")], "id long, run string")
    for _ in range(2):
        merge.replace_slices(path, new, schema, ["run"])
    got = sorted((r.run, r.id, r.extra) for r in merge.stored(spark, path, schema).collect())
    assert got == sorted([(f"r/{i % 3}", i, "x") for i in range(30) if i % 3 != 1] + [("r/1", 100, None), ("r/1", 101, None), ("0009", 5, None)])
    after = files(path)
    assert all(after.get(f) == t for f, t in before.items() if "r%2F1" not in f)
    with pytest.raises(ValueError, match="values"):
        merge.replace_slices(path, spark.createDataFrame([(1, None)], "id long, run string"), schema, ["run"])
