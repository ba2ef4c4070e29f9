import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimscope.functions.ranking import (latest_per, quantile_cont, quantile_disc, row_number_by, running_sums,
                                          top_k_per_group)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    # one hot group holding most rows, ties in the score
    rows = [("hot" if i % 10 else f"g{i % 7}", f"p{i:05d}", float(rnd.randint(0, 50))) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, id string, s double")


def test_row_number_by_equals_window(spark, skewed):
    got = row_number_by(skewed, ["g"], [F.col("s").desc(), F.col("id")], "rn", num_partitions=7)
    w = Window.partitionBy("g").orderBy(F.col("s").desc(), F.col("id"))
    exp = skewed.withColumn("rn", F.row_number().over(w).cast("long"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_row_number_by_global(spark, skewed):
    got = row_number_by(skewed.withColumn("k", F.lit(1)), ["k"], [F.col("s"), F.col("id")], "rn", num_partitions=5)
    rn = [r.rn for r in got.orderBy("s", "id").collect()]
    assert rn == list(range(1, 3001))


def test_running_sums_equal_window(spark, skewed):
    got = running_sums(skewed.withColumn("one", F.lit(1)), ["g"], [F.col("s").desc(), F.col("id")], ["s", "one"],
                       num_partitions=6)
    w = Window.partitionBy("g").orderBy(F.col("s").desc(), F.col("id")).rowsBetween(Window.unboundedPreceding, 0)
    exp = skewed.withColumn("one", F.lit(1)).select("*", F.sum("s").over(w).alias("cum_s"),
                                                     F.sum("one").over(w).alias("cum_one"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_quantiles_match_numpy(spark, skewed):
    pdf = skewed.toPandas()
    qs = [0.0, 0.25, 0.5, 0.9, 0.95, 1.0]
    cont = {r.g: r for r in quantile_cont(skewed, ["g"], "s", qs, [f"q{i}" for i in range(len(qs))]).collect()}
    disc = {r.g: r for r in quantile_disc(skewed, ["g"], "s", qs, [f"q{i}" for i in range(len(qs))]).collect()}
    for g, sub in pdf.groupby("g"):
        v = np.sort(sub["s"].to_numpy())
        for i, q in enumerate(qs):
            assert cont[g][f"q{i}"] == pytest.approx(float(np.quantile(v, q)), abs=1e-12)
            assert disc[g][f"q{i}"] == v[max(1, math.ceil(q * len(v))) - 1]


def test_top_k_per_group_and_latest(spark, skewed):
    top = top_k_per_group(skewed, ["g"], [F.col("s").desc(), F.col("id")], 3, "rn").collect()
    pdf = skewed.toPandas().sort_values(["g", "s", "id"], ascending=[True, False, True])
    exp = pdf.groupby("g").head(3)
    assert sorted((r.g, r.id) for r in top) == sorted(zip(exp.g, exp.id))
    lat = {r.g: r.id for r in latest_per(skewed, ["g"], ["s", "id"]).collect()}
    exp1 = pdf.sort_values(["g", "s", "id"], ascending=[True, False, False]).groupby("g").head(1)
    assert lat == dict(zip(exp1.g, exp1.id))


def test_null_group_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int")
    assert sorted((r.g or "", r.v, r.rn) for r in row_number_by(df, ["g"], [F.col("v")], "rn").collect()) == [("", 1, 1), ("", 3, 2), ("a", 2, 1)]
    assert sorted((r.g or "", r.cum_v) for r in running_sums(df, ["g"], [F.col("v")], ["v"]).collect()) == [("", 1), ("", 4), ("a", 2)]
    assert {r.g: r.m for r in quantile_disc(df, ["g"], "v", 0.5, "m").collect()} == {None: 1, "a": 2}
