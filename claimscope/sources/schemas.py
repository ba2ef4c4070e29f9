"""Declared table schemas and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLAIMS = T.StructType([
    T.StructField("claim_id", T.StringType()), T.StructField("claim_date", T.DateType()),
    T.StructField("provider_id", T.StringType()), T.StructField("provider_name", T.StringType()),
    T.StructField("provider_specialty", T.StringType()), T.StructField("member_id", T.StringType()),
    T.StructField("service_date", T.DateType()), T.StructField("provider_city", T.StringType()),
    T.StructField("provider_state", T.StringType()), T.StructField("cpt_code", T.StringType()),
    T.StructField("icd_code", T.StringType()), T.StructField("total_billed_amt", T.DecimalType(18, 2)),
    T.StructField("total_allowed_amt", T.DecimalType(18, 3)), T.StructField("total_paid_amount", T.DecimalType(18, 4)),
    T.StructField("place_of_service", T.IntegerType()), T.StructField("is_high_acuity_em", T.IntegerType()),
    T.StructField("is_99214", T.IntegerType()), T.StructField("is_99215", T.IntegerType()),
    T.StructField("is_referral", T.IntegerType()), T.StructField("is_eye_procedure", T.IntegerType()),
    T.StructField("member_provider_distance", T.DoubleType()), T.StructField("fraud_provider_label", T.IntegerType()),
])

LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])

DATA_QUALITY = T.StructType([
    T.StructField("monitoring_timestamp", T.TimestampType()), T.StructField("model_name", T.StringType()),
    T.StructField("dataset_name", T.StringType()), T.StructField("total_rows", T.LongType()),
    T.StructField("unique_providers", T.LongType()), T.StructField("duplicate_rows", T.LongType()),
    T.StructField("null_feature_values", T.LongType()), T.StructField("invalid_feature_values", T.LongType()),
    T.StructField("monitoring_status", T.StringType()),
])


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Read with a declared schema (no inference); CSV rows that do not parse fail the job."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true").option("mode", "FAILFAST")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.format(fmt).load(path)


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed NULLs, present
    ones are cast, extra columns are kept at the end (older rows union with newer)."""
    have = set(df.columns)
    cols = [(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)
