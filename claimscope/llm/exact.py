"""Exact deduplication by progressive refinement, with DataFrame functions only.

Two texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted.  Rows are grouped by the length of that normal form,
then by the hash of its first ``PREFIX`` characters, then by the SHA-256 of all of it; each
level looks only at rows whose group of the level before has two rows or more.  All hashes are
made where the text is read, so no text is shuffled and no level reads it again; the levels
shuffle a few numbers a row, aggregated before the shuffle.

Of equal texts the row with the most code points in the original text stays, then the one
with the smallest id, then the smallest hash of the original text.

Edge cases: a null text is the empty text.  A null id comes after all others.  Rows that
are equal in id and text are all returned by ``exact_groups`` and exactly one of them can
be ``kept``; ``exact_dedup`` returns one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, text_hash, written

#: Characters of the normal form in the prefix hash.
PREFIX = 64

_SPACES = " \t\n\x0b\x0c\r"


def normal(text: Column) -> Column:
    """The text without white space."""
    return F.translate(F.coalesce(text, F.lit("")), _SPACES, "")


def surviving_keys(rows: DataFrame) -> DataFrame:
    """(len, pre) that two rows or more share; only rows whose length repeats are grouped by prefix hash."""
    # tables of their own, so that Spark can split the rows of a common length or prefix in the joins
    lengths = written(rows.groupBy("len").agg(F.sum("copies").alias("n")).where("n > 1").select("len"))
    return written(rows.join(lengths, "len", "left_semi").groupBy("len", "pre").agg(F.sum("copies").alias("n"))
                       .where("n > 1").select("len", "pre"))


def _groups(docs: DataFrame, id_col: str, text_col: str, prefix: int) -> DataFrame:
    """id, h, keep_id, group_size, kept, text_sha256 of every row."""
    form, text = normal(F.col(text_col)), F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.length(text).alias("points"), text_hash(text_col).alias("h"),
                       F.length(form).alias("len"), F.xxhash64(F.left(form, F.lit(prefix))).alias("pre"),
                       F.sha2(form, 256).alias("text_sha256"))
    # rows equal in id and text are one row with a count from here on
    rows = written(read.groupBy(*read.columns).agg(F.count(F.lit(1)).alias("copies")))
    marked = rows.join(surviving_keys(rows).withColumn("alive", F.lit(True)), ["len", "pre"], "left")
    order = F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("n"), F.col("id"), F.col("h"))
    groups = written(marked.where("alive").groupBy("text_sha256")
                           .agg(F.sum("copies").alias("size"), F.min(order).alias("first")))
    named = marked.join(groups, "text_sha256", "left")
    single = F.col("size").isNull()
    return named.select("id", "h", F.when(single, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
                        F.coalesce("size", "copies").alias("group_size"), (single | order.eqNullSafe(F.col("first"))).alias("first"),
                        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"), "text_sha256").select(
        "id", "h", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    return _groups(docs, id_col, text_col, prefix).withColumnRenamed("id", id_col).drop("h")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The rows that stay, with their own columns."""
    return keep_rows(docs, _groups(docs, id_col, text_col, prefix).where("kept"), id_col, text_col)


#: The same result in DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS form
  FROM documents),
r AS (
  SELECT doc_id, sha256(form) AS text_sha256, count(*) OVER (PARTITION BY form) AS group_size,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
  FROM d WINDOW w AS (PARTITION BY form ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM r
"""
