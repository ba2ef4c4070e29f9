"""Reading, materialising and Arrow plumbing shared by the text operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import parts

#: The white space of the contracts, as a Java regular expression class.
SPACE = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
    return f"{root.rstrip('/')}/claimscope-llm/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: computed once, lineage cut."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs whose frames are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column of that name exists."""
    have = {c.lower() for c in taken}
    while wanted.lower() in have:
        wanted = "_" + wanted
    return wanted


def with_arrow(df: DataFrame, text: str, start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
               fields: Sequence[T.StructField], drop_text: bool = False, most_bytes: int = 1 << 20) -> DataFrame:
    """``df`` with the columns ``fields``, made batch by batch inside its own partitions (no shuffle).

    ``start()`` runs once a task and returns a function from a record batch, whose texts
    hold ``most_bytes`` at most or which has one row, to one array per field.
    """
    kept = [f for f in df.schema.fields if not (drop_text and f.name == text)]
    keep = [f.name for f in kept]
    names = keep + [f.name for f in fields]

    def run(batches):
        made = start()
        for batch in batches:
            for part in parts(batch, text, most_bytes):
                old = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*old, *made(part)], names=names)

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


def crc32_of(id_col: str) -> Column:
    """CRC-32 of the id written as text (0 for a null id: the CRC of nothing)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def bit_filter(df: DataFrame, column: str, most_bits: int = 29):
    """A broadcast bit array with the bit ``hash mod size`` set for every 64-bit hash in ``column``.

    It only says "maybe": a caller must be right when every bit is set.  The size follows
    the number of hashes (16 bits each) up to ``2**most_bits`` bits, which bounds what is
    collected and broadcast.  Returns (broadcast uint64 words, mask).
    """
    spark = df.sparkSession
    n = df.count()
    bits = min(most_bits, max(16, int(16 * max(n, 1)).bit_length()))
    mask = (1 << bits) - 1
    low = F.col(column).bitwiseAND(F.lit(mask))
    one = F.expr("shiftleft(1L, cast(__low & 63 as int))")
    rows = (df.select(low.alias("__low")).select(F.shiftright("__low", 6).alias("w"), one.alias("b"))
              .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    if rows.num_rows:
        out[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(out), mask


def maybe_in(words: np.ndarray, mask: int, h: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in a ``bit_filter``."""
    low = h & np.uint64(mask)
    return (words[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def sha256_hex(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list array of consecutive runs of ``values``."""
    off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), values)


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keep_rows(docs: DataFrame, stay: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are in ``stay`` (id, h); of rows equal in both, one."""
    mark, key, tie = (free_name(docs.columns, c) for c in ("text_hash", "stay_id", "stay_hash"))
    marked = docs.withColumn(mark, text_hash(text_col))
    kept = marked.join(stay.select(F.col("id").alias(key), F.col("h").alias(tie)),
                       F.col(id_col).eqNullSafe(F.col(key)) & (F.col(mark) == F.col(tie)), "left_semi")
    return kept.dropDuplicates([id_col, mark]).select(*docs.columns)
