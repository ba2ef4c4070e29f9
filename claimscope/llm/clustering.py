"""Centroid clustering (Lloyd's rounds in integers) with PCA-rotated filtering.

Vectors are turned into integers ``floor(scale * x)``.  One pass sums the moments of all vectors;
their principal axes (a dim x dim matrix) rotate every vector, and a table is written with the
integers, the ``LEAD`` leading rotated coordinates and the norm of the rest.  For a vector x and a
centroid c, rotated alike,

    |x - c|^2  >=  |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2,

because a rotation keeps distances and two vectors of lengths p and q differ by |p - q| at least.
The centroid of the smallest bound gives a distance in integers; only centroids whose bound,
less a margin for rounding, does not exceed it are verified, in integers too.  Assignments,
sums and distances are therefore exact and do not depend on the rotation.

The driver holds the moments and the centroids (k x dim numbers); tasks emit sums per cluster and
component, which Spark adds up.  No vector leaves its partition, so a cluster that holds most rows is
no hot key.

Edge cases: vectors that are null, of another length, or with a null or non-finite component are
left out.  With fewer than ``k`` vectors every one starts a centroid; with none the result is empty.
Equal vectors may start several centroids: the smaller number takes all, the others stay empty and
keep their place.  Rows that repeat an id are vectors of their own; starting ones are ordered by the
id's hash, then by their components.  A null id hashes as the empty text.  Integers beyond
+-2^27 stop the job, since squared distances would leave 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Leading rotated coordinates that are stored.
LEAD = 16
#: Part of the squared lengths by which a bound is lowered: far above the rounding of float64 sums.
MARGIN = 1e-9
LARGEST = 1 << 27
#: Rows compared at once.
_ROWS = 4096


def whole_vectors(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors, and their integers."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), -1), dtype=np.int64)
    rows = np.flatnonzero(size == dim)
    flat = column.take(pa.array(rows)).flatten()
    missing = np.asarray(flat.is_null()).reshape(-1, dim).any(axis=1)
    x = np.asarray(pc.fill_null(flat, 0), dtype=np.float64).reshape(-1, dim)
    good = ~missing & np.isfinite(x).all(axis=1)
    v = np.floor(scale * x[good])
    if len(v) and np.abs(v).max() > LARGEST:
        raise ArithmeticError(f"a component is beyond +-{LARGEST} after scaling")
    return rows[good], v.astype(np.int64)


class Axes(NamedTuple):
    """A rotation around the mean: columns are principal axes, the widest first."""

    mean: np.ndarray
    turn: np.ndarray
    lead: int

    def place(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, norm of the rest, and squared lengths that bound the rounding."""
        turned = (v - self.mean) @ self.turn
        rest = np.sqrt((turned[:, self.lead:] ** 2).sum(axis=1))
        size = (v.astype(np.float64) ** 2).sum(axis=1) + float(self.mean @ self.mean)
        return turned[:, :self.lead], rest, size


def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, size: np.ndarray,
            centroids: np.ndarray, axes: Axes) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and how many were verified."""
    c_lead, c_rest, c_size = axes.place(centroids)
    bound = ((lead ** 2).sum(axis=1)[:, None] + (c_lead ** 2).sum(axis=1)[None, :] - 2.0 * (lead @ c_lead.T)
             + (rest[:, None] - c_rest[None, :]) ** 2)
    bound -= MARGIN * (size[:, None] + c_size[None, :])
    first = bound.argmin(axis=1)
    best = ((v - centroids[first]) ** 2).sum(axis=1)
    open_ = bound <= best[:, None]
    open_[np.arange(len(v)), first] = False
    row, number = np.nonzero(open_)
    other = np.empty(len(row), np.int64)
    for at in range(0, len(row), 1 << 16):
        some = slice(at, at + (1 << 16))
        other[some] = ((v[row[some]] - centroids[number[some]]) ** 2).sum(axis=1)
    row = np.concatenate([np.arange(len(v)), row])
    number = np.concatenate([first, number])
    other = np.concatenate([best, other])
    order = np.lexsort((number, other, row))
    keep = order[np.unique(row[order], return_index=True)[1]] if len(order) else order
    return number[keep], other[keep], len(row)


def _moments(batches, vec_col: str, dim: int, scale: float) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dim + 1, dim + 1))
    for batch in batches:
        _, v = whole_vectors(batch.column(batch.schema.get_field_index(vec_col)), dim, scale)
        one = np.hstack([np.ones((len(v), 1)), v])
        total += one.T @ one
    if total[0, 0]:
        i, j = np.triu_indices(dim + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])


def principal_axes(df: DataFrame, dim: int, scale: float, vec_col: str, lead: int) -> Axes | None:
    """Axes of all usable vectors; None when there is none."""
    cells = df.select(vec_col).mapInArrow(lambda b: _moments(b, vec_col, dim, scale), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((dim + 1, dim + 1))
    for i, j, v in cells.collect():  # (dim + 1) (dim + 2) / 2 rows
        total[i, j] = total[j, i] = v
    n = total[0, 0]
    if not n:
        return None
    mean = total[0, 1:] / n
    _, turn = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    return Axes(mean, turn[:, ::-1].copy(), min(lead, dim))


def _place(batches, axes: Axes, id_col: str, vec_col: str, dim: int, scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, v = whole_vectors(batch.column(batch.schema.get_field_index(vec_col)), dim, scale)
        for at in range(0, len(rows), _ROWS):
            some = v[at:at + _ROWS]
            lead, rest, _ = axes.place(some)
            ids = batch.column(batch.schema.get_field_index(id_col)).take(pa.array(rows[at:at + _ROWS]))
            yield pa.RecordBatch.from_arrays([ids, _packed(some.astype("<i4")), _packed(lead.astype("<f8")), pa.array(rest)],
                                             names=["id", "ints", "lead", "rest"])


def _packed(values: np.ndarray) -> pa.Array:
    """Each row of numbers as the bytes of one binary value."""
    raw = np.ascontiguousarray(values)
    wide = raw.shape[1] * raw.itemsize
    off = np.arange(len(raw) + 1, dtype=np.int32) * wide
    return pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(off), pa.py_buffer(raw.tobytes())])


def _unpacked(column: pa.Array, kind: str, wide: int) -> np.ndarray:
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind).reshape(len(column), wide) if len(column) else np.zeros((0, wide), kind)


def _assigned(batches, centroids: np.ndarray, axes: Axes):
    """(batch, integers, cluster, distance) of bounded slices of the batches."""
    dim = centroids.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            name = part.schema.get_field_index
            v = _unpacked(part.column(name("ints")), "<i4", dim).astype(np.int64)
            lead = _unpacked(part.column(name("lead")), "<f8", axes.lead)
            size = (v.astype(np.float64) ** 2).sum(axis=1) + float(axes.mean @ axes.mean)
            number, distance, _ = nearest(v, lead, np.asarray(part.column(name("rest"))), size, centroids, axes)
            yield part, v, number, distance


def _sums(batches, centroids: np.ndarray, axes: Axes) -> Iterator[pa.RecordBatch]:
    k, dim = centroids.shape
    total = np.zeros((k, dim + 1), np.int64)  # the last column counts
    for _, v, number, _ in _assigned(batches, centroids, axes):
        order = np.argsort(number, kind="stable")
        have, first = np.unique(number[order], return_index=True)
        if len(have):
            total[have, :dim] += np.add.reduceat(v[order], first, axis=0)
            total[:, dim] += np.bincount(number, minlength=k)
    have = np.flatnonzero(total[:, dim])
    i, j = np.repeat(have, dim + 1), np.tile(np.arange(dim + 1), len(have))
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["cluster", "part", "v"])


def _labels(batches, centroids: np.ndarray, axes: Axes) -> Iterator[pa.RecordBatch]:
    for part, _, number, distance in _assigned(batches, centroids, axes):
        yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("id")), pa.array(number.astype(np.int32)), pa.array(distance)],
                                         names=["id", "cluster", "distance"])


class Clusters(NamedTuple):
    """``rows``: (id, cluster, distance), a written table; ``centroids``: one tuple of integers a cluster."""

    rows: DataFrame
    centroids: list[tuple[int, ...]]


def cluster_vectors(df: DataFrame, k: int, rounds: int, dim: int, seed: int, scale: float = 256.0,
                    id_col: str = "vec_id", vec_col: str = "embedding", lead: int = LEAD) -> Clusters:
    """Lloyd's rounds from the ``k`` vectors with the smallest hash of ``seed:id``."""
    df = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    of_id = df.schema["id"].dataType
    axes = principal_axes(df, dim, scale, "vec", lead)
    label = T.StructType([T.StructField("id", of_id), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if axes is None:
        return Clusters(df.sparkSession.createDataFrame([], label), [])
    stored = T.StructType([T.StructField("id", of_id), T.StructField("ints", T.BinaryType()), T.StructField("lead", T.BinaryType()),
                           T.StructField("rest", T.DoubleType())])
    store = written(df.mapInArrow(lambda b: _place(b, axes, "id", "vec", dim, scale), stored))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    begin = store.select(F.sha2(text.cast("binary"), 256).alias("h"), "ints").orderBy("h", "ints").limit(k).collect()  # k rows
    centroids = np.array([np.frombuffer(bytes(r.ints), "<i4") for r in begin], np.int64)
    for _ in range(rounds):
        now = centroids
        sums = (store.mapInArrow(lambda b, now=now: _sums(b, now, axes), "cluster int, part int, v long")
                     .groupBy("cluster", "part").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())  # k (dim + 1) rows
        counts = {r.cluster: int(r.v) for r in sums if r.part == dim}
        centroids = now.copy()
        for r in sums:
            if r.part < dim:
                centroids[r.cluster, r.part] = int(r.v) // counts[r.cluster]
        if (centroids == now).all():
            break  # later rounds would change nothing
    rows = written(store.mapInArrow(lambda b: _labels(b, centroids, axes), label))
    return Clusters(rows, [tuple(c) for c in centroids.tolist()])


def clusters_report(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> DataFrame:
    """One row per vector with the columns of the contract."""
    rows, centroids = cluster_vectors(df, k, rounds, dim, seed)
    spark = df.sparkSession
    named = spark.createDataFrame([(i, ",".join(map(str, c))) for i, c in enumerate(centroids)], "cluster int, components string")
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = rows.agg(F.sum("distance").alias("inertia"))
    # k rows and one row
    extra = sums.join(F.broadcast(named), "cluster").crossJoin(F.broadcast(total))
    return rows.join(F.broadcast(extra), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"))


def oracle(k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> str:
    """DuckDB SQL for the rows of ``clusters_report``."""
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vectors AS MATERIALIZED (SELECT rid, unnest(range({dim})) AS i, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (SELECT c, unnest(range({dim})) AS i, unnest(v) AS x FROM (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM kept) WHERE c < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, c, d FROM (
  SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS place FROM (
    SELECT rid, c, CAST(sum((vectors.x - c{r}.x) * (vectors.x - c{r}.x)) AS BIGINT) AS d FROM vectors JOIN c{r} USING (i) GROUP BY rid, c))
  WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.c, c{r}.i, coalesce(moved.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
  SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN vectors USING (rid) GROUP BY c, i)) AS moved USING (c, i))""")
    return "WITH " + ",\n".join(steps) + f""",
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN named USING (c)"""


ORACLE = oracle()
