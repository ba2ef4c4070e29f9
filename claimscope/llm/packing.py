"""Best-fit packing of documents into sequences, by bin completion with branch and bound.

1. Tasks encode the documents, cut longer ones than a sequence into whole sequences (the first piece
   takes the remainder) and write one row per piece, numbered within its task and length.
2. The pieces are counted by length: at most ``capacity`` numbers, all that the packing depends
   on, however many documents there are.  They go to the driver.
3. ``plan_bins`` finds fillings.  The bin of the longest piece left is completed: its undominated
   fillings are enumerated, least waste first, and the chosen one is repeated as often as the counts
   allow.  A branch ends when its waste, or a lower bound of the rest, shows that it can't beat
   the incumbent.  Incumbents are best-fit solutions: longest piece first, then always the longest that
   still fits, or the filling with the least waste.  The search ends at the lower bound or after
   ``NODES`` nodes; then the incumbent stays, and every piece has its place all the same.
4. Pieces are numbered over all tasks (counts by task and length, summed before), and the number and
   the length say which bin of which filling a piece goes to, and where.

A filling uses one length up whenever it is applied, so a plan has few more rows than there are
lengths.  Texts stay in their partition; only counts are shuffled.  The commonest length (whole
sequences) is split by task.

Edge cases: a null or empty text is the end id alone.  Rows that repeat, or have a null id, are documents of
their own.  No documents: no rows.  Texts of any length are encoded in steps of bounded size;
their ids are held in one row's task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytebpe import STEP, encoder_of
from .common import free_name, written
from .words import parts, texts_of

#: Nodes of the search at most.
NODES = 6000
#: Fillings tried at a node.
WIDTH = 8
#: Items of a filling up to which dominance is searched for; beyond, best-fit placement decides.
_SMALL = 10


# fillings ---------------------------------------------------------------------
Filling = tuple[int, ...]  # lengths, the longest first


class Use(NamedTuple):
    """A bin with these lengths, ``times`` times."""

    filling: Filling
    times: int


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that ``counts[length]`` pieces need at least (Martello and Toth's L2)."""
    length = np.arange(len(counts))
    total = np.cumsum(counts * length)
    number = np.cumsum(counts)
    half = capacity // 2
    best = -(-int(total[-1]) // capacity)
    k = np.arange(half + 1)
    top = np.minimum(capacity - k, len(counts) - 1)
    mid = min(half, len(counts) - 1)
    large = number[-1] - number[top]
    middle = number[top] - number[mid]
    small = total[mid] - np.where(k > 0, total[np.minimum(np.maximum(k - 1, 0), len(counts) - 1)], 0)
    room = middle * capacity - (total[top] - total[mid])
    need = large + middle + np.maximum(0, -(-(small - room) // capacity))
    return max(best, int(need.max()))


def dominates(a: Filling, b: Filling) -> bool:
    """Whether the pieces of ``b`` can be placed into bins as long as the pieces of ``a``.

    Then ``a`` is no worse: what ``b`` would take can go where ``a``'s pieces were.
    """
    room = list(a)

    def place(i: int) -> bool:
        if i == len(b):
            return True
        tried = set()
        for j in sorted(range(len(room)), key=room.__getitem__):
            if room[j] >= b[i] and room[j] not in tried:
                tried.add(room[j])
                room[j] -= b[i]
                if place(i + 1):
                    return True
                room[j] += b[i]
                if len(b) > _SMALL:
                    return False
        return False

    return sum(a) >= sum(b) and place(0)


def _reachable(sizes: list[int], counts: list[int], gap: int) -> list[int]:
    """For every i, the sums up to ``gap`` that ``sizes[i:]`` can make, as the bits of an integer."""
    mask = (1 << (gap + 1)) - 1
    out = [1]
    sums = 1
    for size, count in zip(reversed(sizes), reversed(counts)):
        left, step = min(count, gap // size), 1
        while left > 0:
            take = min(step, left)
            sums |= (sums << (size * take)) & mask
            left -= take
            step *= 2
        out.append(sums)
    return out[::-1]


def completions(counts: np.ndarray, longest: int, capacity: int, waste: int) -> Iterator[Filling]:
    """Undominated fillings around one piece of length ``longest``, least waste first, at most ``WIDTH``."""
    gap = capacity - longest
    have = counts[:gap + 1].copy()
    if longest <= gap:
        have[longest] -= 1
    if gap and have[gap]:
        yield (longest, gap)  # dominates every other filling
        return
    sizes = np.flatnonzero(have)[::-1].tolist()
    number = [int(have[s]) for s in sizes]
    sums = _reachable(sizes, number, gap)
    found: list[Filling] = []

    def fill(i: int, left: int, made: tuple[int, ...]) -> Iterator[Filling]:
        if not left:
            yield made
            return
        while i < len(sizes) and (sizes[i] > left or not sums[i] >> left & 1):
            if not sums[i] >> left & 1:
                return
            i += 1
        if i == len(sizes):
            return
        for k in range(min(number[i], left // sizes[i]), -1, -1):
            if sums[i + 1] >> (left - k * sizes[i]) & 1:
                yield from fill(i + 1, left - k * sizes[i], made + (sizes[i],) * k)

    for goal in range(gap, max(-1, gap - waste - 1), -1):
        if not sums[0] >> goal & 1:
            continue
        for filling in fill(0, goal, ()):
            if not any(dominates(f, filling) for f in found):
                found.append(filling)
                yield (longest, *filling)
            if len(found) >= WIDTH:
                return


def _times(counts: np.ndarray, filling: Filling) -> int:
    return min(int(counts[s]) // n for s, n in Counter(filling).items())


def _apply(counts: np.ndarray, use: Use, sign: int) -> None:
    for s in use.filling:
        counts[s] -= sign * use.times


def best_fit(counts: np.ndarray, capacity: int) -> list[Use]:
    """Longest piece first, then the longest that still fits; equal bins are filled together."""
    left = counts.copy()
    out = []
    while left.any():
        filling, room = [], capacity
        used: Counter = Counter()
        s = len(left) - 1
        while s > 0 and room > 0:
            s = min(s, room)
            while s > 0 and left[s] <= used[s]:
                s -= 1
            if s > 0:
                filling.append(s)
                used[s] += 1
                room -= s
        use = Use(tuple(filling), _times(left, tuple(filling)))
        _apply(left, use, 1)
        out.append(use)
    return out


def plan_bins(lengths: Mapping[int, int], capacity: int, nodes: int = NODES) -> list[Use]:
    """Fillings that hold ``lengths[length]`` pieces of every length, in as few bins as the search finds."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in lengths.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        counts[length] = n
    whole = [Use((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    best = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    fewest = sum(u.times for u in best)
    left = counts.copy()
    path: list[Use] = []
    branches: list[Iterator[Filling]] = []
    used = seen = 0
    total = int((left * np.arange(capacity + 1)).sum())
    weights = np.arange(capacity + 1)

    def branch() -> Iterator[Filling]:
        slack = (fewest - 1 - used) * capacity - total
        if slack < 0 or used + lower_bound(left, capacity) >= fewest:
            return iter(())
        return completions(left, int(weights[left > 0][-1]), capacity, slack)

    if fewest > least:
        branches.append(branch())
    while branches and fewest > least and seen < nodes:
        filling = next(branches[-1], None)
        if filling is None:
            branches.pop()
            if path:
                use = path.pop()
                _apply(left, use, -1)
                used -= use.times
                total += use.times * sum(use.filling)
            continue
        seen += 1
        use = Use(filling, _times(left, filling))
        _apply(left, use, 1)
        path.append(use)
        used += use.times
        total -= use.times * sum(filling)
        if total:
            branches.append(branch())
        else:
            if used < fewest:
                fewest, best = used, list(path)
            branches.append(iter(()))
    return whole + best


# documents ----------------------------------------------------------------------
def _cut(n: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of the pieces of documents of ``n`` ids."""
    number = -(-n // capacity)
    doc = np.repeat(np.arange(len(n)), number)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    head = n - (number - 1) * capacity
    length = np.where(piece == 0, head[doc], capacity)
    return doc, piece, np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity), length


def _pieces(batches, tokenizer: str, end_id: int, capacity: int, ids_too: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encoder = encoder_of(tokenizer)
    shard = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    names = ["id", "piece", "start", "length", "crc", "shard", "no"] + ["ids"] * ids_too
    for batch in batches:
        for part in parts(batch, "text", STEP // 2):
            texts = texts_of(part.column(1))
            if part.nbytes > STEP:  # one long text
                ids = encoder.encode_long(texts[0])
                counts = np.array([len(ids)])
            else:
                ids, counts = encoder.encode(texts)
            n = counts + 1
            flat = np.full(len(ids) + len(n), end_id, "<u4")
            flat[np.arange(len(ids)) + np.repeat(np.arange(len(n)), counts)] = ids
            doc, piece, start, length = _cut(n, capacity)
            begin = (np.cumsum(n) - n)[doc] + start
            data = memoryview(flat).cast("B")
            spans = [data[4 * a:4 * (a + k)] for a, k in zip(begin.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            have, first, count = np.unique(length[order], return_index=True, return_counts=True)
            no = np.empty(len(length), np.int64)
            no[order] = np.arange(len(length)) - np.repeat(first, count) + np.repeat(seen[have], count)
            seen[have] += count
            made = [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(x) for x in spans], pa.int64()), pa.array(np.full(len(doc), shard, np.int32)), pa.array(no)]
            if ids_too:
                made.append(pa.array([bytes(x) for x in spans], pa.binary()))
            for at in range(0, len(doc), 10_000):
                yield pa.RecordBatch.from_arrays([c.slice(at, 10_000) for c in made], names=names)


class _Ranges(NamedTuple):
    """Where the pieces of one length go, by ranges of their number."""

    begin: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray


def _ranges(plan: list[Use]) -> dict[int, _Ranges]:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    upto: Counter = Counter()
    first = 0
    for use in plan:
        offset = 0
        for size, n in sorted(Counter(use.filling).items(), reverse=True):
            rows.setdefault(size, []).append((upto[size], first, n, offset))
            upto[size] += n * use.times
            offset += n * size
        first += use.times
    return {s: _Ranges(*(np.array(c, np.int64) for c in zip(*r))) for s, r in rows.items()}


def _placed(batches, ranges: dict[int, _Ranges]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        get = batch.schema.get_field_index
        length, number = np.asarray(batch.column(get("length"))), np.asarray(batch.column(get("number")))
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length).tolist():
            at = np.flatnonzero(length == size)
            r = ranges[size]
            i = np.searchsorted(r.begin, number[at], side="right") - 1
            inside = number[at] - r.begin[i]
            sequence[at] = r.bin[i] + inside // r.each[i]
            offset[at] = r.offset[i] + inside % r.each[i] * size
        yield pa.RecordBatch.from_arrays([*batch.drop_columns(["number"]).columns, pa.array(sequence), pa.array(offset)],
                                         names=[*(c for c in batch.schema.names if c != "number"), "sequence_id", "offset"])


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", ids_too: bool = True, nodes: int = NODES) -> DataFrame:
    """One row per piece: the id column, piece, start, length, ids_crc32, sequence_id, offset, and its ids (32-bit, little-endian).

    Other columns of ``docs`` are not read.  An id column that is called like one of those gets underscores in front.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "crc")]
    fields += [T.StructField("shard", T.IntegerType()), T.StructField("no", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] * ids_too
    pieces = written(rows.mapInArrow(lambda b: _pieces(b, tokenizer.value, end_id, capacity, ids_too), T.StructType(fields)))
    counts = pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n"))
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    ranges = _ranges(plan_bins(lengths, capacity, nodes))
    # a length has one row per task that wrote the pieces
    before = counts.select("shard", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    numbered = (pieces.join(before, ["shard", "length"]).withColumn("number", F.col("before") + F.col("no"))
                      .select("id", "piece", "start", "length", "crc", *["ids"] * ids_too, "number"))
    out = T.StructType([*(f for f in numbered.schema if f.name != "number"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    placed = numbered.mapInArrow(lambda b: _placed(b, ranges), out)
    own = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * ids_too]
    return placed.withColumnRenamed("crc", "ids_crc32").select(F.col("id").alias(free_name(own, id_col)), *own)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, length, ids (32-bit, little-endian), and where its pieces begin."""
    parts_ = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts_.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        F.aggregate("p", F.lit(b""), lambda b, x: F.concat(b, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["offset"]).alias("begins"))


def packing_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece with the digest columns of the contract."""
    return pack_documents(docs, tokenizer_path, ids_too=False)
