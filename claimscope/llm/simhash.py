"""SimHash near-duplicate detection with bit-sliced comparison.

Fingerprints: A-Z is lower-cased, words are runs of characters outside
``[\\x20\\x09-\\x0D]``, shingles are 4 consecutive words joined by one space (fewer
words: all of them), repeats included.  Bit b of a fingerprint is set when it is set in
more than half of the shingles' XXH64 values (seed 42).

Links: fingerprints that differ in at most ``radius`` bits.  The 64 bits are cut into
``radius + k`` blocks, so two linked fingerprints agree in k blocks at least; each choice of
k blocks is a table, and only fingerprints of one bucket of one table are compared.  k is 2 (15 tables with
21-bit keys for radius 4) and grows with the number of rows (3: 35 tables with 27-bit keys), so that
buckets stay small; the links are the same.
Equal fingerprints are one row from the start.  A bucket of more than ``BUCKET`` rows is
cut into chunks, and each pair of chunks is its own group, so no task holds a whole hot
bucket.  A group gives a spanning forest of its links, never all pairs.

The comparison keeps bit planes: lane j of plane b is bit b of row j, 64 lanes to a word.
A query's differing bits are added to carry-save counters, one plane after the other, and
a word of 64 lanes is dropped as soon as all of its lanes exceed the radius.

Edge cases: a text that is null or has no words has fingerprint zero, linked like any
other.  Null ids never name a component unless all its ids are null.  Rows that repeat
wholly are one document for ``simhash_dedup``, which keeps one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, shuffle_partitions, text_hash, with_arrow, written
from .graph import components
from .words import LOWER, texts_of, words_of

SHINGLE = 4
RADIUS = 4
#: Rows of a bucket compared in one group; larger buckets are compared chunk by chunk.
BUCKET = 1024
#: 64-lane words compared at once.
_SLAB = 100_000


def _fingerprints(column: pa.Array, shingle: int) -> pa.Array:
    w = words_of(texts_of(column), LOWER)
    vocab = w.vocab.cast(pa.binary()).to_pylist()
    n = np.diff(w.offsets)
    size = np.fromiter(map(len, vocab), np.int64, len(vocab))[w.codes] if len(vocab) else np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    values: list[int] = []
    for a, b in zip(w.offsets[:-1], w.offsets[1:]):
        if a == b:
            continue
        text = b" ".join([vocab[c] for c in w.codes[a:b].tolist()])
        ends = np.cumsum(size[a:b] + 1)
        starts = np.concatenate([[0], ends[:-1]])
        k = min(shingle, b - a)
        values += [digest(text[i:j], 42) for i, j in zip(starts[:len(starts) - k + 1].tolist(), (ends[k - 1:] - 1).tolist())]
    per = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
    h = np.array(values, np.uint64)
    out = np.zeros(len(n), np.uint64)
    some = per > 0
    if some.any():
        first = (np.cumsum(per) - per)[some]
        for bit in range(64):
            ones = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(1), first)
            out[some] |= (ones * 2 > per[some]).astype(np.uint64) << np.uint64(bit)
    return pa.array(out.view(np.int64), pa.int64())


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, out: str = "fp",
                     drop_text: bool = False) -> DataFrame:
    """``docs`` with the fingerprint as a long column."""
    def start():
        return lambda part: [_fingerprints(part.column(part.schema.get_field_index(text_col)), shingle)]

    return with_arrow(docs, text_col, start, [T.StructField(out, T.LongType())], drop_text=drop_text)


def _tables(radius: int, agree: int = 2) -> list[int]:
    """Bit masks of every choice of ``agree`` of ``radius + agree`` blocks of the 64 bits."""
    edges = np.linspace(0, 64, radius + agree + 1).round().astype(int).tolist()
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def blocks_to_agree(rows: int, radius: int = RADIUS, bucket: int = BUCKET) -> int:
    """How many blocks a table's key should have, so that evenly spread rows fill a quarter of a bucket at most."""
    agree = 2
    while agree < 6 and rows > (bucket // 4) << (64 * agree // (radius + agree)):
        agree += 1
    return agree


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _planes(fp: np.ndarray) -> np.ndarray:
    """(64, words) bit planes, lane j in bit j % 64 of word j // 64."""
    lanes = -(-len(fp) // 64) * 64
    bits = np.zeros((64, lanes), np.uint8)
    for b in range(64):
        bits[b, :len(fp)] = (fp >> np.uint64(b)) & np.uint64(1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _near(fp: np.ndarray, end: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs i < j < end[i] whose fingerprints differ in at most ``radius`` bits."""
    planes = _planes(fp)
    row = np.flatnonzero(end - np.arange(len(fp)) > 1)
    n_words = (end[row] - 1) // 64 - row // 64 + 1
    got_i, got_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    reach = np.cumsum(n_words)
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + _SLAB, side="right")))
        r, k = row[at:stop], n_words[at:stop]
        at = stop
        q = np.repeat(r, k)
        word = np.arange(len(q)) - np.repeat(np.cumsum(k) - k, k) + q // 64
        # lanes after the query's own and before the end of its bucket
        first, last = np.maximum(q + 1 - word * 64, 0), np.minimum(end[q] - word * 64, 64)
        lane = np.where(first >= 64, np.uint64(0), _ALL << np.minimum(first, 63).astype(np.uint64))
        lane &= _ALL >> (64 - np.maximum(last, 1)).astype(np.uint64)
        # count in binary, one array per digit; `over` holds what no longer fits
        digits = [np.zeros(len(q), np.uint64) for _ in range(radius.bit_length())]
        over = ~lane
        for b in range(64):
            carry = planes[b][word] ^ np.where((fp[q] >> np.uint64(b)) & np.uint64(1), _ALL, np.uint64(0))
            for d in digits:
                carry, d[:] = d & carry, d ^ carry
            over |= carry
            if b % 8 == 7:
                over |= _above(digits, radius)
                live = over != _ALL
                if not live.all():
                    q, word, over = q[live], word[live], over[live]
                    digits = [d[live] for d in digits]
                    if not len(q):
                        break
        if len(q):
            bits = np.unpackbits((~over).view(np.uint8).reshape(len(q), 8), axis=1, bitorder="little")
            x, y = np.nonzero(bits)
            got_i.append(q[x])
            got_j.append(word[x] * 64 + y)
    return np.concatenate(got_i), np.concatenate(got_j)


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose binary count is larger than the radius."""
    more, same = np.zeros_like(digits[0]), np.full_like(digits[0], _ALL)
    for k in reversed(range(len(digits))):
        if radius >> k & 1:
            same = same & digits[k]
        else:
            more = more | (same & digits[k])
            same = same & ~digits[k]
    return more


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest row of each row's component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, j, label[i])
        np.minimum.at(label, i, label[j])
        label = label[label]
        if (before == label).all():
            return label


def _compare(batches, radius: int):
    """Star edges of every group; the rows arrive sorted by group."""
    held: pa.Table | None = None

    def edges(t: pa.Table):
        fp = t.column("fp").to_numpy().view(np.uint64)
        keys = [t.column(c).to_numpy() for c in ("t", "key", "a", "b")]
        new = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
        ends = np.append(np.flatnonzero(new)[1:], len(fp))
        i, j = _near(fp, ends[np.cumsum(new) - 1], radius)
        root = _forest(i, j, len(fp))
        moved = np.flatnonzero(root != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[root[moved]])], names=["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        last = [held.column(c)[held.num_rows - 1].as_py() for c in ("t", "key", "a", "b")]
        same = np.logical_and.reduce([held.column(c).to_numpy() == x for c, x in zip(("t", "key", "a", "b"), last)])
        cut = int(np.argmax(same))  # rows of the last group may go on in the next batch
        if cut:
            yield edges(held.slice(0, cut).combine_chunks())
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield edges(held.combine_chunks())


def near_edges(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, agree: int = 2) -> DataFrame:
    """Edges (u, v) that connect all distinct long fingerprints ``fp`` within ``radius`` bits of each other.

    ``agree``: blocks of a table's key.
    """
    n = shuffle_partitions(prints.sparkSession)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in enumerate(_tables(radius, agree))])).alias("k")).select("k.t", "k.key", "fp")
    full = (keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
            .select("t", "key", F.ceil(F.col("n") / bucket).cast("int").alias("chunks")))
    cut = keyed.join(full, ["t", "key"], "left").select(
        "t", "key", "fp", F.coalesce("chunks", F.lit(1)).alias("chunks"))
    cut = cut.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    group = cut.select("t", "key", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o")).select(
        "t", "key", "fp", F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b"))
    keys = ["t", "key", "a", "b"]
    dealt = group.repartition(n, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(lambda batches: _compare(batches, radius), "u long, v long").distinct()


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root): the component of every distinct fingerprint of ``prints``."""
    one = prints.select("fp").distinct()
    roots = components(near_edges(one, radius, agree=blocks_to_agree(prints.count(), radius)))
    return one.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   radius: int = RADIUS) -> DataFrame:
    """One row per document: id, ``fp``, ``component_id`` (the smallest id that links reach)."""
    prints = written(with_fingerprint(docs.select(id_col, text_col), text_col, shingle, drop_text=True))
    part = written(_components(prints, radius))
    # a table of its own, so that Spark can split a large component's rows in the join
    named = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")).join(part, "fp")
                    .groupBy("root").agg(F.min("least").alias("component_id")))
    return prints.join(part.join(named, "root").select("fp", "component_id"), "fp")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  radius: int = RADIUS) -> DataFrame:
    """One document of each group, with its own columns: the smallest id, then the smallest text hash."""
    hashed = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("text"))
    prints = written(with_fingerprint(hashed, "text", shingle, drop_text=True))
    part = written(_components(prints, radius))
    # fewest rows first: one candidate per fingerprint, then one per component
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    stay = (prints.groupBy("fp").agg(F.min(rank).alias("r")).join(part, "fp")
            .groupBy("root").agg(F.min("r").alias("r")).select("r.id", "r.h"))
    return keep_rows(docs, stay, id_col, text_col)


def simhash_report(docs: DataFrame) -> DataFrame:
    """One row per document with the digest columns of the contract."""
    return simhash_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
