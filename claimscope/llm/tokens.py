"""Token-ID output: one concatenated id array with Elias-Fano encoded document boundaries.

A table of segments is written as Parquet into a shared folder.  A segment holds the ids of
consecutive documents (ascending id order) and two Elias-Fano sequences: the documents' end
offsets within the segment and the document ids.  An Elias-Fano sequence of n non-decreasing
numbers up to u stores the low ``floor(log2(u / n))`` bits of each number packed, and the high
bits as a unary bit string; ``select`` (the position of the k-th set bit) gives a number back,
helped by the positions of every ``SAMPLE``-th set bit.  That is about 2 + log2(u / n) bits a
document instead of a table of 64-bit offsets.

Ids are little-endian and as wide as the largest id needs (2 or 4 bytes).  Offsets over all
segments come from the segments' own token counts, first summed by shard.

Edge cases: a null text is empty (the end id only).  Null document ids come first, as many as
``n_null`` says.  Rows that repeat an id follow each other.  No documents: no segments.  Words are
encoded one by one; that equals encoding the whole text for a tokenizer that lower-cases and
whose pre-tokenizer never joins characters across white space, or letters with others.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, shuffle_partitions
from .idcache import IdCache, Made, runs
from .words import LOWER, parts, recode, texts_of

#: Set bits between two sampled positions of a select structure.
SAMPLE = 256
#: Ids of a segment, as a target: a segment ends with the document that reaches it.
SEGMENT = 1 << 20
#: Words of letters that are encoded joined.
_JOIN = 500

SCHEMA = ("shard int, segment int, n_docs long, n_null long, n_tokens long, width int, ids binary, "
          "end_low binary, end_high binary, end_bits int, end_sample binary, "
          "doc_base long, doc_low binary, doc_high binary, doc_bits int, doc_sample binary")


class EliasFano(NamedTuple):
    """n non-decreasing numbers from 0: packed low bits, unary high bits, sampled select positions."""

    n: int
    bits: int
    low: bytes
    high: bytes
    sample: bytes


def ef_encode(values: np.ndarray) -> EliasFano:
    """``values``: non-decreasing unsigned 64-bit numbers."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return EliasFano(0, 0, b"", b"", b"")
    bits = max(0, (int(values[-1]) // n).bit_length() - 1)
    low = np.zeros((n, bits), np.uint8)
    for b in range(bits):
        low[:, b] = (values >> np.uint64(b)) & np.uint64(1)
    at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(at[-1]) + 1, np.uint8)
    high[at] = 1
    return EliasFano(n, bits, np.packbits(low.ravel(), bitorder="little").tobytes(),
                     np.packbits(high, bitorder="little").tobytes(), at[::SAMPLE].astype("<u4").tobytes())


def ef_select(ef: EliasFano, k: int) -> int:
    """The k-th number (from 0): scans at most ``SAMPLE`` set bits from a sampled position."""
    if not 0 <= k < ef.n:
        raise IndexError(k)
    at = int(np.frombuffer(ef.sample, "<u4")[k // SAMPLE])
    left = k % SAMPLE
    byte, bit = at >> 3, at & 7
    ones = ef.high[byte] >> bit << bit
    while left >= ones.bit_count():
        left -= ones.bit_count()
        byte += 1
        ones = ef.high[byte]
    for _ in range(left):
        ones &= ones - 1
    place = (byte << 3) + (ones & -ones).bit_length() - 1
    first = k * ef.bits
    last = first + ef.bits
    low = int.from_bytes(ef.low[first >> 3:(last + 7) >> 3], "little") >> (first & 7) & ((1 << ef.bits) - 1)
    return (place - k) << ef.bits | low


def ef_decode(ef: EliasFano) -> np.ndarray:
    """All numbers: every set bit selected at once."""
    if not ef.n:
        return np.zeros(0, np.uint64)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(ef.high, np.uint8), bitorder="little"))[:ef.n]
    out = (at - np.arange(ef.n)).astype(np.uint64) << np.uint64(ef.bits)
    low = np.unpackbits(np.frombuffer(ef.low, np.uint8), bitorder="little")[:ef.n * ef.bits].reshape(ef.n, ef.bits)
    for b in range(ef.bits):
        out |= low[:, b].astype(np.uint64) << np.uint64(b)
    return out


#: _PLACE[byte, k]: the place of the k-th set bit of a byte.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_PLACE = np.argsort(-_BITS, axis=1, kind="stable").astype(np.uint8)
_ONES = _BITS.sum(axis=1)


def ef_select_many(ef: EliasFano, ks: np.ndarray) -> np.ndarray:
    """The numbers at the positions ``ks`` (from 0), without decoding the others."""
    ks = np.asarray(ks, np.int64)
    if not len(ks):
        return np.zeros(0, np.uint64)
    if ks.min() < 0 or ks.max() >= ef.n:
        raise IndexError(f"positions are 0..{ef.n - 1}")
    high = np.frombuffer(ef.high, np.uint8)
    before = np.concatenate([[0], np.cumsum(_ONES[high])])
    byte = np.searchsorted(before, ks, side="right") - 1
    place = byte * 8 + _PLACE[high[byte], ks - before[byte]]
    out = (place - ks).astype(np.uint64) << np.uint64(ef.bits)
    low = np.frombuffer(ef.low, np.uint8)
    for b in range(ef.bits):
        at = ks * ef.bits + b
        out |= ((low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
    return out


def _segment(shard: int, number: int, ids: np.ndarray, ends: np.ndarray, docs: list, width: int) -> dict:
    null = sum(d is None for d in docs)
    known = np.array([d for d in docs if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    end = ef_encode(ends)
    doc = ef_encode(known.view(np.uint64) - np.uint64(base % (1 << 64)))
    return {"shard": shard, "segment": number, "n_docs": len(docs), "n_null": null, "n_tokens": len(ids), "width": width,
            "ids": ids.astype(f"<u{width}").tobytes(), "end_low": end.low, "end_high": end.high, "end_bits": end.bits,
            "end_sample": end.sample, "doc_base": base, "doc_low": doc.low, "doc_high": doc.high, "doc_bits": doc.bits,
            "doc_sample": doc.sample}


class _Encoder:
    """A tokenizer that encodes a distinct word once and remembers the words of late.

    Words are cut at white space, and behind an ASCII letter before any other ASCII character;
    A-Z is lower-cased.  Both change nothing for a tokenizer that lower-cases and never
    joins letters with other characters, unless a special token's text would be cut or made.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.largest = max(vocab.values())
        self.last = np.zeros(self.largest + 1, bool)  # ids that end a word
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = IdCache(self._made)

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words of the texts, and their number per text."""
        low = recode(texts, LOWER)
        size = np.asarray(pc.binary_length(low), dtype=np.int64)
        joined = b"".join(x.as_buffer() for x in low.cast(pa.binary()))
        plain = any(t in joined for t in self.special)
        if plain:
            joined = b"".join(x.as_buffer() for x in texts.cast(pa.binary()))
        raw = np.frombuffer(joined, np.uint8)
        space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
        cut = np.zeros(len(raw), bool)
        cut[1:] = space[1:] != space[:-1]
        if not plain:
            letter = (raw >= 0x61) & (raw <= 0x7A)
            cut[1:] |= letter[:-1] & ~letter[1:] & (raw[1:] < 0x80)
        first = np.cumsum(size) - size
        cut[first[size > 0]] = True
        at = np.flatnonzero(cut)
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(raw)])
        real = ~space[at]
        total = np.concatenate([[0], np.cumsum(real)])
        n = total[np.searchsorted(at, first + size)] - total[np.searchsorted(at, first)]
        return runs.filter(pa.array(real)), n

    def _made(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids.  Words of letters are encoded joined by spaces: each ends with
        one id of a word's end."""
        spelled = words.cast(pa.large_string())
        letters = np.asarray(pc.utf8_is_alpha(spelled))
        made = Made(len(words))
        at = np.flatnonzero(letters)
        lists = [at[k:k + _JOIN] for k in range(0, len(at), _JOIN)]
        joined = [" ".join(spelled.take(pa.array(some)).to_pylist()) for some in lists]
        for some, got in zip(lists, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(got.ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                made.put(some, np.diff(ends, prepend=0), ids)
            else:
                made.put_each(some, self._each(spelled, some))
        at = np.flatnonzero(~letters)
        for k in range(0, len(at), 2000):
            made.put_each(at[k:k + 2000], self._each(spelled, at[k:k + 2000]))
        return made.result()

    def _each(self, spelled: pa.Array, some: np.ndarray) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(spelled.take(pa.array(some)).to_pylist(), add_special_tokens=False)]


_KEPT: dict[str, _Encoder] = {}


def _encoder_of(tokenizer: str) -> _Encoder:
    """This worker's encoder; what it has learned outlives a task."""
    if tokenizer not in _KEPT:
        _KEPT.clear()
        _KEPT[tokenizer] = _Encoder(tokenizer)
    return _KEPT[tokenizer]


def _encode(column: pa.Array, encoder: _Encoder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each followed by the end id, and the id count of each text."""
    words, per_text = encoder.words(texts_of(column))
    coded = words.dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    begin, size, flat = encoder.known.lookup(coded.dictionary)
    n = size[codes] if len(codes) else codes
    total = np.concatenate([[0], np.cumsum(n)])
    ends = np.concatenate([[0], np.cumsum(per_text)])
    text_size = total[ends[1:]] - total[ends[:-1]] + 1
    # ids of the words in order, with a hole for the end id after every text
    text = np.repeat(np.arange(len(per_text)), per_text)
    put = np.arange(int(total[-1])) + np.repeat(text, n)
    out = np.full(int(total[-1]) + len(per_text), end_id, np.uint32)
    if len(codes):
        out[put] = runs(flat, begin[codes], begin[codes] + n)
    return out, text_size


def _segments(batches, tokenizer: str, end_id: int, segment: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encoder = _encoder_of(tokenizer)
    width = 2 if max(encoder.largest, end_id) < 1 << 16 else 4
    shard = TaskContext.get().partitionId()
    number, ids, sizes, docs, held = 0, [], [], [], 0

    def close():
        return _rows([_segment(shard, number, np.concatenate(ids), np.cumsum(np.concatenate(sizes)), docs, width)])

    for batch in batches:
        for part in parts(batch, "text", 4 << 20):
            made, size = _encode(part.column(1), encoder, end_id)
            ids.append(made)
            sizes.append(size)
            docs += part.column(0).to_pylist()
            held += len(made)
            if held >= segment:
                yield close()
                number, ids, sizes, docs, held = number + 1, [], [], [], 0
    if docs:
        yield close()


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_FIELDS = pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in SCHEMA.split(", "))])


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_FIELDS)


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 segment: int = SEGMENT) -> str:
    """Encode every text and write the segments to ``path``, documents in ascending id order (shard, segment)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the second key spreads rows that repeat one id over partitions; their order among each other is free
    dealt = (rows.withColumn("h", F.xxhash64("text")).repartitionByRange(shuffle_partitions(docs.sparkSession), "id", "h")
                 .sortWithinPartitions("id", "h").select("id", "text"))
    dealt.mapInArrow(lambda b: _segments(b, tokenizer.value, end_id, segment), SCHEMA).write.parquet(path)
    return path


def _ends(r) -> EliasFano:
    return EliasFano(r["n_docs"], r["end_bits"], r["end_low"], r["end_high"], r["end_sample"])


def _doc_ids(r) -> EliasFano:
    return EliasFano(r["n_docs"] - r["n_null"], r["doc_bits"], r["doc_low"], r["doc_high"], r["doc_sample"])


def segment_starts(segments: DataFrame, size: str = "n_tokens") -> DataFrame:
    """(shard, segment, first): ids (or documents) of all segments before each one."""
    sizes = segments.select("shard", "segment", F.col(size).cast("long").alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    # one row per shard (as many as the writing job had tasks)
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("shard").orderBy("segment")) - F.col("n")
    return sizes.join(before, "shard").select("shard", "segment", (F.col("before") + inside).alias("first"))


def _picked(batches, position: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            k = position - r["first"]
            begin = ef_select(_ends(r), k - 1) if k else 0
            end = ef_select(_ends(r), k)
            name = None if k < r["n_null"] else (ef_select(_doc_ids(r), k - r["n_null"]) + r["doc_base"] + (1 << 63)) % (1 << 64) - (1 << 63)
            ids = np.frombuffer(r["ids"], f"<u{r['width']}")[begin:end]
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([end - begin], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))],
                                             names=["doc_id", "n_tokens", "ids"])


def document_at(spark: SparkSession, path: str, position: int) -> DataFrame:
    """The document at ``position`` (from 0, ascending ids): two selects in one segment, nothing else is decoded."""
    segments = spark.read.schema(SCHEMA).parquet(path)
    rows = segments.join(segment_starts(segments, "n_docs"), ["shard", "segment"])
    one = rows.where((F.col("first") <= position) & (F.col("first") + F.col("n_docs") > position))
    return one.mapInArrow(lambda b: _picked(b, position), "doc_id long, n_tokens long, ids array<long>")


def _unpack(batches, crc: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ends = ef_select_many(_ends(r), np.arange(r["n_docs"])).astype(np.int64)
            doc = ef_decode(_doc_ids(r))
            doc = (doc + np.uint64(r["doc_base"] % (1 << 64))).view(np.int64)
            ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
            begin = np.concatenate([[0], ends[:-1]])
            names = pa.array([None] * r["n_null"] + doc.tolist(), pa.int64())
            if crc:
                value = pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), ends.tolist())], pa.int64())
            else:
                value = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([names, pa.array(begin + r["first"]), pa.array(ends - begin), value],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32" if crc else "ids"])


def read_tokens(spark: SparkSession, path: str, crc: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, and its ids (or their CRC-32)."""
    segments = spark.read.schema(SCHEMA).parquet(path)
    rows = segments.join(segment_starts(segments), ["shard", "segment"])
    return rows.mapInArrow(lambda b: _unpack(b, crc), "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if crc else "ids array<long>"))


def tokens_report(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """One row per document with the digest columns of the contract, from the files."""
    path = write_tokens(docs, tokenizer_path, shared_folder(docs.sparkSession), end_id)
    return read_tokens(docs.sparkSession, path, crc=True)
