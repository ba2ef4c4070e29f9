"""Vectorised word helpers used inside Arrow tasks.

A batch of texts is split by Arrow's own string kernels and dictionary-encoded, so
Python handles each distinct word of a batch once and numpy handles the positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
#: A-Z to a-z; every other ASCII byte that is no digit and no letter becomes a space.
FOLD = np.where((LOWER < 0x30) | ((LOWER > 0x39) & (LOWER < 0x61)) | ((LOWER > 0x7A) & (LOWER < 0x80)),
                0x20, LOWER).astype(np.uint8)


class Words(NamedTuple):
    """Words of a batch: ``vocab[codes[i]]`` is word i; text t owns words offsets[t]:offsets[t+1]."""

    vocab: pa.Array
    codes: np.ndarray
    offsets: np.ndarray


def texts_of(column: pa.Array) -> pa.Array:
    """The column as strings, null as the empty text."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def recode(texts: pa.Array, table: np.ndarray | None) -> pa.Array:
    """Replace every byte by its entry in a 256-entry table (offsets stay as they are)."""
    if table is None or not len(texts):
        return texts
    wide = pa.types.is_large_string(texts.type)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    made = pa.LargeStringArray if wide else pa.StringArray
    return made.from_buffers(len(texts), pa.py_buffer((off - off[0]).astype(kind)), pa.py_buffer(table[raw]))


def words_of(texts: pa.Array, table: np.ndarray | None = None) -> Words:
    """Split on runs of ``[\\x20\\x09-\\x0D]`` after recoding bytes."""
    split = pc.ascii_split_whitespace(recode(texts, table))
    flat, off = split.flatten(), np.asarray(split.offsets, dtype=np.int64)
    off = off - (off[0] if len(off) else 0)
    real = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    if not real.all():  # leading and trailing white space makes empty words
        before = np.concatenate([[0], np.cumsum(real)])
        flat, off = flat.filter(pa.array(real)), before[off]
    coded = flat.dictionary_encode()
    return Words(coded.dictionary, np.asarray(coded.indices, dtype=np.int64), off)


def hashes(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of every word's UTF-8 bytes."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in vocab.cast(pa.binary() if vocab.type == pa.string() else pa.large_binary()).to_pylist()),
                       dtype=np.uint64, count=len(vocab))


def parts(batch: pa.RecordBatch, text: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Zero-copy runs of rows whose texts together hold ``most_bytes`` at most (one row at least)."""
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text))
    size = np.asarray(pc.fill_null(pc.binary_length(texts_of(column)), 0), dtype=np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit factors."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def gram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n words from each position (positions 0..len-n), from word hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i, f in enumerate(odd_numbers(n, seed)):
        out += h[i:i + m] * f
    return mix(out)


def inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of the positions 0..len-n start n words of one text."""
    total = int(offsets[-1]) if len(offsets) else 0
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    left = np.repeat(offsets[1:], np.diff(offsets))[:m] - np.arange(m)
    return left >= n
