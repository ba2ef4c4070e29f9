"""Benchmark decontamination with suffix arrays over the training text.

Every task turns its documents into shards (word sequences of a few MB), sorts the
suffixes of a shard by prefix doubling and binary-searches every suffix of the
benchmark in it.  The benchmark is the query set: it is broadcast in blocks of bounded
size, and each shard works through the blocks, so no document is shuffled and nothing
depends on how often a passage occurs.

Words: A-Z is lower-cased, then runs of ASCII letters, digits and characters above
U+007F.  A window is 13 consecutive words of an item; an item of fewer words, but not
none, is one window.  Adjoining matches on one diagonal join to the longest match.

Edge cases: a null text has no words.  An item without words has no window.  An item
with a null id still marks words, but is counted in no item list.  Items with equal ids
count once.  An empty benchmark leaves every document clean.  Repeated documents are
judged row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, lists, sha256_hex, with_arrow
from .words import FOLD, texts_of, words_of

#: Words of a window.
WINDOW = 13
#: Benchmark text per broadcast block, in bytes.
BLOCK_BYTES = 32 << 20

MATCH = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("doc_start", T.LongType()),
                      T.StructField("item_start", T.LongType()), T.StructField("n_words", T.LongType())])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                      T.StructField("items", T.ArrayType(T.StringType())),
                      T.StructField("matches", T.ArrayType(MATCH))])


def item_blocks(bench: DataFrame, id_col: str, text_col: str, window: int = WINDOW,
                block_bytes: int = BLOCK_BYTES) -> list:
    """The benchmark's windows, as one broadcast for every ``block_bytes`` of its text."""
    spark, out, ids, texts, size = bench.sparkSession, [], [], [], 0

    def close():
        if texts:
            out.append(spark.sparkContext.broadcast(_windows(ids, texts, window)))

    for item, text in bench.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))).toLocalIterator():
        ids.append(item)
        texts.append(text)
        size += len(text)
        if size >= block_bytes:
            close()
            ids, texts, size = [], [], 0
    close()
    return out


def _windows(ids: list, texts: list[str], window: int) -> tuple:
    """(item ids, vocabulary, item of a window, its position, its length, its word codes)."""
    w = words_of(pa.array(texts, pa.string()), FOLD)
    n = np.diff(w.offsets)
    per_item = np.where(n >= window, n - window + 1, (n > 0).astype(np.int64))
    item = np.repeat(np.arange(len(n)), per_item)
    pos = np.arange(len(item)) - np.repeat(np.cumsum(per_item) - per_item, per_item)
    length = np.minimum(n[item], window)
    grid = np.arange(window)
    at = (w.offsets[item] + pos)[:, None] + grid
    codes = np.where(grid < length[:, None], w.codes[np.minimum(at, max(len(w.codes) - 1, 0))] if len(w.codes) else 0, -1)
    return ids, w.vocab.to_pylist(), item, pos, length, codes


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``s`` sorted by the ``depth`` symbols from each (prefix doubling on packed ranks)."""
    rank, have = s.astype(np.int64), 1
    while True:
        top = int(rank.max()) + 1
        fold = max(2, min(8, 62 // top.bit_length()))
        key = rank.copy()
        for i in range(1, fold):
            key *= top
            key[:max(0, len(key) - i * have)] += rank[i * have:]
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty_like(key)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        have *= fold
        if have >= depth:
            return order


def search(s: np.ndarray, order: np.ndarray, patterns: np.ndarray, length: np.ndarray, after: bool) -> np.ndarray:
    """For each pattern, how many suffixes sort before it (``after``: before it or starting with it)."""
    lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(order), np.int64)
    while (live := lo < hi).any():
        mid = (lo + hi) >> 1
        at = order[np.minimum(mid, len(order) - 1)]
        below, decided = np.zeros(len(lo), bool), np.zeros(len(lo), bool)
        for j in range(patterns.shape[1]):
            here = ~decided & (j < length)
            symbol = s[np.minimum(at + j, len(s) - 1)] * (at + j < len(s))
            below |= here & (symbol < patterns[:, j])
            decided |= here & (symbol != patterns[:, j])
        right = below | (after & ~decided)
        lo, hi = np.where(live & right, mid + 1, lo), np.where(live & ~right, mid, hi)
    return lo


def _find(column: pa.Array, blocks: list, window: int) -> pa.Array:
    w = words_of(texts_of(column), FOLD)
    n = np.diff(w.offsets)
    n_texts = len(n)
    text_of_word = np.repeat(np.arange(n_texts), n)
    # one separator (0) after every text, so that no match runs on into the next
    s = np.zeros(len(w.codes) + n_texts, np.int64)
    s[np.arange(len(w.codes)) + text_of_word] = w.codes + 1
    starts = w.offsets[:-1] + np.arange(n_texts)
    code_of = None
    hit = np.zeros(len(s) + 1, np.int64)
    found: list[tuple] = []
    if len(w.codes):
        order = None
        for block in blocks:
            ids, vocab, item, pos, length, codes = block.value
            if code_of is None:
                code_of = {x: i + 1 for i, x in enumerate(w.vocab.to_pylist())}
            local = np.array([code_of.get(x, -1) for x in vocab] + [-1], np.int64)[codes]
            known = ((local > 0) | (np.arange(window) >= length[:, None])).all(axis=1)
            if not known.any():
                continue
            if order is None:
                order = suffix_order(s, window)
            item, pos, length, local = item[known], pos[known], length[known], local[known]
            lo, hi = search(s, order, local, length, False), search(s, order, local, length, True)
            times = hi - lo
            which = np.repeat(np.arange(len(times)), times)
            at = order[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + length[which], -1)
            found.append(_diagonals(at, item[which], pos[which], length[which], ids, starts))
    covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
    n_hit = covered[starts + n] - covered[starts]
    doc, name, doc_start, item_start, n_match = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [[]] * 5))
    by = np.argsort(doc, kind="stable")
    per_doc = np.bincount(doc.astype(np.int64), minlength=n_texts)
    names = name[by] if len(by) else np.zeros(0, object)
    cuts = np.concatenate([[0], np.cumsum(per_doc)])
    items = [sorted({x for x in names[a:b] if x is not None}) for a, b in zip(cuts[:-1], cuts[1:])]
    matches = pa.StructArray.from_arrays(
        [pa.array(list(names), pa.string()), *(pa.array(x[by].astype(np.int64), pa.int64()) for x in (doc_start, item_start, n_match))],
        names=[f.name for f in MATCH])
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), lists(matches, per_doc)],
        names=[f.name for f in FOUND])


def _diagonals(at, item, pos, length, ids, starts) -> tuple:
    """Join window hits that follow each other in both text and item into longest matches."""
    text = np.searchsorted(starts, at, side="right") - 1
    by = np.lexsort((at, at - pos, item))
    at, item, pos, length, text = at[by], item[by], pos[by], length[by], text[by]
    if len(at):
        follows = (item[1:] == item[:-1]) & (at[1:] == at[:-1] + 1) & (pos[1:] == pos[:-1] + 1)
        first = np.flatnonzero(np.concatenate([[True], ~follows]))
        last = np.append(first[1:], len(at)) - 1
    else:
        first = last = np.zeros(0, np.int64)
    names = np.empty(len(ids), object)
    names[:] = ids
    return text[first], names[item[first]], at[first] - starts[text[first]], pos[first], at[last] + length[last] - at[first]


def find_matches(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, out: str = "found") -> DataFrame:
    """``docs`` with a struct column ``out``: words, hit words, sorted items found, longest matches."""
    blocks = item_blocks(bench, item_col, item_text_col, window)

    def start():
        return lambda part: [_find(part.column(part.schema.get_field_index(text_col)), blocks, window)]

    return with_arrow(docs, text_col, start, [T.StructField(out, FOUND)])


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the document's words are benchmark words."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = free_name(docs.columns, "found")
    marked = find_matches(docs, bench, text_col, out=found)
    return marked.where(~contaminated(F.col(f"{found}.n_hit"), F.col(f"{found}.n_words"))).select(*docs.columns)


def decontamination_report(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """One row per document with the digest columns of the contract."""
    found = find_matches(docs.select("doc_id", "text"), bench.select("item_id", "text"))
    n_words, n_hit, items = (F.col(f"found.{c}") for c in ("n_words", "n_hit", "items"))
    return found.select("doc_id", n_words.alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        sha256_hex(F.array_join(items, ",")).alias("items_sha256"),
                        contaminated(n_hit, n_words).alias("contaminated"))
