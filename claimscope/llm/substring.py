"""Substring deduplication by seed and extend over words.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]``, unchanged.

* Seeds: each window of ``WINDOW`` words is represented by the smallest hash of its
  ``ANCHOR``-word sequences (winnowing, the leftmost on ties).  Windows with the same
  words choose the same anchor, so a repeated window always has an anchor that occurs in
  two documents.
* Join: anchors of two documents or more, found by one aggregate, become a bit array of
  bounded size (a runtime filter: a bit too many only costs work).
* Extend: an anchor in the filter is extended to every window around it that it
  represents; these windows are joined on their hash to the smallest document in which
  they start.
* Maximal repeats: the words of adjoining windows owned by an earlier document are one
  run, removed from the text.

A hot passage is aggregated before each shuffle, and the join back to its occurrences is
one that Spark can split.  Documents that own all their windows are never shuffled.
Windows are compared by a 64-bit hash.

Edge cases: a null text has no words.  A document of fewer words than a window keeps all.
Rows that repeat an id are one document to the comparison (the smallest id owns a window;
rows of one id never remove words from each other) and are all returned, each without its own
text's repeats: positions belong to an id and a text (by its 64-bit hash, carried for the ids with
several texts).  A null id comes after every other id; rows with null ids count as one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_filter, free_name, free_shuffles, maybe_in, text_hash, with_arrow, written
from .words import gram_hashes, hashes, inside, parts, texts_of, words_of

#: Words of a window, the shortest repeat that is removed.
WINDOW = 13
#: Words of an anchor.
ANCHOR = 5

_LAST_ID = (1 << 63) - 1
_KEPT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                      T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType()),
                      T.StructField("repeats", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                                         T.StructField("end", T.LongType())])))])


def _id(column: str):
    return F.coalesce(F.col(column).cast("long"), F.lit(_LAST_ID))


def _anchors(column: pa.Array, window: int, anchor: int):
    """Word offsets; per window start: whether it is inside one text, its hash, its anchor's hash."""
    w = words_of(texts_of(column))
    h = hashes(w.vocab)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
    ok = inside(w.offsets, window)
    grams = gram_hashes(h, anchor, seed=1)
    least = grams[:len(ok)].copy()
    for i in range(1, window - anchor + 1):
        np.minimum(least, grams[i:i + len(ok)], out=least)
    return w, ok, gram_hashes(h, window, seed=2), least


def _emit_anchors(batches, window: int, anchor: int):
    for batch in batches:
        for part in parts(batch, "text"):
            w, ok, _, least = _anchors(part.column(1), window, anchor)
            doc = np.repeat(np.asarray(part.column(0)), np.diff(w.offsets))[:len(ok)]
            least, doc = least[ok], doc[ok]
            # a run of windows shares its anchor: one row a run is enough
            new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])]) if len(least) else ok[:0]
            yield pa.RecordBatch.from_arrays([pa.array(least[new].view(np.int64)), pa.array(doc[new])], names=["h", "doc"])


def _tags(several, mask: int, id_hash: pa.Array, own: pa.Array, one: pa.Array) -> np.ndarray:
    """Entries of ``own`` for rows whose id may have several texts, of ``one`` for the others."""
    may = maybe_in(several.value, mask, id_hash.to_numpy().view(np.uint64))
    return np.where(may, own.to_numpy(), one.to_numpy())


def _emit_windows(batches, seeds, mask: int, several, id_mask: int, window: int, anchor: int):
    for batch in batches:
        for part in parts(batch, "text"):
            w, ok, win, least = _anchors(part.column(1), window, anchor)
            tag = _tags(several, id_mask, part.column(2), part.column(3), pa.array(np.zeros(part.num_rows, np.int64)))
            at = np.flatnonzero(ok & maybe_in(seeds.value, mask, least)) if len(ok) else np.zeros(0, np.int64)
            text = np.searchsorted(w.offsets, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(win[at].view(np.int64)), pa.array(np.asarray(part.column(0))[text]), pa.array(tag[text]),
                 pa.array((at - w.offsets[text]).astype(np.int32))], names=["h", "doc", "tag", "pos"])


def ids_with_several_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """A ``bit_filter`` over the hashes of ids whose rows differ in their text."""
    ids = docs.select(_id(id_col).alias("id"), text_hash(text_col).alias("t")).groupBy("id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return bit_filter(written(ids.where("a <> b").select(F.xxhash64("id").alias("h"))), "h")


def repeated_windows(docs: DataFrame, several, id_mask: int, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     anchor: int = ANCHOR) -> DataFrame:
    """(doc, tag, pos): windows that also start in a document with a smaller id, positions in words.

    ``several`` and ``id_mask`` are those of ``ids_with_several_texts``; ``tag`` is the text's hash for these ids, else 0.
    """
    spark = docs.sparkSession
    base = docs.select(_id(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seeds = (base.mapInArrow(lambda b: _emit_anchors(b, window, anchor), "h long, doc long")
                 .groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("h"))
    found, mask = bit_filter(written(seeds), "h")
    free_shuffles(spark)
    tagged = base.select("id", "text", F.xxhash64("id").alias("id_hash"), text_hash("text").alias("text_hash"))
    wins = tagged.mapInArrow(lambda b: _emit_windows(b, found, mask, several, id_mask, window, anchor), "h long, doc long, tag long, pos int")
    # a table of its own: Spark can then split the rows of a very common window in the join
    owner = written(wins.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b")
                        .select("h", F.col("a").alias("owner")))
    free_shuffles(spark)
    return wins.join(owner, "h").where("doc > owner").select("doc", "tag", "pos")


def _cut(text: str, starts, window: int, texts: bool) -> tuple:
    words = text.encode().split()
    gone = np.zeros(len(words) + 1, np.int32)
    s = np.asarray(starts, np.int64)
    s = s[s + window <= len(words)]
    np.add.at(gone, s, 1)
    np.add.at(gone, s + window, -1)
    out = np.cumsum(gone[:-1]) > 0
    kept = b" ".join([x for x, o in zip(words, out) if not o]) if out.any() else b" ".join(words)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
    runs = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
    return len(words), int(out.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None, runs


def _with_cuts(df: DataFrame, text_col: str, starts_col: str | None, out: str, window: int, texts: bool, drop: bool) -> DataFrame:
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string()),
                      ("repeats", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    names = [f.name for f in _KEPT]

    def start():
        def made(part):
            text = texts_of(part.column(part.schema.get_field_index(text_col)))
            starts = part.column(part.schema.get_field_index(starts_col)) if starts_col else None
            rows = []
            for i in range(len(text)):
                at = starts[i].values.to_numpy() if starts is not None and starts[i].is_valid else ()
                rows.append(dict(zip(names, _cut(text[i].as_py(), at, window, texts))))
            return [pa.array(rows, kind)]
        return made

    return with_arrow(df, text_col, start, [T.StructField(out, _KEPT)], drop_text=drop)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    anchor: int = ANCHOR, out: str = "cut", texts: bool = True, drop_text: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out``: words, removed words, hash and text of what is kept, removed runs."""
    spark = docs.sparkSession
    key, at, tag, flag = (free_name(docs.columns, c) for c in ("doc_key", "starts", "doc_tag", "maybe"))
    id_h, text_h, one_h, own_h = extra = [free_name(docs.columns, c) for c in ("id_hash", "text_hash", "one_hash", "own_hash")]
    several, id_mask = ids_with_several_texts(docs, id_col, text_col)
    free_shuffles(spark)
    # a set: equal rows have equal positions
    starts = written(repeated_windows(docs, several, id_mask, id_col, text_col, window, anchor)
                     .groupBy("doc", "tag").agg(F.collect_set("pos").alias(at)).withColumnsRenamed({"doc": key, "tag": tag}))
    free_shuffles(spark)
    hit, mask = bit_filter(starts.select(F.xxhash64(key, tag).alias("h")), "h")
    keyed = (docs.withColumn(key, _id(id_col)).withColumn(id_h, F.xxhash64(key)).withColumn(text_h, text_hash(text_col))
                 .withColumn(one_h, F.xxhash64(key, F.lit(0).cast("long"))).withColumn(own_h, F.xxhash64(key, text_h)))

    def start():
        def made(part):
            ids, text, one, own = (part.column(part.schema.get_field_index(c)) for c in extra)
            of_row = _tags(several, id_mask, ids, text, pa.array(np.zeros(part.num_rows, np.int64)))
            return [pa.array(maybe_in(hit.value, mask, _tags(several, id_mask, ids, own, one).view(np.uint64))), pa.array(of_row)]
        return made

    marked = with_arrow(keyed, text_col, start, [T.StructField(flag, T.BooleanType()), T.StructField(tag, T.LongType())]).drop(*extra)
    columns = [c for c in docs.columns if not (drop_text and c == text_col)]
    whole = _with_cuts(marked.where(~F.col(flag)).select(*docs.columns), text_col, None, out, window, texts, drop_text)
    joined = marked.where(F.col(flag)).drop(flag).join(starts, [key, tag], "left").drop(key, tag)
    some = _with_cuts(joined, text_col, at, out, window, texts, drop_text)
    return whole.select(*columns, out).unionByName(some.select(*columns, out))


def substring_report(docs: DataFrame) -> DataFrame:
    """One row per document with the digest columns of the contract."""
    cut = substring_dedup(docs.select("doc_id", "text"), texts=False, drop_text=True)
    return cut.select("doc_id", "cut.n_words", "cut.n_removed", "cut.kept_sha256")
