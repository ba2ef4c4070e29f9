"""Toxicity by class-conditional Kneser-Ney models.

One model per class, over whole words:

    P_c(w) = max(n_c(w) - D, 0) / n_c  +  D * N_c / n_c * K(w)
    K(w)   = distinct words before w in the texts of all documents (continuation counts), over the sum for all
             words that labelled rows have

n_c counts words of the class, N_c its distinct ones.  K is shared by the classes and needs no label, so an
expression that is rare in one class, or in labelled rows, gets there what it has in the language at large.
A toxic text is ordinary but for a few expressions, so its words are drawn from a mixture,

    P_toxic text(w) = (1 - e) * P_0(w) + e * P_1(w),

and the evidence m of a text of n words is the mean over them of ln P_toxic text(w) - ln P_0(w).  Its spread falls with the
length, so a logistic curve over m, m * sqrt(n) and ln n turns it into a score.  The curve and the share e are
fitted on labelled rows that gave no counts.
(With bigrams as a level above, held-out ranking was worse: most bigrams of labelled text occur once.)

Words: A-Z lower-cased, runs of ASCII letters, digits and characters above U+007F.  A run with characters
of scripts that are written without spaces counts as its overlapping pairs of characters.

A word that no labelled row has gets the same ratio of backoff weights whatever its K is; so the model is that
constant and one number for each distinct word of the labelled training rows.  ``LABELS`` bounds how many
of these rows are used, and with them what is broadcast; K is counted over every document.  Words before that no
labelled row has are told apart by a hash of 20 bits.

Edge cases: a null or wordless text gets the share of toxic training rows.  Several labels
of one id count as toxic if any is.  Null ids and null labels teach nothing.  Without rows of
both classes every score is that share (0 without any label).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_of, free_shuffles, with_arrow, written
from .words import FOLD, hashes, mix, parts, texts_of, words_of

LABELS = 1 << 18
DISCOUNT = 0.75
#: Shares of toxic expressions that are tried.
SHARES = (0.5, 0.2, 0.1, 0.05, 0.02, 0.01, 0.005, 0.002)
#: Thai to Myanmar, Khmer, and the ideographs, kana and their supplements.
_UNSPACED = "[\\x{0E00}-\\x{0EFF}\\x{1000}-\\x{109F}\\x{1780}-\\x{17FF}\\x{2E80}-\\x{A4CF}\\x{F900}-\\x{FAFF}\\x{FF66}-\\x{FF9F}\\x{20000}-\\x{3FFFF}]"
#: Bits of the hash that tells words before apart which no labelled row has.
_OTHERS = 20
#: Text of a bucket of pairs in bytes, bits by which the words before one word are spread, pairs sorted at once.
_BUCKET_BYTES, _SPREAD, _HELD = 8 << 20, 3, 1 << 22


class Model(NamedTuple):
    """Sorted hashes of the labelled words, ln P_1 / P_0 of each, that of all other words, the share e, the curve's
    weights (of m, m * sqrt(n), ln n and 1), the shortest and longest n it was fitted on, the share of toxic rows."""

    words: np.ndarray
    ratio: np.ndarray
    other: float
    mixed: float
    curve: tuple[float, ...]
    span: tuple[float, float]
    share: float


class Tokens(NamedTuple):
    """Distinct words' hashes, the word at every place, offsets of the texts."""

    hash: np.ndarray
    codes: np.ndarray
    offsets: np.ndarray


def tokens(texts: pa.Array) -> Tokens:
    w = words_of(texts, FOLD)
    dense = np.asarray(pc.match_substring_regex(w.vocab, _UNSPACED)) if len(w.vocab) else np.zeros(0, bool)
    if not dense.any():
        return Tokens(hashes(w.vocab), w.codes, w.offsets)
    # a run without spaces becomes its pairs of characters
    made, per_word = [], np.ones(len(w.vocab), np.int64)
    for i, (word, split) in enumerate(zip(w.vocab.to_pylist(), dense.tolist())):
        grams = [word[k:k + 2] for k in range(max(1, len(word) - 1))] if split else [word]
        per_word[i] = len(grams)
        made += grams
    coded = pa.array(made, pa.string()).dictionary_encode()
    gram = np.asarray(coded.indices, dtype=np.int64)
    first = np.cumsum(per_word) - per_word
    n = per_word[w.codes]
    total = np.concatenate([[0], np.cumsum(n)])
    take = np.arange(int(total[-1])) - np.repeat(total[:-1], n) + np.repeat(first[w.codes], n)
    return Tokens(hashes(coded.dictionary), gram[take], total[w.offsets])


def _texts(part: pa.RecordBatch, name: str = "text") -> pa.Array:
    return texts_of(part.column(part.schema.get_field_index(name)))


class _Layout(NamedTuple):
    """Where the bits of a pair go: of the word's number the low ``split`` bits and of the number before it the low ``_SPREAD``
    bits say the bucket, the rest is the pair's code in it.  So a word is in ``2**_SPREAD`` buckets, however frequent."""

    bits: int  # of a number
    split: int

    def key(self, number: np.ndarray, before: np.ndarray) -> np.ndarray:
        bucket = (number & ((1 << self.split) - 1)) << _SPREAD | before & ((1 << _SPREAD) - 1)
        return bucket << self.code_bits | (number >> self.split) << (self.bits - _SPREAD) | before >> _SPREAD

    @property
    def code_bits(self) -> int:
        return 2 * self.bits - self.split - _SPREAD

    def number(self, bucket: int, code: np.ndarray) -> np.ndarray:
        return (code >> (self.bits - _SPREAD)) << self.split | bucket >> _SPREAD


def _layout(n_words: int, text_bytes: int) -> _Layout:
    """Buckets follow the text, so that what a task holds of one does not."""
    bits = (n_words + 1 + (1 << _OTHERS)).bit_length()
    if 2 * bits > 62:
        raise ValueError("too many labelled words")
    buckets = max(1, text_bytes // _BUCKET_BYTES)
    return _Layout(bits, min(bits, max(0, buckets.bit_length() - _SPREAD)))


def packed(codes: np.ndarray) -> bytes:
    """Ascending codes as gaps, in planes of bytes, compressed."""
    planes = np.ascontiguousarray(np.diff(codes, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", 3).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=8 * n, asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, n).T).reshape(-1).view("<i8"))


def _pairs(batches, shared, layout: _Layout):
    """Every (labelled word, word before) of about ``_HELD`` once; those of a bucket are one row.  Frequent words have small
    numbers, so most gaps between the sorted pairs are short."""
    words, rank = shared.value
    held, size = [], 0

    def rows():
        key = np.unique(np.concatenate(held))
        bucket = key >> layout.code_bits
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        code = key & ((1 << layout.code_bits) - 1)
        ends = np.append(first[1:], len(key))
        for at in range(0, len(first), 1000):
            some = list(zip(first[at:at + 1000].tolist(), ends[at:at + 1000].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[first[at:at + 1000]]), pa.array([e - f for f, e in some], pa.int64()),
                 pa.array([packed(code[f:e]) for f, e in some], pa.binary())], names=["bucket", "n", "codes"])

    for batch in batches:
        for part in parts(batch, "text", 4 << 20):
            t = tokens(_texts(part))
            if not len(t.codes):
                continue
            at = np.minimum(np.searchsorted(words, t.hash), len(words) - 1)
            known = words[at] == t.hash
            number = np.where(known, rank[at], len(words) + 1 + (mix(t.hash) >> np.uint64(64 - _OTHERS)).astype(np.int64))[t.codes]
            before = np.concatenate([[0], number[:-1]])
            before[t.offsets[:-1][np.diff(t.offsets) > 0]] = len(words)  # the start of a text
            mine = known[t.codes]
            held.append(np.unique(layout.key(number[mine], before[mine])))
            size += len(held[-1])
            if size >= _HELD:
                yield from rows()
                held, size = [], 0
    if size:
        yield from rows()


def _distinct_before(group: pa.Table, layout: _Layout) -> pa.Table:
    """Distinct words before every word of a bucket."""
    bucket = group.column("bucket")[0].as_py()
    code, held, size = np.zeros(0, np.int64), [], 0
    for n, data in zip(group.column("n").to_pylist(), group.column("codes")):
        held.append(unpacked(data.as_py(), n))
        size += n
        if size >= _HELD:
            code, held, size = np.unique(np.concatenate([code, *held])), [], 0
    code = np.unique(np.concatenate([code, *held]))
    w, k = np.unique(layout.number(bucket, code), return_counts=True)
    return pa.table({"w": pa.array(w), "k": pa.array(k.astype(np.int64))})


def _class_counts(batches):
    for batch in batches:
        for part in parts(batch, "text", 4 << 20):
            t = tokens(_texts(part))
            toxic = np.repeat(np.asarray(part.column(part.schema.get_field_index("toxic"))), np.diff(t.offsets))
            n1 = np.bincount(t.codes, weights=toxic, minlength=len(t.hash)).astype(np.int64)
            n = np.bincount(t.codes, minlength=len(t.hash)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t.hash.view(np.int64)), pa.array(n - n1), pa.array(n1)], names=["h", "n0", "n1"])


def log_ratios(n0: np.ndarray, n1: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, float]:
    """ln P_1 / P_0 of the labelled words, whose continuation counts ``before`` is, and that of any other word."""
    again = (before + 0.5) / (before + 0.5).sum()
    weight = [DISCOUNT * (n > 0).sum() / n.sum() for n in (n0, n1)]
    p0, p1 = (np.maximum(n - DISCOUNT, 0) / n.sum() + w * again for n, w in zip((n0, n1), weight))
    return np.log(p1) - np.log(p0), float(np.log(weight[1]) - np.log(weight[0]))


def mixed_evidence(ratio: np.ndarray | float, share: float):
    """ln of what the mixture gives a word, over what the ordinary model gives it."""
    return np.logaddexp(np.log1p(-share), np.log(share) + ratio)


def fit(docs: DataFrame, labels: DataFrame, train: Column, tune: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_labels: int = LABELS) -> Model:
    """Count the language on all rows and the classes on labelled rows where ``train`` holds, fit the share and the curve
    where ``tune`` holds (both over the column ``id``)."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna()
                   .groupBy("id").agg(F.max("toxic").alias("toxic")).where(train | tune))
    n = marks.count()
    if n > max_labels:  # an even share of the ids, by hash
        marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(max_labels / n * (1 << 30)))
    # at most about max_labels rows of two numbers: that is what is broadcast
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    marks = written(marks)
    rows = docs.select(F.col(id_col).alias("id"), text).join(F.broadcast(marks), "id")
    counted, tuned = rows.where(train).select("text", "toxic"), rows.where(tune).select("text", "toxic")
    kinds = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    share = sum(k for t, k in kinds.items() if t) / max(1, sum(kinds.values()))

    # the distinct words of the labelled rows: what the model is, and what is broadcast
    known = (counted.mapInArrow(_class_counts, "h long, n0 long, n1 long").groupBy("h")
                    .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    free_shuffles(docs.sparkSession)
    h = known.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    words = h[order]
    n0, n1 = (known.column(c).to_numpy()[order].astype(float) for c in ("n0", "n1"))
    if not (n0.sum() and n1.sum()):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, 0.5, (0.0,) * 4, (1.0, 1.0), share)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(-(n0 + n1), kind="stable")] = np.arange(len(words))
    shared = docs.sparkSession.sparkContext.broadcast((words, rank))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    layout = _layout(len(words), size)
    pairs = docs.select(text).mapInArrow(lambda b: _pairs(b, shared, layout), "bucket long, n long, codes binary")
    k = (pairs.groupBy("bucket").applyInArrow(lambda g: _distinct_before(g, layout), "w long, k long")
              .groupBy("w").agg(F.sum("k").alias("k")).toArrow())
    before = np.zeros(len(words))
    before[k.column("w").to_numpy()] = k.column("k").to_numpy()
    before = before[rank]
    ratio, other = log_ratios(n0, n1, before)
    model = Model(words, ratio, other, 0.5, (1.0, 0.0, 0.0, 0.0), (1.0, 1.0), share)

    # the evidence of the tuning rows under every share: max_labels rows of a few numbers at most
    got = _evidence(tuned, model, "text", SHARES).where("words > 0").select("means", "words", "toxic").toArrow()
    if not got.num_rows:
        return model
    m = np.array(got.column("means").to_pylist(), float).reshape(got.num_rows, len(SHARES))
    n = got.column("words").to_numpy().astype(float)
    y = (got.column("toxic").to_numpy() > 0).astype(float)
    fits = [(*_logistic(np.stack([m[:, i], m[:, i] * np.sqrt(n), np.log(n)], axis=1), y), e) for i, e in enumerate(SHARES)]
    _, curve, mixed = min(fits)
    return model._replace(mixed=mixed, curve=curve, span=(float(n.min()), float(n.max())))


def _logistic(x: np.ndarray, y: np.ndarray, weak: float = 1e-3) -> tuple[float, tuple[float, ...]]:
    """Loss and weights (the constant last) of a logistic curve, by Newton steps on scaled x with a weak prior."""
    middle, width = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([(x - middle) / width, np.ones((len(x), 1))])
    b = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + weak * np.eye(len(b)), z.T @ (y - p) - weak * b)
        b += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    at = z @ b
    loss = float(np.mean(np.logaddexp(0, at) - y * at))
    own = b[:-1] / width
    return loss, (*map(float, own), float(b[-1] - own @ middle))


def _evidence(docs: DataFrame, model: Model, text_col: str, shares: tuple[float, ...] = (), drop_text: bool = True) -> DataFrame:
    """``docs`` with ``words``, their number, and ``mean``, the length-normalised evidence (null without words), or ``means``,
    one for each of ``shares``."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def start():
        m = Model(*shared.value)
        own = [(mixed_evidence(m.ratio, e), float(mixed_evidence(m.other, e))) for e in shares or (m.mixed,)]

        def made(part):
            t = tokens(_texts(part, text_col))
            n = np.diff(t.offsets)
            at = np.minimum(np.searchsorted(m.words, t.hash), max(len(m.words) - 1, 0))
            known = m.words[at] == t.hash if len(m.words) else np.zeros(len(t.hash), bool)
            means = []
            for value, other in own:
                word = np.where(known, value[at], other) if len(m.words) else np.zeros(len(t.hash))
                total = np.concatenate([[0.0], np.cumsum(word[t.codes])]) if len(t.codes) else np.zeros(1)
                means.append((total[t.offsets[1:]] - total[t.offsets[:-1]]) / np.maximum(n, 1))
            number = pa.array(n, pa.int64())
            if not shares:
                return [pa.array(means[0], mask=n == 0), number]
            return [pa.array(np.stack(means, axis=1).tolist(), pa.list_(pa.float64())), number]
        return made

    field = T.StructField("means", T.ArrayType(T.DoubleType())) if shares else T.StructField("mean", T.DoubleType())
    return with_arrow(docs, text_col, start, [field, T.StructField("words", T.LongType())], drop_text=drop_text)


def score(docs: DataFrame, model: Model, text_col: str = "text", drop_text: bool = True) -> DataFrame:
    """``docs`` with ``mean``, ``words`` and ``score`` (0 to 1)."""
    got = _evidence(docs, model, text_col, drop_text=drop_text)
    a, b, c, d = model.curve
    # a text shorter or longer than all that the curve was fitted on counts as the nearest of them
    m, n = F.col("mean"), F.least(F.greatest(F.col("words").cast("double"), F.lit(model.span[0])), F.lit(model.span[1]))
    curve = 1 / (1 + F.exp(-(m * a + m * F.sqrt(n) * b + F.ln(n) * c + d)))
    return got.withColumn("score", F.coalesce(curve, F.lit(model.share)) if len(model.words) else F.lit(model.share))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with the digest columns of the contract."""
    fold = crc32_of("id") % 5
    model = fit(docs, labels, train=fold.between(1, 3), tune=fold == 4)
    got = score(docs.select("doc_id", "text"), model)
    return got.select("doc_id", (crc32_of("doc_id") % 5 == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
