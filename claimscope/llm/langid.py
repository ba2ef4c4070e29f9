"""Language identification by nearest centroid over TF-IDF n-gram vectors.

A text becomes lower case, everything that is an ASCII non-letter a space, runs of spaces
one space.  Its byte 2-grams and 3-grams are hashed to ``DIMS`` dimensions; the vector is
(1 + ln tf) * idf, scaled to length one.  Each language has ``CLUSTERS`` centroids (spherical
k-means); a text gets the language of the centroid with the largest cosine and is rejected
when that cosine is 0 or below the language's limit (its distance is too large).

The limit is the ``REJECT`` quantile of the cosines of the language's own sampled texts to centroids fitted
without them (``FOLDS`` parts, each held out once), so about that share of new texts of a learned
language is rejected wrongly.  Below 1 / ``REJECT`` texts it lies between 0 and the smallest cosine, in
proportion to their number; a lone text is compared with itself.

Counts: documents and document frequencies cover all training rows.  The centroids are
fitted on a sample of ``SAMPLE`` distinct texts per language (all, if it has no more), those with
the smallest mixed hashes; that bound is the operator's parameter ``sample``.  Copies count once.

Edge cases: a text that is null or has no letter is ``und``, score 0 and rejected, as is
every text when nothing was learned.  Training rows with a null language or a text without a
letter are not used.  Ties go to the language that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_of, free_name, with_arrow
from .words import parts, recode, texts_of

DIMS = 4096
CLUSTERS = 4
SAMPLE = 2000
#: Share of a learned language's own new texts that its limit rejects.
REJECT = 0.005
#: Parts of a sample, each compared with centroids of the others.
FOLDS = 5
#: A letter, for Java's regular expressions and Arrow's.
_LETTER = r"\p{L}"
UNKNOWN = "und"
_ROWS = 256
_BYTES = np.arange(256, dtype=np.uint8)
_LETTERS = np.where(((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80), _BYTES, 0x20).astype(np.uint8)


def _counts(texts: pa.Array, dims: int):
    """n-gram counts, a (rows, dims) array for every ``_ROWS`` texts, with the number of the first."""
    low = recode(pc.utf8_lower(texts), _LETTERS)
    for at in range(0, len(low), _ROWS):
        some = low.slice(at, _ROWS)
        size = np.asarray(pc.binary_length(some), dtype=np.int64)
        # a space before and after every text
        raw = np.full(int(size.sum()) + 2 * len(size), 0x20, np.uint8)
        row = np.repeat(np.arange(len(size)), size + 2)
        start = np.cumsum(size + 2) - (size + 2)
        text = np.ones(len(raw), bool)
        text[start] = text[start + size + 1] = False
        raw[text] = np.frombuffer(b"".join(x.encode() for x in some.to_pylist()), np.uint8)
        keep = np.ones(len(raw), bool)
        keep[1:] = (raw[1:] != 0x20) | (raw[:-1] != 0x20) | (row[1:] != row[:-1])
        raw, row = raw[keep].astype(np.uint64), row[keep]
        out = np.zeros(len(size) * dims, np.float32)
        for n in (2, 3):
            if len(raw) < n:
                continue
            key = np.full(len(raw) - n + 1, n, np.uint64)
            for i in range(n):
                key = (key << np.uint64(8)) | raw[i:len(raw) - n + 1 + i]
            same = row[:len(key)] == row[n - 1:]
            slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % dims
            out += np.bincount((row[:len(key)] * dims + slot)[same], minlength=len(out))
        yield at, out.reshape(len(size), dims)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    seen = counts > 0
    v = np.zeros_like(counts)
    np.log(counts, out=v, where=seen)
    v = (v + seen) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norm, out=v, where=norm > 0)


def _frequencies(batches, dims: int):
    total, df = 0, np.zeros(dims, np.int64)
    for batch in batches:
        for part in parts(batch, "text"):
            total += part.num_rows
            for _, c in _counts(texts_of(part.column(0)), dims):
                df += (c > 0).sum(axis=0)
    slot = np.concatenate([[-1], np.flatnonzero(df)])
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.concatenate([[total], df[slot[1:]]]))], names=["slot", "n"])


def _first_texts(batches):
    """The first row of every (lang, h) of a task."""
    seen = set()
    for batch in batches:
        new = []
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if key not in seen:
                seen.add(key)
                new.append(i)
        if new:
            yield batch.take(pa.array(new))


def _centroids(x: np.ndarray, clusters: int) -> np.ndarray:
    """Spherical k-means, with k-means++ starts from a fixed seed."""
    rng = np.random.default_rng(0)
    chosen = [int(rng.integers(len(x)))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(clusters, len(x)):
        far = np.maximum(1 - near, 0.0).astype(np.float64)
        if not far.sum() > 1e-9:
            break
        chosen.append(int(rng.choice(len(x), p=far / far.sum())))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen].copy()
    for _ in range(12):
        of = np.argmax(x @ c.T, axis=1)
        for k in range(len(c)):
            if (of == k).any():
                m = x[of == k].sum(axis=0)
                c[k] = m / max(float(np.sqrt(m @ m)), 1e-12)
    return c


def _limit(x: np.ndarray, clusters: int, reject: float) -> float:
    """The cosine below which a share ``reject`` of texts like those of ``x`` lies, none of them compared with its own centroids."""
    cos = np.ones(1)
    if len(x) > 1:
        cos, fold = np.zeros(len(x)), np.arange(len(x)) % min(FOLDS, len(x))
        for k in range(min(FOLDS, len(x))):
            cos[fold == k] = (x[fold == k] @ _centroids(x[fold != k], clusters).T).max(axis=1)
    # a new text is equally likely between any two of them; a cosine is never below 0
    return float(np.interp(reject * (len(cos) + 1), np.arange(len(cos) + 1), np.append(0.0, np.sort(cos))))


def _clusters(table: pa.Table, clusters: int, sample: int, reject: float) -> pa.Table:
    """Centroids and limit of one language's sample."""
    order = np.lexsort((table.column("h").to_numpy(), table.column("m").to_numpy()))[:sample]
    x = np.stack([np.frombuffer(table.column("v")[int(i)].as_buffer(), np.float32) for i in order])
    c, limit = _centroids(x, clusters), _limit(x, clusters, reject)
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(c), pa.string()), "c": pa.array([k.astype(np.float32).tobytes() for k in c], pa.binary()),
                     "low": pa.array([limit] * len(c), pa.float64())})


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = DIMS, clusters: int = CLUSTERS,
        sample: int = SAMPLE, reject: float = REJECT) -> dict:
    """A model of bounded size: idf, and per language its centroids and its limit."""
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(_LETTER)).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    df = rows.select("text").mapInArrow(lambda b: _frequencies(b, dims), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    counts = {r.slot: r.n for r in df}
    total = counts.pop(-1, 0)
    have = np.zeros(dims)
    for k, n in counts.items():
        have[k] = n
    idf = (np.log((1 + total) / (1 + have)) + 1).astype(np.float32)
    # equal texts have equal hashes: copies neither fill a sample nor lower its share
    rows = rows.withColumn("h", F.xxhash64("text"))
    langs = rows.select("lang", "h").distinct().groupBy("lang").count().collect()
    if not langs:
        return {"idf": idf, "langs": [], "c": np.zeros((0, dims), np.float32), "low": np.zeros(0)}
    # ten standard deviations above `sample`; _clusters takes the smallest of them
    wanted = sample + 10 * (sample + 1) ** 0.5
    share = F.create_map(*[F.lit(v) for r in langs for v in (r["lang"], min(1.0, wanted / r["count"]))])
    mixed = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    picked = rows.withColumn("m", mixed).where(F.col("m") < F.element_at(share, F.col("lang")) * (1 << 30)).select("lang", "h", "m", "text")
    # one row a task before the shuffle, so the copies of a text stay where they are read
    picked = picked.mapInArrow(_first_texts, picked.schema).dropDuplicates(["lang", "h"])

    def vectors():
        def made(part):
            out = [v.tobytes() for _, c in _counts(texts_of(part.column(3)), dims) for v in _vectors(c, idf)]
            return [pa.array(out, pa.binary())]
        return made

    vecs = with_arrow(picked, "text", vectors, [T.StructField("v", T.BinaryType())], drop_text=True)
    made = vecs.groupBy("lang").applyInArrow(lambda t: _clusters(t, clusters, sample, reject), "lang string, c binary, low double").toArrow().sort_by("lang")
    return {"idf": idf, "langs": made.column("lang").to_pylist(), "low": made.column("low").to_numpy(),
            "c": np.stack([np.frombuffer(c, np.float32) for c in made.column("c").to_pylist()])}


_GUESS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("rejected", T.BooleanType())])


def identify(docs: DataFrame, model: dict, text_col: str = "text", out: str = "guess", drop_text: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out``: language, cosine, and whether the text is too far from every centroid."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        names = np.array([*m["langs"], UNKNOWN], object)
        low = np.append(m["low"], 2.0)

        def made(part):
            texts = texts_of(part.column(part.schema.get_field_index(text_col)))
            letters = np.asarray(pc.match_substring_regex(texts, _LETTER))
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            if len(m["langs"]):
                for at, c in _counts(texts, len(m["idf"])):
                    cos = _vectors(c, m["idf"]) @ m["c"].T
                    best[at:at + len(c)] = np.argmax(cos, axis=1)
                    score[at:at + len(c)] = cos.max(axis=1)
            best = np.where(letters, best, -1)
            score = np.where(best >= 0, np.clip(score, 0.0, 1.0), 0.0)
            return [pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array((score < low[best]) | (score <= 0))],
                                               names=[f.name for f in _GUESS])]
        return made

    return with_arrow(docs, text_col, start, [T.StructField(out, _GUESS)], drop_text=drop_text)


def held_out(id_col: str = "doc_id") -> Column:
    """The contract's held-out fold."""
    return crc32_of(id_col) % 4 == 2


def keep_identified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    guess = free_name(docs.columns, "guess")
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col)
    return identify(docs, model, text_col, guess).where(~F.col(f"{guess}.rejected")).select(*docs.columns)


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document with the digest columns of the contract."""
    model = fit(docs.where(~held_out()))
    got = identify(docs.select("doc_id", "text"), model, drop_text=True)
    return got.select("doc_id", held_out().alias("held_out"), "guess.lang_pred", "guess.score", "guess.rejected")
