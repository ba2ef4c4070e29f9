"""Phrase collocation mining: counts of all phrases by marginalising the longest windows.

A-Z is lower-cased; texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]``, and those into words
``[^\\x20\\x09]+``.  All counts are per language (null: ``und``).

1. One pass gives the words of every language and, as 64-bit hashes, the pairs of adjoining words, both
   counted.  A pair below ``least`` occurrences is in no candidate.
2. The second pass makes the longest window from every word: the word and its leads, up to ``longest``
   words, padded with null behind the piece's end or behind the first pair that is too rare.
   Equal windows are counted; shorter phrases get no rows of their own.
3. ``ROLLUP`` over the window's columns sums the counts of every shorter prefix.  Since all
   occurrences of a phrase with ``least`` or more of them are prefixes of such windows, its sum is exact.
   (The pairs that the second pass keeps come from a bit array that may say yes too often; a rare
   phrase then gets a sum below ``least`` and goes.)
4. Candidates are joined to the counts of both parts of every cut; the lowest score stays.  Phrases
   inside a longer candidate with nearly all of their occurrences go.  The first ``top`` of every language
   are found by a group-limited rank before words are joined back.

Words travel as a 64-bit hash of language and word.  The table of distinct words shows whether two of them
share a hash; then the pass is made again with another seed, so results are exact.
Products are decimals.

Edge cases: a null or empty text has no words.  Rows that repeat count as often as they stand there.
No documents or no frequent phrase: no rows.  A language of ``und`` and a null one are the same.  Other
columns are not read.  A piece without spaces, however long, is one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_filter, maybe_in, written
from .words import LOWER, hashes, mix, odd_numbers, parts, recode, texts_of

#: Text that a task counts at once.
_PART = 3 << 20

_BYTES = np.arange(256)
_BREAK = np.isin(_BYTES, list(b".,;:!?")) | ((_BYTES >= 0x0A) & (_BYTES <= 0x0D))
_GAP = _BREAK | (_BYTES == 0x20) | (_BYTES == 0x09)


class PieceWords(NamedTuple):
    """Word i is ``vocab[codes[i]]``, of text ``text[i]``; words of one piece have the same ``piece``."""

    vocab: pa.Array
    codes: np.ndarray
    text: np.ndarray
    piece: np.ndarray


def piece_words(texts: pa.Array) -> PieceWords:
    low = recode(texts, LOWER)
    data = [x.as_buffer() for x in low.cast(pa.large_binary())]
    size = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8)
    gap = _GAP[raw]
    first = np.cumsum(size) - size
    cut = np.zeros(len(raw), bool)
    cut[1:] = gap[1:] != gap[:-1]
    cut[first[size > 0]] = True
    at = np.flatnonzero(cut)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(raw)])
    real = ~gap[at]
    coded = runs.filter(pa.array(real)).dictionary_encode()
    begin = at[real]
    text = np.searchsorted(first, begin, side="right") - 1
    breaks = np.cumsum(_BREAK[raw], dtype=np.int64)
    return PieceWords(coded.dictionary, np.asarray(coded.indices, dtype=np.int64), text, breaks[begin] + text)


class _Words(NamedTuple):
    """Distinct (language, word) of a part: hash, language, word; and each word's place in them."""

    hash: np.ndarray
    lang: pa.Array
    word: pa.Array
    codes: np.ndarray
    piece: np.ndarray


def _language_words(batch: pa.RecordBatch, seed: int) -> _Words:
    words = piece_words(texts_of(batch.column(0)))
    langs = batch.column(1).dictionary_encode()
    of_text = np.asarray(langs.indices, dtype=np.int64)
    own = of_text[words.text] if len(words.text) else words.text
    both, codes = np.unique(own * max(len(words.vocab), 1) + words.codes, return_inverse=True)
    lang, word = np.divmod(both, max(len(words.vocab), 1))
    of_lang = np.fromiter((xxhash.xxh64_intdigest(x.encode(), seed) for x in langs.dictionary.to_pylist()), np.uint64, len(langs.dictionary))
    of_word = hashes(words.vocab, seed)
    with np.errstate(over="ignore"):
        h = mix(of_word[word] + mix(of_lang)[lang] * odd_numbers(1, seed)[0])
    return _Words(h, langs.dictionary.take(pa.array(lang)), words.vocab.take(pa.array(word)), codes, words.piece)


def _pair_hashes(h: np.ndarray, seed: int) -> np.ndarray:
    """One hash for every two consecutive words."""
    a, b = odd_numbers(2, seed + 1)
    with np.errstate(over="ignore"):
        return mix(h[:-1] * a + h[1:] * b)


def _gathered(batches, most_bytes: int = _PART) -> Iterator[pa.RecordBatch]:
    """The batches joined to parts of about ``most_bytes`` of text, one row at least."""
    held, size = [], 0
    for batch in batches:
        for part in parts(batch, "text", most_bytes):
            more = part.nbytes
            if held and size + more > most_bytes:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_COUNTS = "h long, lang string, word string, n long"


def _count(batches, seed: int) -> Iterator[pa.RecordBatch]:
    """Counted words, then counted pairs (without language and word), of each part."""
    names = ["h", "lang", "word", "n"]
    for part in _gathered(batches):
        w = _language_words(part, seed)
        n = np.bincount(w.codes, minlength=len(w.hash))
        for at in range(0, len(n), 50_000):
            some = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(w.hash[some].view(np.int64)), w.lang[some].cast(pa.string()),
                                              w.word[some].cast(pa.large_string()).cast(pa.string()), pa.array(n[some].astype(np.int64))], names=names)
        if len(w.codes) > 1:
            near = w.piece[1:] == w.piece[:-1]
            h, n = np.unique(_pair_hashes(w.hash[w.codes], seed)[near], return_counts=True)
            for at in range(0, len(h), 200_000):
                some = h[at:at + 200_000]
                none = pa.nulls(len(some), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), none, none, pa.array(n[at:at + 200_000].astype(np.int64))], names=names)


def lead_windows(w: _Words, open_: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of ``longest`` codes (-1: padding) that have two words at least, and their counts.

    ``open_[i]`` says that word i + 1 continues the phrase of word i.
    """
    total = len(w.codes)
    at = np.flatnonzero(open_)
    wide = len(w.hash) + 1
    columns = [w.codes[at]]
    alive = np.ones(len(at), bool)
    for k in range(1, longest):
        follows = at + k - 1
        alive = alive & (follows < len(open_)) & open_[np.minimum(follows, max(len(open_) - 1, 0))] if len(at) else alive
        columns.append(np.where(alive, w.codes[np.minimum(at + k, max(total - 1, 0))], -1) if len(at) else at)
    name = columns[0]
    for c in columns[1:]:  # number the prefixes, one column after the other
        name = np.unique(name * wide + c + 1, return_inverse=True)[1]
    _, first, n = np.unique(name, return_index=True, return_counts=True)
    return np.stack([c[first] for c in columns], axis=1), n


def _windows(batches, pairs, mask: int, longest: int, seed: int) -> Iterator[pa.RecordBatch]:
    frequent = pairs.value
    names = [*_columns(longest), "n"]
    for part in _gathered(batches):
        w = _language_words(part, seed)
        if len(w.codes) < 2:
            continue
        open_ = (w.piece[1:] == w.piece[:-1])
        open_[open_] = maybe_in(frequent, mask, _pair_hashes(w.hash[w.codes], seed)[open_])
        codes, n = lead_windows(w, open_, longest)
        for at in range(0, len(n), 200_000):
            some = codes[at:at + 200_000]
            made = [pa.array(w.hash[c].view(np.int64), mask=c < 0) for c in some.T]
            yield pa.RecordBatch.from_arrays([*made, pa.array(n[at:at + 200_000].astype(np.int64))], names=names)


def _columns(longest: int) -> list[str]:
    return [f"w{i}" for i in range(1, longest + 1)]


def word_counts(texts: DataFrame, least: int, seed: int = 0) -> tuple[DataFrame, DataFrame, int]:
    """((h, lang, word, n) of all words, (h) of the frequent pairs, the seed that keeps all words apart)."""
    while True:
        now = seed
        counted = (texts.mapInArrow(lambda b, now=now: _count(b, now), _COUNTS).groupBy("h", "lang", "word")
                        .agg(F.sum("n").alias("n")).where(F.col("word").isNotNull() | (F.col("n") >= least)))
        counted = written(counted)
        words, pairs = counted.where("word IS NOT NULL"), counted.where("word IS NULL").select("h")
        if words.groupBy("h").count().where("count > 1").isEmpty():
            return words, pairs, seed
        seed += 2


def phrase_counts(texts: DataFrame, pairs: DataFrame, longest: int, least: int, seed: int) -> DataFrame:
    """(p array of word hashes, f) of every phrase of 2 to ``longest`` words with ``least`` occurrences."""
    frequent, mask = bit_filter(pairs, "h")
    names = _columns(longest)
    windows = texts.mapInArrow(lambda b: _windows(b, frequent, mask, longest, seed), ", ".join(f"{c} long" for c in [*names, "n"]))
    # the first two columns go together: counts of single words are known
    rest = ", ".join(names[2:])
    sums = windows.sparkSession.sql(f"SELECT {', '.join(names)}, grouping_id() AS gone, sum(n) AS f FROM {{windows}} "
                                    f"GROUP BY ROLLUP((w1, w2){', ' + rest if rest else ''})", windows=windows)
    length = F.lit(longest) - F.bit_count(F.col("gone"))
    phrase = F.slice(F.array(*names), F.lit(1), length.cast("int"))
    # a prefix that ends in padding is a shorter phrase, which its own level counts
    last = F.get(F.array(*names), length - 1)
    return sums.where((F.col("f") >= least) & (length >= 2) & last.isNotNull()).select(phrase.alias("p"), "f")


def _cuts(longest: int) -> str:
    return f"filter(sequence(1, {longest - 1}), k -> k < size(p))"


def scored(phrases: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """(p, a, score, l, r): each phrase's cut of the lowest score (ties: the first)."""
    counts = phrases.select("p", "f").unionByName(words.select(F.array("h").alias("p"), F.col("n").alias("f")))
    cuts = (phrases.select("p", F.col("f").alias("a"), F.explode(F.expr(_cuts(longest))).alias("k"))
                   .withColumns({"left": F.expr("slice(p, 1, k)"), "right": F.expr("slice(p, k + 1, size(p) - k)")}))
    both = (cuts.join(counts.select(F.col("p").alias("left"), F.col("f").alias("l")), "left")
                .join(counts.select(F.col("p").alias("right"), F.col("f").alias("r")), "right"))
    score = F.expr("(cast(a AS decimal(38,0)) * 2000000) div (cast(l AS decimal(38,0)) + cast(r AS decimal(38,0)))")
    best = both.withColumn("score", score).groupBy("p").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("x"))
    return best.select("p", "x.a", "x.score", "x.l", "x.r")


def absorbed(phrases: DataFrame, longest: int) -> DataFrame:
    """(p, longer): the largest count of a longer phrase that contains p."""
    inner = F.expr(f"""flatten(transform(sequence(2, {max(longest - 1, 2)}), m ->
        transform(filter(sequence(1, {longest}), i -> m < size(p) AND i + m - 1 <= size(p)), i -> slice(p, i, m))))""")
    return (phrases.where(F.size("p") > 2).select(F.explode(inner).alias("p"), "f")
                   .groupBy("p").agg(F.max("f").alias("longer")))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, longest: int = 4, percent: int = 80,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language.

    ``least``: occurrences of a candidate.  ``percent``: a phrase goes when a longer candidate
    around it has that share of its occurrences.
    """
    if longest < 2 or least < 1:
        raise ValueError("longest must be 2 or more, least 1 or more")
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    words, pairs, seed = word_counts(texts, least)
    phrases = written(phrase_counts(texts, pairs, longest, least, seed))
    frequent = words.where(F.col("n") >= least)
    inside = absorbed(phrases, longest)
    wide = "decimal(38,0)"
    kept = (scored(phrases, frequent, longest).join(inside, "p", "left")
            .where(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * percent))
            .withColumn("h", F.col("p")[0]).join(frequent.select("h", "lang"), "h").drop("h", "longer"))
    # ties at the border stay until the phrases' texts are known
    best = written(kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))))
                       .where(F.col("place") <= top))
    named = (best.select("p", F.posexplode("p").alias("i", "h")).join(frequent.select("h", "word"), "h")
                 .groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.join(named, "p").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
                .join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS MATERIALIZED (SELECT lang, p, count(*) AS f FROM (
    SELECT lang, unnest([w[i:i + m - 1] FOR i IN range(1, len(w) - m + 2)]) AS p FROM split, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
  GROUP BY lang, p),
candidates AS MATERIALIZED (SELECT lang, p, f AS a FROM grams WHERE len(p) >= 2 AND f >= 30),
cuts AS (SELECT lang, c.p, a, k, CAST(x.f AS HUGEINT) AS l, CAST(y.f AS HUGEINT) AS r
  FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN grams x USING (lang) JOIN grams y USING (lang) WHERE x.p = c.p[:k] AND y.p = c.p[k + 1:]),
scored AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM (
  SELECT lang, p, a, k, l, r, CAST((2000000 * CAST(a AS HUGEINT)) // (l + r) AS BIGINT) AS score FROM cuts)),
inner_ AS (SELECT lang, q, max(a) AS longer FROM (
  SELECT lang, a, unnest([p[i:i + 1] FOR i IN range(1, len(p))]) AS q FROM candidates WHERE len(p) > 2
  UNION ALL SELECT lang, a, unnest([p[i:i + 2] FOR i IN range(1, len(p) - 1)]) FROM candidates WHERE len(p) > 3) GROUP BY lang, q),
kept AS (SELECT s.lang, array_to_string(s.p, ' ') AS phrase, s.a, s.l, s.r, s.score FROM scored s
  LEFT JOIN inner_ i ON i.lang = s.lang AND i.q = s.p
  WHERE s.place = 1 AND (i.longer IS NULL OR 100 * CAST(i.longer AS HUGEINT) < 80 * CAST(s.a AS HUGEINT))),
total AS (SELECT lang, sum(f) AS n FROM grams WHERE len(p) = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000"""
