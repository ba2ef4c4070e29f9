"""Secret scans: three fixed patterns, and guess cost for values in a credential context.

Guess cost is a dynamic program over a value: the cheapest way to write it as a sequence of
dictionary words, dates, repeats, keyboard or alphabet walks, and brute-force characters,
where a part costs the logarithm (base 10) of the guesses it takes.  A value whose cheapest
sequence costs ``STRONG`` or more is a secret of kind ``guess``; cheap values (ordinary words,
placeholders, walks) add nothing.  The base spans stay whatever they cost.

A walk keeps to one row and one direction, so it is no longer than a row.  A repeat is what comes
again and again right behind itself, of any period; all maximal ones are found first, so a
value costs about its length times the logarithm of its length.

A base span is the whole match.  Positions are code points, ends exclusive.

Edge cases: a null text is empty and has no spans.  Two kinds may give the same span; spans
are ordered by start, then by kind as listed in ``KINDS``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sha256_hex, with_arrow
from .words import texts_of

KINDS = ("assign", "access", "hex", "guess")
#: Guesses, as a power of ten, from which a value counts as a secret.
STRONG = 10.0

# ASCII letters only in either case
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: A credential word, a separator, and a value in quotes or up to the next white space.
_CONTEXT = re.compile(
    r"""(?:passw(?:or)?d|pwd|passphrase|passcode|secret|token|credentials?|api_?key|access_?key|private_?key|auth)"""
    r"""["']?[\x20\t]*(?::=|=>|[:=]|\bis\b)[\x20\t]*(?:"([^"\r\n]{6,})"|'([^'\r\n]{6,})'|([^\s"']{6,}))""", re.I | re.A)
_CUES = ("pass", "pwd", "secret", "token", "credential", "key", "auth")

# Fixed rows of a common keyboard and the two plain sequences.
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789")
#: Two neighbours of a row, in its direction, to the rows that have them.
_NEXT: dict[str, list[int]] = {}
for _r, _row in enumerate(_ROWS):
    for _a, _b in zip(_row, _row[1:]):
        _NEXT.setdefault(_a + _b, []).append(_r)
_LEET = str.maketrans("013457@$!", "oleastasi")
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?[01]\d[-/.]?[0-3]\d|[0-3]?\d[-/.][01]?\d[-/.](?:(?:19|20)\d\d|\d\d)|[0-3]\d[01]\d(?:19|20)\d\d|(?:19|20)\d\d")


def _walks(low: str) -> list[int]:
    """For every character, the steps of the longest walk along one row, in one direction, that ends there."""
    out = [0] * len(low)
    up: dict[int, int] = {}
    down: dict[int, int] = {}
    for i in range(1, len(low)):
        a, b = low[i - 1], low[i]
        up = {r: up.get(r, 0) + 1 for r in _NEXT.get(a + b, ())}
        down = {r: down.get(r, 0) + 1 for r in _NEXT.get(b + a, ())}
        if up or down:
            out[i] = max([*up.values(), *down.values()])
    return out


def _same(value: str, i: int, j: int) -> int:
    """How many characters from ``j`` on equal those from ``i`` on (i < j)."""
    left = len(value) - j
    got, step = 0, 16
    while got < left and value[i + got:i + got + step] == value[j + got:j + got + step]:
        got = min(got + step, left)
        step *= 2
    while step > 1:
        step //= 2
        if got + step <= left and value[i + got:i + got + step] == value[j + got:j + got + step]:
            got += step
    return got


def _same_back(value: str, i: int, j: int) -> int:
    """How many characters before ``j`` equal those before ``i`` (i < j)."""
    got, step = 0, 16
    while got < i and value[max(0, i - got - step):i - got] == value[j - got - min(step, i - got):j - got]:
        got = min(got + step, i)
        step *= 2
    while step > 1:
        step //= 2
        if got + step <= i and value[i - got - step:i - got] == value[j - got - step:j - got]:
            got += step
    return got


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal repeats: two periods long or more, the period no repeat itself.

    A repeat of period p covers a multiple of p whose character comes again p later; only such
    places are extended.  Periods that are multiples of one already found there are left out.
    """
    n = len(value)
    codes = np.frombuffer(value.encode("utf-32-le"), "<u4")
    out = []
    long: list[tuple[int, int, int]] = []  # of four periods or more, the longest first
    for period in range(1, n // 2 + 1):
        places = np.flatnonzero(codes[:n - period:period] == codes[period::period]) * period
        if not len(places):
            continue
        for start, end, base in long:
            if end - start < 2 * period:
                break
            if period % base == 0:
                places = places[(places < start) | (places > end - period)]
        upto = -1
        for i in places.tolist():
            if i < upto:
                continue
            ahead = _same(value, i, i + period)
            back = _same_back(value, i, i + period)
            upto = i + ahead
            if ahead + back >= period:
                start, end = i - back, i + period + ahead
                out.append((start, end, period))
                if end - start >= 4 * period:
                    long.append((start, end, period))
        long.sort(key=lambda r: r[0] - r[1])
    return out


def guess_cost(value: str, ranks: dict[str, int], longest: int | None = None) -> float:
    """Logarithm (base 10) of the guesses that the cheapest segmentation of ``value`` takes.

    ``longest``: characters of the longest word in ``ranks`` (found if not given).
    """
    n = len(value)
    if longest is None:
        longest = max(map(len, ranks), default=0)
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(_LEET)
    dates = {}
    for i in range(n):
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            dates.setdefault(m.end(), []).append((i, 2.1 if m.end() - i == 4 else 4.6))
    walk = _walks(low)
    again = sorted(repeats(value), key=lambda r: r[0] + 2 * r[2])
    active: list[tuple[int, int, int]] = []
    coming = 0
    best = [0.0] + [math.inf] * n
    for end in range(1, n + 1):
        cost = best[end - 1] + 1.0  # brute force: ten guesses a character
        for start in range(max(0, end - longest), end - 2):
            if best[start] >= cost:
                continue
            word = low[start:end]
            rank = ranks.get(word)
            twist = 0.0
            if rank is None:
                rank, twist = ranks.get(plain[start:end]), 0.5
            if rank is not None:
                part = value[start:end]
                twist += 0.0 if part == word else 0.3 if part[1:] == word[1:] or part.isupper() else 0.1 * len(part)
                cost = min(cost, best[start] + math.log10(rank + 1) + twist + 0.3)
        for start, price in dates.get(end, ()):
            cost = min(cost, best[start] + price + 0.3)
        for k in range(2, walk[end - 1] + 1):
            cost = min(cost, best[end - 1 - k] + 1.7 + math.log10(k + 1) + 0.3)
        while coming < len(again) and again[coming][0] + 2 * again[coming][2] <= end:
            active.append(again[coming])
            coming += 1
        if active:
            active = [r for r in active if r[1] >= end]
            for start, _, period in active:  # the part before, once or more
                k = (end - start) // period - 1
                cost = min(cost, best[end - k * period] + math.log10(k + 1) + 0.3)
        best[end] = cost
    return best[n]


def find_spans(text: str, ranks: dict[str, int], strong: float = STRONG, longest: int | None = None) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, guess cost) of every span of ``text``, in order."""
    out: list[tuple[str, int, int, float | None]] = []
    low = text.lower()
    if any(cue in low for cue in _CUES):
        out += [("assign", m.start(), m.end(), None) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        for m in _CONTEXT.finditer(text):
            cost = guess_cost(m[m.lastindex], ranks, longest)
            if cost >= strong:
                out.append(("guess", *m.span(m.lastindex), cost))
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), None) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType()), T.StructField("log10_guesses", T.DoubleType())])


def scan_secrets(docs: DataFrame, words: Sequence[str], text_col: str = "text", strong: float = STRONG,
                 out: str = "secrets", drop_text: bool = False) -> DataFrame:
    """``docs`` with an array column ``out`` of spans.  ``words``: a word list of fixed size, the commonest first."""
    ranks: dict[str, int] = {}
    for i, w in enumerate(words):
        ranks.setdefault(w.lower(), i + 1)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())]))
    names = [f.name for f in _SPAN]

    def start():
        ranked = shared.value
        longest = max(map(len, ranked), default=0)

        def made(part):
            texts = texts_of(part.column(part.schema.get_field_index(text_col)))
            return [pa.array([[dict(zip(names, s)) for s in find_spans(t.as_py(), ranked, strong, longest)] for t in texts], kind)]
        return made

    return with_arrow(docs, text_col, start, [T.StructField(out, T.ArrayType(_SPAN))], drop_text=drop_text)


def vocabulary_words(path: str) -> list[str]:
    """Whole words of a public tokenizer's vocabulary file, in its order (the commonest first)."""
    import json

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    whole = sorted((i, w[:-4]) for w, i in vocab.items() if w.endswith("</w>"))
    return [w for _, w in whole if len(w) >= 3 and w.isascii() and w.isalpha()]


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets_report(docs: DataFrame, words: Sequence[str]) -> DataFrame:
    """One row per document with the digest columns of the contract."""
    got = scan_secrets(docs.select("doc_id", "text"), words, drop_text=True)
    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    n = {kind: count(kind) for kind in KINDS}
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return got.select("doc_id", n["assign"], n["access"], n["hex"], sha256_hex(_joined(base)).alias("base_sha256"),
                      _joined(F.col("secrets")).alias("spans"), n["guess"])
