"""Centroid clustering, phrase mining and packing against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from claimscope.llm import bytebpe, clustering, collocations, idcache, packing
from claimscope.llm.plans import QUERIES

from .conftest import lower

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# clustering -------------------------------------------------------------------------
def lloyd(rows, k, rounds, dim, seed, scale=256):
    """Plain Lloyd rounds over every vector and centroid, in Python integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * float(x))) for x in v]))
    def key(r):
        return hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((min(d), d.index(min(d))))
        return out
    for _ in range(rounds):
        a = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, j) in zip(kept, a) if j == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i is None, i or 0), c, d) for (i, _), (d, c) in zip(kept, assign())), centroids


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_clusters_equal_plain_rounds(spark, spread):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, spread, 6)]) for i in range(300)]
    rows += [(900 + i, rows[0][1]) for i in range(40)]  # repeated vectors: ties between centroids
    rows += [(7, rows[1][1]), (None, rows[2][1]), (None, rows[2][1])]
    rows += [(1000, None), (1001, [1.0] * 5), (1002, [1.0] * 7), (1003, [None] + [1.0] * 5), (1004, [float("nan")] * 6), (1005, [float("inf")] * 6), (1006, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = clustering.cluster_vectors(df, 12, 4, 6, 2, lead=2)
    want, centroids = lloyd(rows, 12, 4, 6, 2)
    assert sorted(((r.id is None, r.id or 0), r.cluster, r.distance) for r in got.rows.collect()) == want
    assert got.centroids == [tuple(c) for c in centroids]


def test_bounds_spare_distances_and_verify_ties():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (20, 32))
    v = np.floor(centres[rng.integers(0, 20, 2000)] + rng.normal(0, 20, (2000, 32))).astype(np.int64)
    c = np.floor(centres).astype(np.int64)
    c[7] = c[3]  # the smaller number wins
    one = np.hstack([np.ones((len(v), 1)), v])
    total = one.T @ one
    mean = total[0, 1:] / len(v)
    axes = clustering.Axes(mean, np.linalg.eigh(total[1:, 1:] / len(v) - np.outer(mean, mean))[1][:, ::-1].copy(), 8)
    number, distance, verified = clustering.nearest(v, *axes.place(v), c, axes)
    full = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert not (number == 7).any()
    assert verified < 0.2 * full.size


def test_clusters_of_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, cluster string, id int"
    df = spark.createDataFrame([(3, [0.5, -0.5], "x", 1), (4, [0.25, 1.0], None, 2), (None, None, "z", None)], schema)
    got = clustering.clusters_report(df, 40, 5, 2, 2)
    assert sorted((r.vec_id, r.distance, r.cluster_inertia, r.inertia) for r in got.collect()) == [(3, 0, 0, 0), (4, 0, 0, 0)]
    assert clustering.clusters_report(df.limit(0), 40, 5, 2, 2).collect() == []
    assert clustering.clusters_report(df.where("vec_id is null"), 40, 5, 2, 2).columns == got.columns
    large = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        clustering.clusters_report(large, 1, 1, 2, 2)


# phrases ------------------------------------------------------------------------------
def mine(docs, least, top, longest, percent):
    import re
    counts, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            f = counts.setdefault(lang, Counter())
            for m in range(1, longest + 1):
                f.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            inside = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in inside):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(rows[:top])]
    return sorted(out)


PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("longest,least,top", [(4, 3, 1000), (4, 2, 5), (2, 3, 50), (6, 2, 1000)])
def test_phrases_equal_brute_force(spark, longest, least, top):
    rng = random.Random(longest * 7 + top)
    words = ["new", "York", "city", "the", "of", "é", "zÜ", "a-b", "\x1f", "\xa0x", "日本", "'s", "q"]
    def text():
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]) for _ in range(rng.randint(0, 60)))
    docs = [(text(), rng.choice(["en", "en", "en", "de", None, "und"])) for _ in range(60)]
    docs += [("new york city the " * 20, "en")] * 3 + [(None, "en"), ("", None), ("x" * 5000, "fr"), ("lone lone lone", "fr")]
    df = spark.createDataFrame([(i, t, g, "q") for i, (t, g) in enumerate(docs)], "n int, text string, lang string, phrase string").repartition(4)
    got = collocations.collocations(df, least, top, longest)
    assert sorted(tuple(r[c] for c in PHRASES) for r in got.collect()) == mine(docs, least, top, longest, 80)


def test_windows_over_parts_and_hash_clashes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "bit_filter", lambda df, c: (spark.sparkContext.broadcast(np.full(1 << 10, ~np.uint64(0))), (1 << 16) - 1))
    docs = [("a b c d e a b c", "en"), ("a b, c d", "en"), ("b c", "de")]
    df = spark.createDataFrame(docs, "text string, lang string")
    got = collocations.collocations(df, 2, 100)  # every pair passes the bit array: rare ones must go by their sums
    assert sorted(tuple(r[c] for c in PHRASES) for r in got.collect()) == mine(docs, 2, 100, 4, 80)
    assert collocations.collocations(df.limit(0)).collect() == []
    assert collocations.collocations(df).collect() == []


def test_words_that_share_a_hash_change_the_seed(spark, monkeypatch):
    plain = collocations._count
    def clashing(batches, seed):
        for b in plain(batches, seed):
            if seed == 0:
                b = pa.RecordBatch.from_arrays([pa.array([5] * b.num_rows, pa.int64()), *b.columns[1:]], names=b.schema.names)
            yield b
    monkeypatch.setattr(collocations, "_count", clashing)
    words, _, seed = collocations.word_counts(spark.createDataFrame([("a b", "en"), ("c", "en")], "text string, lang string"), 1)
    assert seed == 2 and words.select("h").distinct().count() == 3


# packing -----------------------------------------------------------------------------
def test_byte_bpe_equals_the_library():
    tok = Tokenizer.from_file(TOKENIZER)
    with open(TOKENIZER, encoding="utf-8") as f:
        enc = bytebpe.Encoder(f.read())
    rng = random.Random(9)
    some = list(" \n\t\r\x0b\x0c  '''...,;!?()-“—ab cdeXYZ019éüß×÷ǅ中文\xa0　 \x85​\x1c\x00\x7f😀") + [
        "'s", "'re", " the", " and", "don't", "<|endoftext|>", "  ", "\n\n", "́", " été", "\nWord"]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(20000)]
    for at in range(0, len(texts), 2500):
        part = texts[at:at + 2500]
        got = enc.encode(pa.array(part))
        ends = np.cumsum(got.counts)
        assert [got.ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [e.ids for e in tok.encode_batch(part, add_special_tokens=False)]


def test_byte_bpe_of_long_texts_and_forgotten_chunks(monkeypatch):
    monkeypatch.setattr(bytebpe, "STEP", 300)
    monkeypatch.setattr(idcache, "REMEMBER", 20)
    tok = Tokenizer.from_file(TOKENIZER)
    with open(TOKENIZER, encoding="utf-8") as f:
        enc = bytebpe.Encoder(f.read())
    rng = random.Random(3)
    for text in (" ".join(rng.choice(["alpha", "été", "b,c", "d\n\ne", "x" * 400, "<|endoftext|>"]) for _ in range(400)), "y" * 2000, ""):
        want = tok.encode(text, add_special_tokens=False).ids
        assert enc.encode_long(pa.scalar(text)).tolist() == want
        assert enc.encode(pa.array([text])).ids.tolist() == want


def fewest(items, capacity):
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        tried = set()
        for j, room in enumerate(bins):
            if room >= items[i] and room not in tried:
                tried.add(room)
                bins[j] -= items[i]
                place(i + 1, bins)
                bins[j] += items[i]
        place(i + 1, [*bins, capacity - items[i]])
    place(0, [])
    return best


def held(plan):
    out = Counter()
    for use in plan:
        for s in use.filling:
            out[s] += use.times
    return out


def test_plans_are_optimal_for_few_pieces():
    rng = random.Random(3)
    for _ in range(300):
        capacity = rng.choice([10, 13, 20, 30])
        items = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 11)))
        plan = packing.plan_bins(items, capacity)
        assert held(plan) == items and all(sum(u.filling) <= capacity for u in plan)
        assert sum(u.times for u in plan) == fewest(items.elements(), capacity)


def test_plans_of_many_pieces_reach_the_bound_or_beat_best_fit():
    rng = np.random.default_rng(1)
    for sizes, at_bound in ((np.clip(rng.lognormal(5.5, 1, 50_000).astype(int) + 1, 1, 1024), True), (rng.integers(1, 200, 50_000), True),
                            (rng.integers(300, 500, 50_000), False), (np.full(10**5, 400), False)):
        items = Counter(sizes.tolist())
        plan = packing.plan_bins(items, 1024, 1500)
        counts = np.bincount(sizes, minlength=1025)
        n = sum(u.times for u in plan)
        assert held(plan) == items and len(plan) < 3000
        assert n <= sum(u.times for u in packing.best_fit(counts, 1024))
        if at_bound:
            assert n == -(-int(sizes.sum()) // 1024)


def test_dominance():
    assert packing.dominates((5,), (3, 2)) and packing.dominates((4, 3), (3, 3)) and not packing.dominates((4, 3), (5, 2))
    got = list(packing.completions(np.array([0, 9, 9, 9, 0, 0, 0, 1]), 7, 10, 3))
    assert got == [(7, 3)]


def test_packing_edge_cases(spark):
    docs = [(1, "a b c " * 1500, 1), (None, None, 2), (None, "", 3), (2, "same", 4), (2, "same", 5), (-5, "zwölf Boxkämpfer", 6), (9, "x" * 3000, 7)]
    df = spark.createDataFrame(docs, "piece long, text string, offset int").repartition(3)
    got = packing.pack_documents(df, TOKENIZER, capacity=64, id_col="piece")
    assert got.columns == ["_piece", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    check_packing([(i, t or "") for i, t, _ in docs], got.toDF("doc_id", *got.columns[1:]), 64)
    assert packing.pack_documents(df.limit(0), TOKENIZER, id_col="piece").collect() == []


def check_packing(docs, packed, capacity):
    tok = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, text in docs:
        ids = tok.encode(text, add_special_tokens=False).ids + [2]
        head = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        at = [0, *range(head, len(ids), capacity)]
        for k, (a, b) in enumerate(itertools.zip_longest(at, at[1:], fillvalue=len(ids))):
            want.append((i is None, i or 0, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    rows = packed.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= capacity
    if "ids" in packed.columns:
        whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
        assert set(whole) == set(bins)
        for r in rows:
            s = whole[r.sequence_id]
            assert zlib.crc32(bytes(s.ids)[4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32 and r.offset in s.begins and s.length <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing_query_equals_the_library(spark, small, documents):
    packed = QUERIES["op13_best_fit_packing"](spark, small)
    n, least = check_packing(documents, packed, 1024)
    assert least <= n <= least + 2
