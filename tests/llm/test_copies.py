"""Exact, near and substring copies, and benchmark passages, against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash

from claimscope.llm import decontaminate as dc
from claimscope.llm import exact, simhash, substring
from claimscope.llm.graph import components
from claimscope.llm.plans import QUERIES

from .conftest import PLAIN_WORD, SPACE_WORD, lower

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# exact ------------------------------------------------------------------------
def test_exact_edge_cases(spark):
    rows = [(1, "a b", "q"), (1, "a b", "q"), (None, "ab", "z"), (None, None, None), (3, "", "y"), (4, " \n", "x"),
            (5, "ab\x85", "w"), (9, "a  b", "v"), (8, "a\tb\t", "u")]
    df = frame(spark, rows, "doc_id long, text string, len string")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(df).collect())
    assert got == sorted([((False, 1), 8, 5, False), ((False, 1), 8, 5, False), ((True, 0), 8, 5, False), ((False, 8), 8, 5, True),
                          ((False, 9), 8, 5, False), ((True, 0), 4, 3, False), ((False, 3), 4, 3, False), ((False, 4), 4, 3, True),
                          ((False, 5), 5, 1, True)])
    kept = exact.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(4, " \n", "x"), (5, "ab\x85", "w"), (8, "a\tb\t", "u")]


def test_exact_repeated_rows_and_empty_table(spark):
    df = frame(spark, [(7, "same")] * 50)
    got = exact.exact_groups(df).collect()
    assert len(got) == 50 and sum(r.kept for r in got) == 1 and {r.group_size for r in got} == {50}
    assert exact.exact_dedup(df).count() == 1
    assert exact.exact_groups(df.limit(0)).count() == exact.exact_dedup(df.limit(0)).count() == 0


# simhash ------------------------------------------------------------------------
def fingerprint(text):
    w = SPACE_WORD.findall(lower(text))
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_more_blocks_give_the_same_components(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fp = {int(x) for b in base for x in [b, *(b ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64)) for k in (1, 3, 4, 5))]}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fp], "fp long")
    def parts(agree):
        return {(r.u, r.root) for r in components(simhash.near_edges(df, 4, agree=agree)).collect()}
    assert parts(2) == parts(3) == parts(4) and len(parts(2)) > 100
    assert [simhash.blocks_to_agree(n) for n in (10, 10**8, 10**9, 10**11)] == [2, 2, 3, 4]
    assert len(simhash._tables(4, 3)) == 35 and all(m.bit_count() >= 27 for m in simhash._tables(4, 3))


def test_simhash_equals_brute_force(spark, small, documents):
    ids, fp = zip(*sorted((i, fingerprint(t)) for i, t in documents))
    a = np.array(fp, np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    want = {i: (f"{fp[k]:016x}", ids[find(k)]) for k, i in enumerate(ids)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash_near_dedup"](spark, small).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    noise = np.bitwise_or.reduce([np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64) for _ in range(4)])
    fp = base[rng.integers(0, 12, 200)] ^ noise
    end = np.where(np.arange(200) < 70, 70, 200)
    got = set(zip(*(x.tolist() for x in simhash._near(fp, end, radius))))
    assert got == {(i, j) for i in range(200) for j in range(i + 1, int(end[i])) if int(fp[i] ^ fp[j]).bit_count() <= radius}


def test_hot_bucket_in_chunks(spark):
    rng = np.random.default_rng(3)
    fp = np.unique(np.uint64(0x1234567890ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
                   ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in fp], "fp long")
    for bucket in (64, 100_000):
        got = components(simhash.near_edges(df, 4, bucket)).collect()
        assert len(got) == len(fp) - 1 and {r.root for r in got} == {min(fp)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}}


def test_simhash_dedup_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(3, text, 1), (2, text + " end", 2), (5, None, 3), (6, "", 4), (None, "  ", 5), (9, "alone here", 6), (9, "alone here", 7)]
    df = frame(spark, rows, "doc_id long, text string, id int")
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 9]
    empty = simhash.simhash_groups(df.limit(0))
    assert empty.count() == 0 and simhash.simhash_dedup(df.limit(0)).count() == 0


# substring ------------------------------------------------------------------------
def kept_words(docs):
    own = {}
    for i in sorted(docs):
        for p in range(len(docs[i]) - 12):
            own.setdefault(tuple(docs[i][p:p + 13]), i)
    out = {}
    for i, w in docs.items():
        gone = {q for p in range(len(w) - 12) if own[tuple(w[p:p + 13])] < i for q in range(p, p + 13)}
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    return out


def test_substring_equals_brute_force(spark, small, documents):
    want = kept_words({i: SPACE_WORD.findall(t) for i, t in documents})
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op4_substring_dedup"](spark, small).collect()}
    assert got == want


def test_substring_edge_cases(spark):
    part = " ".join(f"p{i}" for i in range(20))
    loop = "ha " * 40
    texts = {1: part, 2: f"x {part} y {part}", 3: " ".join(part.split()[:12]), 4: "", 5: "a\x85b \x1cc", 6: loop, 7: loop + "ho",
             8: part.upper(), 9: "u " * 30000 + part}
    df = frame(spark, [(i, t, 0) for i, t in texts.items()] + [(10, None, 0)], "doc_id long, text string, doc_key int")
    cut = substring.substring_dedup(df)
    assert set(cut.columns) == {*df.columns, "cut"}
    got = {r.doc_id: r.cut for r in cut.collect()}
    want = kept_words({**{i: SPACE_WORD.findall(t) for i, t in texts.items()}, 10: []})
    assert {i: (c.n_words, c.n_removed, c.kept_sha256) for i, c in got.items()} == want
    assert [tuple(x) for x in got[2].repeats] == [(1, 21), (22, 42)] and got[2].kept_text == "x y"
    assert substring.substring_report(df.limit(0)).count() == 0


def test_substring_repeated_and_null_ids(spark):
    part = " ".join(f"p{i}" for i in range(15))
    df = frame(spark, [(1, part), (1, part), (None, part), (None, part)])
    got = sorted((r.doc_id is None, r.n_removed) for r in substring.substring_report(df).collect())
    assert got == [(False, 0), (False, 0), (True, 15), (True, 15)]


def test_substring_equal_and_null_ids_with_other_texts(spark):
    part, other, last = (" ".join(f"{c}{i}" for i in range(40)) for c in "pqr")
    rows = [(1, part), (2, "x " + part), (2, other), (2, "x " + part), (None, last), (None, "y y " + part), (None, "z " + other), (None, None)]
    got = substring.substring_dedup(frame(spark, [(i, t, 0) for i, t in rows], "doc_id long, text string, doc_tag int"))
    want = [(1, part), (2, "x"), (2, other), (2, "x"), (None, last), (None, "y y"), (None, "z"), (None, "")]
    assert sorted(map(repr, ((r.doc_id, r.cut.kept_text) for r in got.collect()))) == sorted(map(repr, want))
    assert set(got.columns) == {"doc_id", "text", "doc_tag", "cut"}


# benchmark ------------------------------------------------------------------------
def contamination(docs, items):
    windows = {}
    for item, text in items:
        w = PLAIN_WORD.findall(lower(text or ""))
        for p in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[p:p + 13]), set()).add(item)
    out = {}
    for i, text in docs:
        w = PLAIN_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p:p + n])) in windows:
                    hit.update(range(p, p + n))
                    found |= windows[k]
        names = sorted(str(x) for x in found if x is not None)
        out[i] = (len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def as_tuple(r):
    return r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated


def test_decontamination_equals_brute_force(spark, small, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: as_tuple(r) for r in QUERIES["op8_benchmark_decontamination"](spark, small).collect()}
    assert got == contamination(documents, items)


def test_decontamination_edge_cases(spark):
    long = " ".join(f"t{i}" for i in range(30))
    items = [(1, long), (1, long), (2, "Short Item"), (3, ""), (4, None), (None, "no id here"), (11, "ba ba ba")]
    docs = [(1, f"... {long.upper()}!!"), (2, "a short-item b"), (3, None), (4, "short"), (5, "x no id here"), (6, "ba " * 9),
            (7, "item short"), (8, " ".join(f"t{i}" for i in range(12))), (9, "z " * 20000 + long)]
    df = frame(spark, [(*d, True) for d in docs], "doc_id long, text string, found boolean")
    bench = frame(spark, items, "item_id long, text string")
    want = contamination(docs, items)
    assert {r.doc_id: as_tuple(r) for r in dc.decontamination_report(df, bench).collect()} == want
    kept = dc.decontaminate(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x[4]}
    match = {tuple(m) for m in dc.find_matches(df.select("doc_id", "text"), bench).where("doc_id = 1").first().found.matches}
    assert match == {("1", 0, 0, 30)}
    blocks = dc.item_blocks(bench, "item_id", "text", block_bytes=10)
    assert len(blocks) > 2 and dc.decontaminate(df, bench.limit(0)).count() == len(docs)
    assert dc.decontamination_report(df.limit(0), bench).count() == 0


def test_benchmark_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (dc.WINDOW, 10))
    docs = [(1, "one two three four"), (2, "five six"), (3, "one five")]
    items = [(1, "one two three"), (2, "five six"), (3, "two three four")]
    got = {r.doc_id: as_tuple(r) for r in dc.decontamination_report(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()}
    assert got == contamination(docs, items)
