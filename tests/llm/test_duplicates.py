"""Operators 1, 3 and 7 against brute force."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from llm_helpers import PROSE, table, texts_of

from winnow.llm import common, minhash, shingles, suffixes, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(links, ids):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_pairs(sets):
    by = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    shared = collections.Counter((min(a, b), max(a, b)) for v in by.values() for k, a in enumerate(v) for b in v[:k])
    return [(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, 501 + i) for i in range(50)]
    ids = {x for e in edges for x in e if e[0] != e[1]}
    got = {r.id: r.component_id for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups([e for e in edges if e[0] != e[1]], ids)
    assert common.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_shingles():
    texts = ["", "a b", "A b", "a  b c d e", "a b c d e f", "É é ß", "x y z", "a b c d e f a b c d e f"]
    h, n = shingles.shingle_sets(texts)
    assert n.tolist() == [len(shingle_set(t)) for t in texts]
    parts = np.split(h, np.cumsum(n)[:-1])
    for i, x in enumerate(parts):
        for j, y in enumerate(parts):
            assert len(np.intersect1d(x, y)) == len(shingle_set(texts[i]) & shingle_set(texts[j]))


def test_near_documents(spark, docs):
    sets = {i: shingle_set(t) for i, t in texts_of(docs).items()}
    want = groups(near_pairs(sets), sets)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


def test_star_of_copies(spark, monkeypatch):
    """Copies that resemble their original more than each other, in regions larger than a block; classes that only step 3 joins."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(300)]
    rows = [(50, " ".join(base))]
    for k in range(100, 160):
        words = list(base)
        for i in rng.choice(300, rng.integers(3, 12), replace=False):
            words[i] = f"v{k}x{i}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingle_set(t) for i, t in rows}
    want = groups(near_pairs(sets), sets)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == want


def test_near_very_long_texts(spark):
    """Sets of hundreds of thousands of shingles, on either side of the threshold."""
    words = [f"w{i}" for i in range(200_000)]
    near, far = list(words), list(words)
    near[::40], far[::33] = ["x"] * 5000, ["y"] * 6061
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(words[:100_000]))]
    sets = {i: shingle_set(t) for i, t in rows}
    want = groups(near_pairs(sets), sets)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets} and want[2] == 1 and want[4] == 4


def test_near_odd(odd, empty):
    got = collections.defaultdict(set)
    for r in minhash.near_duplicates(odd).collect():
        got[r.doc_id].add((r.component_id, r.kept))
    assert got[1] == {(1, True)} and got[2] == {(2, True)} and got[5] == {(4, False)} and got[7] == {(6, False)} and got[8] == {(6, False)}
    assert got[None] == {(None, True)} and got[12] == {(12, True)} and got[13] == {(13, True)}
    assert minhash.near_duplicates(empty).collect() == []
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    # two texts under one number both stay, a repeated row stays once
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 6, 9, 10, 11, 12, 12, 13]


def test_rows_of_one_number_are_not_lost(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta", 5), (1, "completely different words stand in this one", 6), (1, "alpha beta gamma delta epsilon zeta", 7), (2, "alpha beta gamma delta epsilon zeta", 8), (3, None, 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k long")
    got = sorted((r.doc_id, r.text or "") for r in minhash.keep_one(df).collect())
    assert got == sorted([rows[0][:2], rows[1][:2], (3, "")])
    assert {tuple(r) for r in minhash.keep_one(df).collect()} == {tuple(r) for r in minhash.keep_one(df.repartition(3)).collect()}


def template_texts(n, shared, common=404, own=66, seed=1):
    """Pages of one template, in twins: words of the template, some that two pages share, and some of each page's own, in stretches."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = i // 2
        stretches = [[f"c{j}" for j in range(at, min(at + 101, common))] for at in range(0, common, 101)]
        parts = [stretches[0], [f"t{k}x{j}" for j in range(shared)], stretches[1], [f"o{i}x{j}" for j in range(own)], *stretches[2:]]
        rows.append((int(i), " ".join(w for p in parts for w in p)))
    rng.shuffle(rows)
    return [(int(i), t) for i, t in rows]


@pytest.mark.parametrize("shared", [16, 25])
def test_twins_among_pages_of_one_template(spark, monkeypatch, shared):
    """In a region that is larger than what is compared as a whole no link is lost: 600 pages that resemble each other at 0.71 or less, and twins just above 0.75 among them."""
    monkeypatch.setattr(minhash, "BLOCK", 128)
    own = 62 if shared == 16 else 50
    rows = template_texts(600, shared, own=own)
    a, b, c = (shingle_set(dict(rows)[i]) for i in (0, 1, 2))
    assert 0.75 <= len(a & b) / len(a | b) < 0.8 and len(a & c) / len(a | c) < 0.75
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_rare_regions_bring_all_similar_sets_together(spark):
    """Sets of any sizes: every pair that is similar enough meets at a rare shingle, in roles that compare them."""
    rng = np.random.default_rng(7)
    base = [rng.choice(3000, 400, replace=False) for _ in range(6)]
    sets = {}
    for i in range(120):
        b = base[i % 6]
        kept = rng.choice(b, rng.integers(290, 401), replace=False)
        sets[i] = np.unique(np.concatenate([kept, rng.integers(3000, 10**6, rng.integers(0, 60))])).astype(np.int64)
    rows = spark.createDataFrame([(i, len(x), bytearray(x.astype("<i8").tobytes())) for i, x in sets.items()], "doc_id long, n_shingles long, shingles binary")
    met = collections.defaultdict(list)
    for r in minhash.rare_regions(rows.selectExpr("doc_id", "doc_id class"), rows).collect():
        met[r.region].append(r)
    pairs = {(min(a.doc_id, b.doc_id), max(a.doc_id, b.doc_id)) for g in met.values() for a in g if a.as_minor for b in g if b.as_any and a.doc_id != b.doc_id}
    near = {(i, j) for i in sets for j in sets if i < j and minhash.similar(sets[i], sets[j])}
    assert near and near <= pairs


def removed(rows, n=50):
    """doc_id -> mask of removed bytes; rows in order of doc_id."""
    seen, out = {}, []
    for i, b in rows:
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - n + 1):
            if seen.get(b[k : k + n], i) < i:
                mask[k : k + n] = True
        out.append((i, b, mask))
        for k in range(len(b) - n + 1):
            seen.setdefault(b[k : k + n], i)
    return out


def told(i, b, mask):
    runs = int((np.diff(np.append(0, mask.astype(int))) == 1).sum())
    return i, len(b), int(mask.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest()


def test_repeats(spark, docs):
    want = sorted(told(*x) for x in removed(sorted((i, t.encode()) for i, t in texts_of(docs).items())))
    assert sorted(tuple(r) for r in suffixes.digests(docs).collect()) == want and sum(w[2] for w in want)


@pytest.mark.parametrize("heavy", [1, 6, 300_000])
def test_repeats_of_periodic_texts(spark, monkeypatch, heavy):
    """Small alphabets and periods, tiny queues, chunks and shards; common grams split, down to single strings, or not."""
    monkeypatch.setattr(suffixes, "QUEUE", 5)
    monkeypatch.setattr(suffixes, "HEAVY", heavy)
    monkeypatch.setattr(suffixes, "CHUNK", 128)
    monkeypatch.setattr(suffixes, "SHARD", 20)
    rng = np.random.default_rng(5)
    parts = ["ab" * 40, "abc" * 30, "a" * 70, "é" * 30, "".join(rng.choice(list("ab"), 90)), "the quick brown fox jumps over the lazy dog, again and again"]
    rows = [(int(i), "".join(rng.choice(parts) for _ in range(rng.integers(0, 4))) + "".join(rng.choice(list("abx "), int(rng.integers(0, 60))))) for i in range(60)]
    want = sorted(told(*x) for x in removed([(i, t.encode()) for i, t in rows]))
    assert sorted(tuple(r) for r in suffixes.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


def test_repeats_odd(odd, empty):
    got = collections.defaultdict(list)
    for r in suffixes.digests(odd).collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans))
    n = len(PROSE)
    assert got[6] == [(n, 0, 0)] and got[7] == [(n, n, 1)] and got[8][0][2] == 2 and got[10] == [(200, 120, 1)]
    assert got[1] == got[2] == [(0, 0, 0)] and sorted(got[None]) == [(0, 0, 0), (n, 0, 0)] and len(got[13]) == 2
    assert suffixes.digests(empty).collect() == []
    out = suffixes.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[7] == "" and texts[10] == "é" * 40 and texts[1] is None and texts[6] == PROSE
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)


@pytest.mark.parametrize("copies", [1, 3])
def test_near_vectors(spark, copies, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "ROWS", 3)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(20, 64))
    rows, ids = [], iter(range(10_000))
    for c in centre:
        for _ in range(rng.integers(1, 40)):
            v = (c + rng.normal(size=64) * rng.uniform(0.02, 0.16)).astype(np.float32).tolist()
            rows += [(next(ids), v, int(rng.integers(0, 3))) for _ in range(copies)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    found = sum(r.n_links for r in got.values())
    assert near.sum() * 0.998 <= found <= near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in range(len(rows)))
    want = groups([(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)], range(len(rows)))
    assert sum(want[i] != got[i].component_id for i in want) <= 0.002 * len(rows)


def test_near_vectors_odd(spark):
    e = [0.5] * 4
    rows = [(1, e, 1, 0), (2, e, 1, 0), (3, e, 2, 0), (4, e, None, 0), (5, None, 1, 0), (6, [], 1, 0), (7, [0.0] * 4, 1, 0), (8, [math.nan] + e[1:], 1, 0), (9, [math.inf] + e[1:], 1, 0), (10, [None] + e[1:], 1, 0), (11, [0.5] * 3, 1, 0), (12, [1.0] * 4, 1, 0), (None, e, 1, 0), (13, e, 2, 0), (13, [-0.5] * 4, 2, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")
    got = collections.defaultdict(list)
    for r in vectors.near_vectors(df).collect():
        got[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] and got[12] == [(3, 1, False)]
    for i in (4, 5, 6, 7, 8, 9, 10, 11):
        assert got[i] == [(0, i, True)]
    assert got[3] == [(1, 3, True)] and sorted(got[13]) == [(0, 3, False), (1, 3, False)] and got[None][0][0] == 3
    assert vectors.near_vectors(df.limit(0)).collect() == []
    assert vectors.near_vectors(table(spark, "embeddings")).count() == 500


@pytest.mark.parametrize(("common", "n"), [(0.0, 2000), (0.9, 4000), (0.99, 1000)])
def test_links_around_a_common_component(spark, common, n):
    r = np.random.default_rng(5)
    x = r.normal(size=(n, 64))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * np.sqrt(1 - common**2)
    x[:, 0] += common
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = r.normal(size=x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    y = 0.981 * x + np.sqrt(1 - 0.981**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    both = np.concatenate([x, y])
    want = ((both / np.linalg.norm(both, axis=1, keepdims=True)) @ (both / np.linalg.norm(both, axis=1, keepdims=True)).T >= 0.98).sum() - len(both)
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(both.tolist())], "vec_id long, label int, embedding array<double>")
    got = vectors.near_vectors(df).agg({"n_links": "sum"}).first()[0]
    assert 0.998 * want < got <= want + 2
