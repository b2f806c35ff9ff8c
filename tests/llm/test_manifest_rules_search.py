"""Operators 11 to 13 against brute force in plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_helpers import PROSE, table

from winnow.llm import merkle, rules, search


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def rise(nodes):
    """All levels, from the leaves to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([h(*level[i : i + 2]) for i in range(0, len(level), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else "", i % 2 == 1))
        i //= 2
    return out


def fold(node, path):
    for s, left in path:
        node = h(s, node) if left else h(node, s)
    return node


def manifest_brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    order = {g: sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in langs}
    trees = {g: rise([leaf_of(r) for r in order[g]]) for g in langs}
    top = rise([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(order[g]):
            path = siblings(trees[g], i) + siblings(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            claimed = leaf_of((*r[:3], r[3] + 1, r[4])) if hit and r[3] is not None else leaf_of(r)
            root, folded = top[-1][0], fold(claimed, path)
            out.append((r[0], leaf_of(r), trees[g][-1][0], root, h(*(s for s, _ in path)), folded, folded == root))
    return collections.Counter(out)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def audited(df):
    return collections.Counter(tuple(r[c] for c in COLUMNS) for r in merkle.audit(df).collect())


def rows_of(df):
    return [tuple(r[f] for f in merkle.FIELDS) for r in df.collect()]


def test_manifest(docs, odd, empty):
    for df in (docs, odd):
        want = manifest_brute(rows_of(df))
        assert audited(df) == want and {False, True} >= {x[-1] for x in want} and any(not x[-1] for x in want) or df is odd
    assert merkle.audit(empty).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 17, 64, 65, 100])
def test_manifest_in_small_blocks(spark, monkeypatch, n):
    """Several rounds of blocks, with last ones of every size; many languages; a language that is null."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)
    r = random.Random(n)
    rows = [(r.randrange(10**6), "s", r.choice(["de", "en", None, "é", "z", "", "fr"]) if i % 3 else "en", i if i % 5 else None, f"text {i}") for i in range(n)]
    df = spark.createDataFrame([(*x, "own", "g") for x in rows], "doc_id long, source string, lang string, n_chars long, text string, path string, g string")
    assert audited(df) == manifest_brute(rows)


def test_manifest_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 3)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(5, "s", "en", 1, "same")] * 50 + [(i, "s", "en", None, f"t{i}") for i in range(20)]
    assert audited(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)) == manifest_brute(rows)


SPACE = "[^\x20\x09-\x0d]+"


def rules_brute(text):
    text = text or ""
    w = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    repeated = len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)})
    m = {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_exclaims": text.count("!"),
        "n_stop_words": sum(x.lower() in rules.STOP_WORDS for x in w),
        "n_repeat_words": repeated,
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_list_lines": sum(x.lstrip(" ")[:1] in ("-", "*", "•") and x.lstrip(" ") != "" for x in lines),
        "n_open_lines": sum(x.rstrip(" ").endswith(("...", "…")) for x in lines),
    }
    failed = [r.name for r in rules.RULES if m["n_words"] >= r.from_words and (r.least is not None and 1000 * m[r.part] < r.least * (m[r.whole] if r.whole else 1) or r.most is not None and 1000 * m[r.part] > r.most * (m[r.whole] if r.whole else 1))]
    base = m["n_words"] < 10 or 100 * repeated > 20 * m["n_words"]
    return m | {"base_failed": base, "kept": not base and not failed, "failed": "; ".join(failed)}


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "a b c d e a b c d e f",
    "a b c d e f a b c d e f a b c d e f " * 3,
    "x " * 30,
    "the " * 4 + "one two three four five six seven the and of the",
    "- one\n- one\n- two\n\n\n* three...\n • four…\n",
    "line\nline\nline \n line",
    "!!! *** ### |a|b|c| <html> & $5 100%" * 5,
    "nbsp is a word　character   here, zero\u0000byte",
    "Straße ÄÖÜ é日本語 😀😀 " * 4,
    PROSE,
    " ".join(f"w{i}" for i in range(3000)) + " " + " ".join(f"w{i}" for i in range(2990, 3000)),
    "a\u0000b c " * 3,
    "one two three four five " * 400_000,
]


def test_rules(spark):
    df = spark.createDataFrame([(i, t, 1, "m", 2) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words long, failed string, m long")
    got = {r.doc_id: r.asDict() for r in rules.judged(df).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == {"doc_id": i} | rules_brute(t), t and t[:50]
    good = rules.keep_good(df)
    assert good.dtypes == df.dtypes and {r.doc_id for r in good.collect()} == {i for i, t in enumerate(TEXTS) if rules_brute(t)["kept"]}


def test_rules_on_random_texts(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(["a", "b", "c ", " ", "\n", "\t", "a b c d e ", "*", "!", "é", "...", "- "]) for _ in range(r.randint(0, 120))) for _ in range(600)]
    got = {x.doc_id: x.asDict() for x in rules.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[i] == {"doc_id": i} | rules_brute(t) for i, t in enumerate(texts))
    assert any(x["n_repeat_words"] for x in got.values())


def test_rules_of_a_table(spark, odd, empty, tmp_path):
    (tmp_path / "rules.csv").write_text("name,part,whole,least,most,from_words\nb lines,n_lines,,2000,,\na symbols,n_symbols,n_words,,0,3\n")
    table_ = rules.read_rules(spark, str(tmp_path))
    assert table_ == [rules.Rule("a symbols", "n_symbols", "n_words", None, 0, 3), rules.Rule("b lines", "n_lines", None, 2000, None, 0)]
    df = spark.createDataFrame([(1, "one"), (2, "a # b c\nd"), (3, "#\n#")], "doc_id long, text string")
    assert {r.doc_id: r.failed for r in rules.judged(df, table_).collect()} == {1: "b lines", 2: "a symbols", 3: ""}
    rows = rules.judged(odd).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.kept) for r in rows) == collections.Counter((r.doc_id, rules_brute(r.text)["n_words"], rules_brute(r.text)["kept"]) for r in odd.collect())
    assert rules.judged(empty).collect() == [] and rules.judged(df, []).where("failed <> ''").isEmpty()


def test_rules_leave_good_documents_alone(spark):
    d = "/root/testdata/sf0.01"
    judged = rules.judged(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in judged if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.25


def test_rules_are_one_projection(docs, capsys):
    capsys.readouterr()
    rules.judged(docs).explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("split(") == 2  # words and lines, each once


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def search_brute(docs, items, count=20):
    """docs: (doc_id, text); items: (item_id, text). A counter of (item_id, rank, doc_id, score)."""
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in counts)
    total = sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = collections.Counter()
    for item, text in items:
        found = []
        for i, c in counts:
            m = 75 + (25 * c.total() * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                found.append((-s, i is not None, i or 0))
        for k, (s, some, i) in enumerate(sorted(found)[:count]):
            out[item, k + 1, i if some else None, -s] += 1
    return out


def searched(docs, items, **options):
    return collections.Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in search.search(docs, items, **options).collect())


def test_search(spark, docs):
    items = table(spark, "benchmark")
    want = search_brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert searched(docs, items) == want and len(want) == 20 * items.count()


ITEMS = [(1, "one two thing3 word5"), (2, None), (3, ""), (4, "日本語 ok END"), (5, "the and10 and10 and10"), (6, "another text under"), (None, "word7 word7"), (8, "nowhere"), (9, "row same thing1")]


@pytest.mark.parametrize("small", [False, True])
def test_search_odd(spark, odd, empty, monkeypatch, small):
    if small:  # many blocks of documents and of items, narrow signatures that say yes too often
        for name, value in (("BLOCK", 8), ("ITEMS", 2), ("TERMS", 2), ("BITS", 1), ("NARROW", 3), ("COUNTED", 10), ("ROW", 3), ("PARTS", 2), ("FIRST", 1)):
            monkeypatch.setattr(search, name, value)
    items = spark.createDataFrame([(*x, 1, 2, 3) for x in ITEMS], "item_id long, text string, doc_id long, score long, key long")
    plain = [(r.doc_id, r.text) for r in odd.collect()]
    for count in (1, 3, 20):
        assert searched(odd, items, count=count) == search_brute(plain, ITEMS, count)
    assert searched(empty, items) == collections.Counter() and searched(odd, items.limit(0)) == collections.Counter()


@pytest.mark.parametrize("seed", range(3))
def test_search_with_ties_and_long_texts(spark, monkeypatch, seed):
    monkeypatch.setattr(search, "BLOCK", 16)
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choices(words, weights=[1 / (k + 1) for k in range(60)], k=r.choice([0, 3, 20, 200, 5000])))) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(3, rows[3][1])] * 3
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 30)))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert searched(docs, spark.createDataFrame(items, "item_id long, text string")) == search_brute(rows, items)


def test_bounds_are_bounds(docs):
    """No document is excluded that could be among the best: bounds are never below scores, and are near enough to exclude most documents."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = search.Items([(1, rows[3][1][:300]), (2, rows[9][1][-200:])])
    raws = [search.lowered(t) for _, t in rows]
    lengths = [len(search.TERM.findall(x)) for x in raws]
    df = collections.Counter(t for x in raws for t in set(search.TERM.findall(x)))
    items.weigh(sum(n > 0 for n in lengths), sum(lengths), {k: df[t] for t, k in zip(items.vocabulary, items.hashes.view(np.int64).tolist(), strict=True)})
    excluded = 0
    for block in search.index(docs).where("width is not null").toArrow().to_batches():
        for width, ids, _, n, highest, planes in search._blocks([block]):
            place = {i: k for k, (i, _) in enumerate(rows)}
            for i, bound in items.bounds(width, n, highest, planes):
                exact = np.array([items.score(raws[place[d]], [i])[0] for d in ids.to_pylist()])
                assert (bound >= exact).all()
                excluded += (bound < 1.25 * exact + 1).mean() / 2
    assert excluded


def test_new_queries_are_registered():
    from winnow.llm import entries

    assert {"op11_merkle_manifest", "op12_quality_rules", "op13_bitsliced_search"} <= set(entries.queries()) & set(entries.oracle_sql())
