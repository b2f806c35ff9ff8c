"""Joins without nested loops, indexes over large catalogs, increments: against plain versions."""

import hashlib
import os.path
import random
import re

import pytest
from pyspark.sql import functions as F

from winnow.functions.literals import fold, index_keys, required
from winnow.functions.patterns import search_regex
from winnow.operators import evidence, literal_index, ordered, prefilter, report, score, tokens
from winnow.plans import bindings as B
from winnow.sources import catalog as C
from winnow.sources import product
from winnow.sources.stages import cut
from winnow.streaming import increments
from winnow.streaming import scores as streaming

SMALL = "/root/testdata/sf0.001"
RECORDS = "record_id string, seq long, subject string, body string, files array<string>"


@pytest.fixture(scope="module")
def docs(spark):
    return B.documents(spark, SMALL).cache()


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


# strings in order


@pytest.mark.parametrize("seed", range(4))
def test_at_or_after(spark, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé/\U0001f600") for _ in range(r.randint(0, 4)))
    points, strings = {word() for _ in range(80)}, {word() for _ in range(r.choice([0, 1, 10, 60]))}
    got = ordered.at_or_after(spark.createDataFrame([(p,) for p in points] + [(None,)], "p string"), spark.createDataFrame([(x,) for x in strings] + [(None,)], "x string"))
    byte = lambda x: x.encode()
    want = {p: min((x for x in strings if byte(x) >= byte(p)), key=byte, default=None) for p in points}
    assert {r_.point: r_.string for r_ in got.collect()} == {p: x for p, x in want.items() if x is not None}


@pytest.mark.parametrize("seed", range(3))
def test_config_dir_is_the_plain_join(spark, seed, capsys):
    r = random.Random(seed)
    path = lambda: "/".join(r.choice(["a", "ab", "b", "net", "netx", "é"]) for _ in range(r.randint(1, 4)))
    dirs = sorted({path() + "/" for _ in range(60)})
    guesses = [path() + r.choice(["", "/", "x"]) for _ in range(60)]
    touched = spark.createDataFrame([(str(i), [g, guesses[0]]) for i, g in enumerate(guesses)], "record_id string, touched array<string>")
    near = lambda g: [d for d in dirs if g.startswith(d[:-1]) or d.startswith(g)]
    want = {(str(i), f"config_dir:{near(x)[0]}") for i, g in enumerate(guesses) for x in (g, guesses[0]) if near(x)}
    found = evidence.config_dir(touched, spark.createDataFrame([(d,) for d in dirs], "dir string"))
    assert {tuple(x) for x in found.collect()} == want
    assert "NestedLoop" not in plan_of(found, capsys) and "CartesianProduct" not in plan_of(found, capsys)


@pytest.mark.parametrize("seed", range(3))
def test_substrings_are_the_plain_join(spark, seed):
    r = random.Random(seed)
    names = ["".join(r.choice("abc._") for _ in range(r.randint(0, 9))) for _ in range(50)]
    guesses = ["x/" + "".join(r.choice("abc._") for _ in range(r.randint(0, 3))) + r.choice(["", "/"]) for _ in range(80)]
    touched = spark.createDataFrame([(str(i), [g]) for i, g in enumerate(guesses)], "record_id string, touched array<string>")
    base = lambda g: g.rstrip("/").rpartition("/")[2]
    want = {(str(i), f"build_log:{base(g)}") for i, g in enumerate(guesses) if base(g) and any(base(g) in n for n in names)}
    assert {tuple(x) for x in evidence.build_log(touched, spark.createDataFrame([(n,) for n in names], "name string")).collect()} == want


def test_substrings_among_very_many_names(spark, capsys):
    names = spark.range(1_000_000).select(F.concat(F.lit("dir/object_"), F.hex("id"), F.lit(".o")).alias("path"))
    touched = spark.createDataFrame([("1", ["x/object_F423F"]), ("2", ["x/object_F4240"]), ("3", ["y/ct_1"]), ("4", ["zz"])], "record_id string, touched array<string>")
    found = evidence.artifact(touched, names)
    assert {r.record_id for r in found.collect()} == {"1", "3"}
    plan = plan_of(found, capsys)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_symbols_in_texts_are_the_plain_join(spark, docs, monkeypatch):
    symbols = ["CONFIG_THE=y", "CONFIG_TION", "CONFIG_OF=m", "CONFIG_ZZZZ=y", "CONFIG_A", "CONFIG_THE-AND=y", "CONFIG_E OF", "CONFIG_É", "CONFIG_-=y", "CONFIG_"]
    needle = lambda s: s.removeprefix("CONFIG_").removesuffix("=y").removesuffix("=m").lower()
    want = {(r.record_id, "config_text:" + s.removesuffix("=y").removesuffix("=m")) for r in docs.collect() for s in symbols if needle(s) and needle(s) in f"{r.subject}\n{r.body}".lower()}
    rows = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    for few in (evidence.FEW_SYMBOLS, 0):
        monkeypatch.setattr(evidence, "FEW_SYMBOLS", few)
        assert {tuple(r) for r in evidence.config_text(docs, rows).collect()} == want and want


def _map_tags(files, mapped):
    under = lambda f, p: "/" in p.lstrip("/") and f.startswith(p.rsplit("/", 1)[0] + "/")
    return {"config_map:" + s for f in files or [] for s, p in mapped if f and (f == p and p or under(f, p))}


@pytest.mark.parametrize("few", [evidence.FEW_SYMBOLS, 0])
def test_all_tags_of_a_record_are_put_together_in_one_exchange(spark, monkeypatch, capsys, few):
    """Every kind of link, looked up together, is the plain join; records without any, repeated ones and ones without an id stay, and one row of each is moved."""
    monkeypatch.setattr(evidence, "FEW_SYMBOLS", few)
    mapped = [("S1", "a/b/x.c"), ("S2", "a/y.c"), ("S3", "z.c"), ("S4", "/r.c"), ("S5", ""), ("S6", "d/e/f/g.c"), ("S1", "a/b/w.c"), ("S7", "/s/t.c")]
    rows = [
        ("one", "usb fix", "the end-of-it", ["a/b/c/d.c", "a/q.c"]), ("two", "plain", None, ["z.c", "/r.c", "y/z.c", ""]), ("three", None, "of\nusbx A-B", None), ("four", "nothing", "zzz", []),
        ("five", "net USB", "", ["d/e/f/g.c", "d/e/h.c", "a/b", None]), ("five", "net", "the", ["a/y.c"]), (None, "usb", "the", ["z.c"]), ("six", "x", "y", ["/s/u.c", "a/bb/x.c"]),
    ]
    symbols = ["CONFIG_THE=y", "CONFIG_USB", "CONFIG_OF=m", "CONFIG_A-B=y", "CONFIG_END-OF", "CONFIG_-"]
    hints = [("usb", "d/e"), ("net", "a/b/deep"), ("usb", "lib/usbcore"), ("plain", "no/where")]
    r = cut(spark.createDataFrame(rows, "record_id string, subject string, body string, files array<string>"), "records")
    paths = cut(spark.createDataFrame(mapped, "symbol string, path string"), "paths")
    log, built = (spark.createDataFrame([(x,)], f"{c} string") for x, c in (("usbcore2.o", "name"), ("x/deep.ko", "path")))
    touched = evidence.with_touched(r, spark.createDataFrame(hints, "keyword string, prefix string"))
    made = lambda: evidence.product_evidence(touched, paths, product.config_dirs(paths), log, built, spark.createDataFrame([(x,) for x in symbols], "symbol string"))
    of_prefix = {"d/e": {"config_dir:d/e/f/", "artifact:e", "build_log:e"}, "a/b/deep": {"config_dir:a/", "artifact:deep"}, "lib/usbcore": {"build_log:usbcore"}, "no/where": set()}

    def tags(subject, body, files):
        low = f"{subject or ''}\n{body or ''}".lower()
        found = _map_tags(files, mapped).union(*(of_prefix[p] for k, p in hints if k in (subject or "").lower()))
        return found | {"config_text:" + s.split("=")[0] for s in symbols if s.split("=")[0].removeprefix("CONFIG_").lower() in low}

    want = [(i, sorted(set().union(*(tags(*x) for k, *x in rows if k == i)) if i else [])) for i, *_ in rows]
    got = [(x.record_id, x.product_evidence) for x in made().collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    each = {(x.record_id, x.tag) for x in evidence.config_map(r, paths).collect()}
    assert each == {(i, t) for i, _, _, files in rows for t in _map_tags(files, mapped)} and each
    o = cut(B.orders(spark, SMALL), "orders")
    mine = B.config_paths(spark, SMALL)
    some = evidence.product_evidence(evidence.with_touched(o, B.hints(spark)), mine, product.config_dirs(mine), product.log_objects(B.log_lines(spark, SMALL)), B.artifacts(spark, SMALL), B.symbols(spark, SMALL))
    plan = plan_of(some, capsys)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "record_id" in line]
    assert not few or (len(moved) == 1 and plan.count("SortMergeJoin") == 0)
    assert some.count() == o.count()


# pre-filter


@pytest.mark.parametrize("few", [prefilter.FEW_LISTS, 0])
def test_records_keep_their_place(spark, monkeypatch, capsys, few):
    """What is known of files goes to the records, whose texts are in no exchange; joined or sent, the result is the same."""
    monkeypatch.setattr(prefilter, "FEW_LISTS", few)
    o, sets = cut(B.orders(spark, SMALL), "orders"), cut(_sets(spark), "sets")
    decided = prefilter.decide(o, B.ORDER_CATALOG, sets)
    flags = {r.record_id for r in evidence.with_artifact(o, sets).union(evidence.in_log(o, sets)).collect()}, {r.record_id for r in evidence.covered(o, sets).collect()}
    rows = decided.collect()
    assert len(rows) == o.count()
    for r in rows:
        if r.reason == "build_artifact":
            assert r.record_id in flags[0]
        if r.reason == "no_kconfig_coverage":
            assert r.record_id not in flags[1] and r.record_id not in flags[0]
    plan = plan_of(decided, capsys)
    if few:
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    # a caller that does not ask for texts moves none
    narrow = plan_of(decided.select("record_id", "action", "reason"), capsys)
    assert all("body" not in line for line in narrow.splitlines() if "Exchange hashpartitioning" in line)


@pytest.mark.parametrize("few", [evidence.FEW_FILES, 0])
def test_single_files_are_summed_up_where_they_are(spark, monkeypatch, capsys, few):
    """What is known of files is sent to the lists: no exchange deals lists by their single files. Joined or sent, the result is the same."""
    monkeypatch.setattr(evidence, "FEW_FILES", few)
    o, sets = cut(B.orders(spark, SMALL), "orders"), cut(_sets(spark), "sets")
    flags = evidence.file_flags(o, sets)
    got = {(r.key.a, r.key.b): (r.has_artifact, r.covered) for r in flags.collect()}
    has = {r.record_id for r in evidence.with_artifact(o, sets).union(evidence.in_log(o, sets)).collect()}
    covered = {r.record_id for r in evidence.covered(o, sets).collect()}
    for r in o.select("record_id", evidence.list_key(F.col("files")).alias("k")).collect():
        assert got.get((r.k.a, r.k.b), (False, False)) == (r.record_id in has, r.record_id in covered)
    plan = plan_of(flags, capsys)
    assert not few or ("hashpartitioning(file" not in plan and "hashpartitioning(at" not in plan)


def test_records_are_tested_before_the_join(spark, monkeypatch, capsys):
    """Where records are joined with what is known of their files, they are decided by themselves and scored before: texts and files are in no exchange."""
    from winnow import queries as Q

    columns = ["seq", "action", "reason", "score", "filter_reason", "src", "n"]
    judged = lambda: Q._judged(spark, SMALL).withColumn("n", F.size("matched_profiles")).select(columns)
    sent = sorted(map(str, judged().collect()))
    monkeypatch.setattr(prefilter, "FEW_LISTS", 0)
    joined = judged()
    assert sorted(map(str, joined.collect())) == sent
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        capsys.readouterr()
        judged().explain("formatted")
        blocks = capsys.readouterr().out.split("\n\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for b in blocks if re.match(r"\(\d+\) Exchange\n", b) for line in b.splitlines() if line.startswith("Input")]
    assert len(moved) == 2 and not any(re.search(r"\b(body|files|subject)#", line) for line in moved), moved


def test_files_are_looked_up_in_one_pass(spark, monkeypatch, capsys):
    """Files that steer the build count as covered, with or without a map, and records are read once for all kinds."""
    plans, write = [], evidence.cut
    monkeypatch.setattr(evidence, "cut", lambda df, name: plans.append(plan_of(df, capsys)) or write(df, name))
    rows = [("a", ["x/Makefile"]), ("b", ["x/y.c", "x/z.mk"]), ("c", ["x/y.c"]), ("d", ["s/t.c"]), ("e", []), ("f", None), ("g", ["s/Kconfig", "q/w.c"]), ("h", ["q/w.h"])]
    r = cut(spark.createDataFrame(rows, "record_id string, files array<string>"), "lists")
    sets = spark.createDataFrame([("dir", "s"), ("artifact", "q/w"), ("file", "s/t.c")], "kind string, value string")
    key = r.select("record_id", evidence.list_key(F.col("files")).alias("key"))
    of = lambda sets: {x.record_id: (x.has_artifact, x.covered) for x in key.join(evidence.file_flags(r, sets), "key").collect()}
    assert of(sets) == {"a": (False, True), "b": (False, True), "d": (False, True), "g": (True, True), "h": (True, False)}
    assert of(sets.where("false")) == {"a": (False, True), "b": (False, True), "g": (False, True)}
    assert [p.count("FileScan parquet") for p in plans] == [1, 1]


def _sets(s):
    return product.compiled_sets(B.config_paths(s, SMALL), B.enabled(s, SMALL), B.artifacts(s, SMALL), product.log_objects(B.log_lines(s, SMALL)))


# large catalogs


PATTERNS = ["fix", "use-after-free", r"CVE-\*", "re:^fix", "re:(?i)FIX", "drivers/*", "*.c", "*usb*", "a[!b]c", "re:foo(bar|baz)+qux", "re:(alpha|beta) gamma", "re:x?y*", "naïve", "C++", "re:\\bword\\b", "fix*é", "re:(?:abc){2,}d", "K", "ſhift", "*i̇x*", "re:(?=lookahead)l", "re:(?!not)thing", "skill", "ai", "re:a_b9", "re:[ab]cdef|ghi", "?host", "host?", "re:(?x) spaced # comment", "lazy dog", "*zy do*", "re:e la", "re:brown.fox jumps", "*o-o*", "re:(quick brown|lazy) (fox|dog)s?", "re:is ſu", "a İ", "*fix*", "**I*", "re:Fix", "re:a-c", "K*", "*e  d*", "*k*"]
TEXTS = ["", None, "fix", "Fix: a bug", "prefix", "drivers/usb/core.c", "x.c", "CVE-* here", "foobarbazqux", "beta gamma", "alphagamma", "naïve", "NAÏVE text", "c++", "a word b", "fixed é", "abcabcd", "K", "k", "SHIFT", "ſhift", "İx", "aİx", "i̇x", "lookahead", "thing", "SKill", "ſkıll", "AI", "aİ", "a_b9", "acdef", "ghi", "ahost", "hosts", "host", "spaced", "use-after-free", "reuse-after-freed", "a-c", "abc", "The quick brown fox jumps", "over the LAZY dog", "crazy do-over", "lazy  dog", "lazy-dog", "no-one", "o-o", "This Sum", "this ſum", "a i", "a ı b", "aa İ", "pre\nFix\nx", "two\nlazy dog\nlines", "lazy\ndog"]


def test_keys_hold_wherever_patterns_match(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    known = [(p, search_regex(p)) for p in PATTERNS if search_regex(p)]
    hits = texts.join(spark.createDataFrame(known, "p string, e string"), F.regexp_like("t", "e")).withColumn("tokens", literal_index.tokens(F.col("t"))).withColumn("joints", literal_index.joints(F.col("t"))).collect()
    assert len(hits) > 40
    for r in hits:
        keys = required(r.p)
        assert not keys or any(k in r.tokens if whole else any(k in t for t in r.tokens) for whole, k in keys), (r.p, r.t)
    assert fold("KſKİ̇ı") == "kskii" and required("use-after-free") == [(True, "after")]
    assert required("re:foo(bar|baz)+qux") == [(False, "foo")] and required("re:x?y*") == [] and set(required("re:(alpha|beta)s?")) == {(False, "alpha"), (False, "beta")}


@pytest.mark.parametrize("few", [literal_index.FEW_LINKS, 0])
def test_index_is_the_plain_join(spark, monkeypatch, few):
    monkeypatch.setattr(literal_index, "FEW_LINKS", few)
    monkeypatch.setattr(literal_index, "MOST_TOKENS", 500 if few else 1)
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(2, "fix"), (2, "fix")], "n int, t string")
    patterns = [(f"r{i % 3}", "keywords_whitelist", p) for i, p in enumerate([*PATTERNS, "re:(", "fix"])]
    plain = sorted(map(repr, score.pattern_join(texts, patterns, "t").collect()))
    assert sorted(map(repr, literal_index.pattern_index(texts, patterns, "t").collect())) == plain and len(plain) > 50
    with pytest.raises(ValueError, match="rename"):
        literal_index.pattern_index(texts.withColumn("token", F.lit(1)), patterns, "t")


def test_scores_by_the_index_are_the_scores(spark, docs):
    """Hits and scores of a catalog of a few hundred rules, by joins and by one Column for each pattern."""
    r = random.Random(3)
    words = sorted({w for x in docs.limit(40).collect() for w in x.body.split() if w.isalpha() and len(w) > 3})
    kinds = ("keywords_whitelist", "keywords_blacklist", "path_whitelist", "commit_whitelist")
    some = lambda k: r.choice(words) if k.startswith("key") else r.choice(["src1/*", "*/en/*", "src2/de/*"]) if k.startswith("path") else r.choice([f"re:^{r.randint(10, 99)}", B.sha(r.randint(0, 50))])
    patterns = [(f"r{i}", k := r.choices(kinds, [8, 1, 1, 1])[0], j, some(k)) for i in range(40) for j in range(3)]
    rules = [(f"p{i}", f"r{j}", r.randint(1, 60), j) for i in range(6) for j in r.sample(range(45), 6)]
    c = C.Catalog([(f"p{i}", "", r.choice([None, 29.0, 100.0, 70.0]), i) for i in range(6)], rules, patterns)
    rows = score.scored(docs, c)
    plain = {tuple(x) for x in score.profile_scores(rows).collect() if x.blocked or x.raw_total > 0}
    matched = {(x.record_id, p) for x in rows.collect() for p in x.matched_profiles}
    found = {tuple(x) for x in literal_index.catalog_scores(docs, c).collect()}
    assert found == plain and {x[:2] for x in found} == matched and plain
    hits = lambda df: sorted((x.record_id, x.rule, x.kind, x.pattern, x.value, x.ord) for x in df.collect())
    for side in ("whitelist", "blacklist"):
        assert hits(literal_index.catalog_hits(docs, c, side)) == hits(score.pattern_hits(docs, c, side))


def test_tests_grow_with_hits_and_not_with_the_catalog(spark):
    texts = spark.createDataFrame([(i, f"record {i} mentions subsystem{i * 7} and device_{i}x") for i in range(300)], "n int, t string")
    sizes = {}
    for n in (1_000, 100_000):
        patterns = [("r", "keywords_whitelist", p) for i in range(n // 4) for p in (f"subsystem{i}", f"*device_{i}x*", f"re:absent{i} (now|then)", f"Missing-{i}-word")]
        keyed, others = literal_index.keyed_patterns(texts, patterns)
        tested = literal_index.survivors(texts, "t", keyed).count()
        hits = literal_index.pattern_index(texts, patterns, "t")
        sizes[n] = tested, hits.count()
        assert not others
    # 300 texts: a subsystem and a device each, of those that the catalog has; parts of numbers add a few tests
    assert sizes[100_000][1] == 600 and sizes[100_000][0] < 2 * 600 and sizes[1_000][0] < 2 * sizes[1_000][1] + 10


def test_a_long_text_is_not_copied_for_each_token(spark):
    """A text of 60,000 words with patterns whose keys are words, parts and joints: copied for each token it would take many times a task's memory."""
    texts = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(60_000))), (2, "word7")], "n int, t string")
    patterns = [("r", "keywords_whitelist", p) for p in ("word7", "re:ord5999[0-9]", "word1 word2", "re:(word41|word42)", "word60000")]
    found = {(r.n, r.pattern) for r in literal_index.pattern_index(texts, patterns, "t").select("n", "pattern").collect()}
    assert found == {(1, p) for _, _, p in patterns[:4]} | {(2, "word7")}


@pytest.mark.parametrize("few", [literal_index.FEW_LINKS, 0])
def test_two_words_are_decided_by_parts_of_a_text(spark, monkeypatch, capsys, few):
    """Patterns of two words are tested on two parts that follow each other: no text is tested whole, or moved, and the hits are those of the plain join."""
    monkeypatch.setattr(literal_index, "FEW_LINKS", few)

    def whole(*_):
        raise AssertionError("a text is tested whole")

    monkeypatch.setattr(literal_index, "survivors", whole)
    r = random.Random(5)
    words = ["is", "of", "this", "Of", "THE", "the", "ſum", "Sum", "sum", "\u212aey", "key", "İt", "it", "a_b", "x", "(of", "of,", "sum.", "é", "theé", "the\u0301", "", "", "of\nthe", "the\tof", "\u00a0of", "Σ"]
    texts = [(n, " ".join(r.choices(words, k=r.randint(0, 14)))) for n in range(400)] + [(400, None), (401, "of"), (402, " "), (403, "of the"), (403, "of the"), (404, "x" * 3000 + "of thex" + "y" * 3000)]
    pairs = ["is of", "of the", "the of", "this sum", "sum the", "key it", "it key", "a_b x", "of Sum", "he of", "m th"]
    patterns = [(f"r{n % 3}", "keywords_whitelist", made) for n, p in enumerate(pairs) for made in (p, f"*{p.lower()}*", f"re:{p}", p.upper())] + [("again", "keywords_whitelist", "of the")]
    df = cut(spark.createDataFrame(texts, "n int, t string"), "texts")
    known = literal_index.keyed_patterns(df, patterns)[0].select("pattern").distinct().count()
    plain = sorted(map(repr, score.pattern_join(df, patterns, "t").collect()))
    found = literal_index.pattern_index(df, patterns, "t")
    assert sorted(map(repr, found.collect())) == plain and len(plain) > 500 and known > 30
    narrow = plan_of(found.select("n", "rule", "pattern").where("length(pattern) > 0"), capsys)
    assert all(" t#" not in line and ", t#" not in line for line in narrow.splitlines() if "Exchange hashpartitioning" in line)
    assert literal_index.pattern_index(df, [], "t").count() == 0
    # beside other patterns as well
    monkeypatch.undo()
    monkeypatch.setattr(literal_index, "FEW_LINKS", few)
    mixed = [*patterns, ("other", "keywords_whitelist", "sum"), ("other", "keywords_whitelist", "re:(of|is)\\s+the")]
    plain = sorted(map(repr, score.pattern_join(df, mixed, "t").collect()))
    for worth in (1, 1000):
        monkeypatch.setattr(literal_index, "WORTH_PARTS", worth)
        assert sorted(map(repr, literal_index.pattern_index(df, mixed, "t").collect())) == plain


def test_short_words_at_open_ends_have_keys(spark):
    """Patterns of two short words are met at a short joint, and not tested against every text."""
    texts = spark.createDataFrame([("proof iterates",), ("of it",), ("of - Item",), ("o fit",), ("if it",), ("of",)], "t string")
    patterns = [("r", "keywords_whitelist", p) for p in ("re:of it", "*of it*", "re:of.it", "of it")]
    keyed, others = literal_index.keyed_patterns(texts, patterns)
    assert {p for _, _, p in others} == {"re:of.it"} and literal_index.survivors(texts, "t", keyed).where("t in ('o fit', 'if it', 'of')").isEmpty()
    found = sorted(map(repr, literal_index.pattern_index(texts, patterns, "t").collect()))
    assert found == sorted(map(repr, score.pattern_join(texts, patterns, "t").collect())) and len(found) == 7


def test_all_expressions_are_asked_for_in_one_job(spark):
    from winnow.functions import patterns as P

    rules = [f"re:^one{i}_[a-z]+(?P<a_{i}>x)(?P=a_{i})$" for i in range(200)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("expressions", "asked")
    P.prepare(rules)
    assert len(tracker.getJobIdsForGroup("expressions")) <= 2
    P.any_match(rules, F.col("x"))
    assert len(tracker.getJobIdsForGroup("expressions")) <= 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all(P._taken[P._translated(r[3:])] for r in rules)


def test_groups_with_underscores(spark):
    from winnow.functions.patterns import any_match, matches

    df = spark.createDataFrame([("abab",), ("aba",), ("xyxy zz",)], "t string")
    p = ["re:(?P<a_b>ab)(?P=a_b)", "re:(?P<_x>xy)(?P<y_>x)?(?P=_x)"]
    assert [tuple(r) for r in df.select(*(matches(x, F.col("t")) for x in p), any_match(p, F.col("t"))).collect()] == [(True, False, True), (False, False, False), (False, True, True)]


# makefiles


def test_paths_are_normalised(spark):
    r = random.Random(1)
    paths = ["/".join(r.choice(["..", ".", "a", "b.c", "", "d..e", "...", "x"]) for _ in range(r.randint(1, 8))) for _ in range(400)] + ["", "/", "//", "///", "/..", "//..", "../..", "a/.."]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for row in df.select("p", product.normal_path(F.col("p")).alias("n")).collect():
        assert row.n == os.path.normpath(row.p), row.p


@pytest.mark.parametrize(("folder", "token", "want"), [("a/b", "../../c.o", "c.c"), ("p.q", "../z.o", "z.c"), ("a/b", "../x.y/../d.o", "a/d.c"), ("", "./x.o", "x.c"), (".", "x/../../y.o", "../y.c"), ("a", "/abs/./z.o", "/abs/z.c")])
def test_makefile_paths(spark, folder, token, want):
    lines = spark.createDataFrame([(folder, f"obj-$(CONFIG_A) += {token}")], "dir string, line string")
    assert [r.path for r in product.makefile_map(lines, F.col("dir")).collect()] == [want]
    assert [r.path for r in product.history_paths(spark.createDataFrame([("r1", f"{folder}/Makefile".lstrip("/"), f"obj-$(CONFIG_A) += {token}")], "rev string, path string, text string")).collect()] == [want]


def test_history_is_parsed_once_for_each_text(spark):
    r = random.Random(2)
    versions = [f"obj-$(CONFIG_{c}) += {c.lower()}.o {c.lower()}{i}.o\n" for i, c in enumerate("ABC")] + [None]
    blobs = [(seq, f"d{k}/Makefile", versions[(seq // (5 + k) + k) % 4]) for k in range(3) for seq in range(60) if r.random() < 0.8 or seq == 0]
    df = spark.createDataFrame(blobs + blobs[:20], "seq long, path string, text string")
    spans = product.history_spans(df)
    assert spans.select("digest").distinct().count() == 3
    intervals = cut(product.history_intervals(df), "intervals")
    for at in (0, 7, 31, 59):
        now = {}
        for seq, path, text in sorted(blobs, key=lambda b: b[0]):
            if seq <= at:
                now[path] = text
        rows = spark.createDataFrame([("r", p, t) for p, t in now.items()], "rev string, path string, text string")
        want = {(x.symbol, x.path) for x in product.history_paths(rows).collect()}
        assert {tuple(x) for x in product.map_at(intervals, at).collect()} == want


# fingerprint, tokens, details


def test_fingerprint_is_a_sum(spark, capsys):
    frames = B.DOC_CATALOG.frames(spark)
    one = C.fingerprint(*frames)
    plan = plan_of(one, capsys)
    assert "collect_list" not in plan and "partial_sum" in plan
    assert one.first()[0] == C.fingerprint(*(f.orderBy(F.rand(3)).repartition(3) for f in frames)).first()[0]
    twice = frames[0].union(frames[0].limit(1))
    assert C.fingerprint(twice, *frames[1:]).first()[0] != one.first()[0]


def test_a_fingerprint_is_of_whole_digests(spark):
    """Every digit of every line's digest counts."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    patterns = [("r", "k", n, f"p{n}") for n in range(300)]
    frames = spark.createDataFrame(patterns, "rule string, kind string, ord int, pattern string"), spark.createDataFrame([("a", 50.0)], "profile string, weight double"), spark.createDataFrame([("a", "r", 7)], "profile string, rule string, weight int")
    digests = [sha("\t".join(("pattern", *map(str, p)))) for p in patterns] + [sha("profile\ta\t50.0"), sha("rule\ta\tr\t7")]
    assert {len(h) for h in digests} == {C.LANE * C.LANES}
    lanes = [sum(int(h[at : at + 16], 16) for h in digests) for at in (0, 16, 32, 48)]
    assert C.fingerprint(*frames).first()[0] == sha(":".join(map(str, (len(digests), *lanes))))


@pytest.mark.parametrize("tracked", [64, tokens.TRACKED])
def test_most_frequent_tokens_are_exact(spark, docs, tracked):
    every = cut(tokens.tokens_of(docs, "body"), "tokens")
    plain = [tuple(r) for r in every.groupBy("token").count().orderBy(F.desc("count"), "token").limit(50).collect()]
    assert [tuple(r) for r in tokens.most_frequent(every, 50, tracked).orderBy(F.desc("n"), "token").collect()] == plain
    flat = spark.range(3000).select(F.col("id").cast("string").alias("token"))
    assert [r.token for r in tokens.most_frequent(flat, 3, tracked).orderBy("token").collect()] == ["0", "1", "10"]
    assert tokens.most_frequent(flat.limit(0), 3, tracked).collect() == [] and tokens.most_frequent(flat.limit(2), 3, tracked).count() == 2


def test_details_hold_kept_and_dropped_once(spark):
    kept = spark.createDataFrame([("aabb", 1, "k"), ("aabb", 0, "first"), (None, 2, "x"), ("", 3, "x")], "record_id string, seq long, subject string")
    dropped = spark.createDataFrame([("aabb", 5, "d", "no"), ("ccdd", 6, "d", "no")], "record_id string, seq long, subject string, filter_reason string")
    assert {(r.record_id, r.subject, r.filter_reason, r.s1, r.s2) for r in report.details(kept, dropped).collect()} == {("aabb", "first", None, "aa", "bb"), ("ccdd", "d", "no", "cc", "dd")}


# increments


def test_a_killed_run_leaves_nothing(spark, docs, tmp_path):
    table = increments.scores_table(spark, str(tmp_path / "t"))
    increments.score_batch(docs.limit(50), table, B.DOC_CATALOG, "f", "one")
    # killed after its rows were written and before its manifest
    at = f"{table.path}/batches/_batch=two"
    table.rows().drop("_batch", "_place").write.parquet(at)
    assert increments.current_scores(table).count() == 50 and not table.has("two")
    increments.score_batch(docs, table, B.DOC_CATALOG, "f", "two")
    rows = table.rows()
    assert rows.count() == docs.count() == increments.current_scores(table).count() and rows.where("_batch = 'two'").count() == docs.count() - 50
    increments.score_batch(docs.limit(3).withColumn("body", F.lit("other")), table, B.DOC_CATALOG, "f", "two")
    assert table.rows().count() == docs.count()
    # changed texts and a changed catalog are scored again
    changed = docs.withColumn("body", F.when(F.col("seq") < 10, "apache license").otherwise(F.col("body")))
    increments.score_batch(changed, table, B.DOC_CATALOG, "f", "three")
    assert table.rows().where("_batch = 'three'").count() == docs.where("seq < 10").count()
    want = {(r.record_id, r.score) for r in score.scored(changed, B.DOC_CATALOG).collect()}
    assert {(r.record_id, r.score) for r in increments.current_scores(table).collect()} == want
    increments.score_batch(changed, table, B.DOC_CATALOG, "g", "four")
    assert table.rows().where("_batch = 'four'").count() == docs.count()
    table.drop("four")
    assert {r.fingerprint for r in increments.current_scores(table).collect()} == {"f"}


def test_later_steps_go_with_what_they_are_made_of(spark, tmp_path):
    steps, made = increments.Steps(spark, str(tmp_path), ("a", "b", "c")), []

    def make(name, n):
        def run():
            made.append(name)
            return spark.range(n).toDF("x")

        return run

    for step in "abc":
        assert steps.run(step, "1", make(step, 2)).count() == 2
    for step in "abc":
        steps.run(step, "1", make(step, 9))
    assert made == ["a", "b", "c"]
    assert steps.run("b", "2", make("b", 3)).count() == 3 and steps.made_of("c") is None and steps.made_of("a") == "1"
    assert steps.run("c", "2", make("c", 4)).count() == 4 and made == ["a", "b", "c", "b", "c"]
    assert steps.invalidate("a") == ["a", "b", "c"] and steps.made_of("b") is None


def test_stream_decides_as_a_batch_does(spark, tmp_path):
    o, sets = cut(B.orders(spark, SMALL), "orders"), cut(_sets(spark), "sets")
    table = increments.scores_table(spark, str(tmp_path / "out"))
    schema = f"{streaming.RECORD}, author_time long"

    def run():
        read = streaming.read_stream(spark, str(tmp_path / "in"), schema)
        streaming.decide_stream(streaming.once(read, "author_time", "10000 days"), table, B.ORDER_CATALOG, "f", str(tmp_path / "state"), sets).awaitTermination()
        return {(r.record_id, r.action, r.reason) for r in increments.current_scores(table).collect()}

    half = o.where("seq % 2 = 0")
    half.write.json(str(tmp_path / "in"))
    batch = lambda rows: {(r.record_id, r.action, r.reason) for r in prefilter.decide(rows, B.ORDER_CATALOG, sets).collect()}
    assert run() == batch(half)
    o.write.mode("append").json(str(tmp_path / "in"))
    assert run() == batch(o)
    assert table.rows().count() == o.count() and run() == batch(o)


def test_a_batch_is_read_once(spark, tmp_path):
    """A batch that is decided with sets reads its records once, however many steps ask for them."""
    o, sets = B.orders(spark, SMALL), cut(_sets(spark), "sets")
    read = spark.sparkContext.accumulator(0)
    rows = o.rdd.map(lambda r: (read.add(1), r)[1])
    n = o.count()
    table = increments.scores_table(spark, str(tmp_path / "t"))
    increments.score_batch(spark.createDataFrame(rows, o.schema), table, B.ORDER_CATALOG, "f", "one", sets)
    assert read.value == n == table.rows().count()
    increments.score_batch(o.limit(0), table, B.ORDER_CATALOG, "f", "none", sets)
    assert table.has("none") and table.rows().count() == n


def test_steps_of_a_batch_move_no_texts(spark, tmp_path, monkeypatch, capsys):
    """Digests tell which records repeat or were scored before, and scores are joined with what is known of files: texts and files are in no exchange, and a batch without records reads no table."""
    o, sets = cut(B.orders(spark, SMALL), "orders"), cut(_sets(spark), "sets")
    moved, read, write, commit = [], [], increments.cut, increments.Table.commit

    def told(df):
        capsys.readouterr()
        df.explain("formatted")
        blocks = capsys.readouterr().out.split("\n\n")
        moved.extend(line for b in blocks if re.match(r"\(\d+\) Exchange\n", b) for line in b.splitlines() if line.startswith("Input"))
        read.append(sum("/t/batches" in b for b in blocks))

    monkeypatch.setattr(prefilter, "FEW_LISTS", 0)
    monkeypatch.setattr(increments, "cut", lambda df, name: told(df) or write(df, name))
    monkeypatch.setattr(increments.Table, "commit", lambda self, batch, rows, note="": told(rows) or commit(self, batch, rows, note))
    table = increments.scores_table(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        for batch, rows in (("one", o.where("seq % 2 = 0")), ("two", o.where("seq % 2 = 1"))):
            increments.score_batch(rows, table, B.ORDER_CATALOG, "f", batch, sets)
        assert any(read)
        del read[:]
        increments.score_batch(o.where("seq < 0"), table, B.ORDER_CATALOG, "f", "none", sets)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved and not any(re.search(r"\b(body|files|subject)#", line) for line in moved), moved
    assert read and not any(read)
    assert table.has("none") and table.rows().count() == increments.current_scores(table).count() == o.count()


@pytest.mark.parametrize("few", [increments.FEW_REPEATED, 0])
def test_repeated_and_known_records_of_a_batch_with_sets(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(increments, "FEW_REPEATED", few)
    o, sets = cut(B.orders(spark, SMALL), "orders"), cut(_sets(spark), "sets")
    other = o.where("seq % 4 = 0").withColumn("body", F.lit("other"))
    unnamed = o.limit(1).withColumn("record_id", F.lit(None).cast("string"))
    table = increments.scores_table(spark, str(tmp_path / "t"))
    add = lambda rows, batch: increments.score_batch(rows, table, B.ORDER_CATALOG, "f", batch, sets)
    n, m = o.count(), other.count()
    add(o.union(o.where("seq % 3 = 0")).union(other).union(unnamed).union(unnamed), "one")
    assert table.rows().count() == n + m + 1
    last = {r.record_id: r.content for r in increments.current_scores(table).collect()}
    both = o.union(other).withColumn("content", increments.content_digest())
    assert {k: v for k, v in last.items() if k} == {r.record_id: r.c for r in both.groupBy("record_id").agg(F.max("content").alias("c")).collect()}
    # what is not the content scored last is new: of records with two the lesser one; rows without an id always
    add(o.union(o).union(unnamed), "two")
    lesser = sum(last[r.record_id] != r.content for r in o.withColumn("content", increments.content_digest()).collect())
    assert 0 < lesser < m and table.rows().where("_batch = 'two'").count() == lesser + 1
    want = {(r.record_id, r.action, r.reason) for r in prefilter.decide(o, B.ORDER_CATALOG, sets).collect()}
    add(o, "three")
    got = {(r.record_id, r.action, r.reason) for r in increments.current_scores(table).join(o.withColumn("content", increments.content_digest()).select("record_id", "content"), ["record_id", "content"], "left_semi").collect()}
    assert got == want


def test_a_stream_takes_its_files_by_parts(spark, tmp_path):
    """Micro-batches of one file each decide as one batch does; records that come again in a later one are left out."""
    o, sets = cut(B.orders(spark, SMALL), "orders"), cut(_sets(spark), "sets")
    report.write_lines(o.union(o.where("seq % 5 = 0")).repartition(3), str(tmp_path / "in"), compression="gzip")
    assert all(f.suffix == ".gz" for f in (tmp_path / "in").glob("part-*"))
    table = increments.scores_table(spark, str(tmp_path / "out"))
    read = streaming.read_stream(spark, str(tmp_path / "in"), f"{streaming.RECORD}, author_time long", 1)
    streaming.decide_stream(streaming.once(read, "author_time", "10000 days"), table, B.ORDER_CATALOG, "f", str(tmp_path / "state"), sets).awaitTermination()
    assert table.manifests().where("n > 0").count() == 3 and table.rows().count() == o.count()
    want = {(r.record_id, r.action, r.reason) for r in prefilter.decide(o, B.ORDER_CATALOG, sets).collect()}
    assert {(r.record_id, r.action, r.reason) for r in increments.current_scores(table).collect()} == want


def test_invalid_expressions_are_listed(spark):
    bad = ["re:(", "re:(a)?(?(1)b|x)", "re:*"]
    c = C.Catalog(patterns=[("r", "keywords_whitelist", i, p) for i, p in enumerate([*bad, "re:a(?P<b_c>d)", "(", "re:x"])])
    assert [r.pattern for r in C.pattern_problems(spark, c).collect()] == bad
