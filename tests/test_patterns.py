"""Patterns on Spark against Python's own regular expressions and globs."""

import fnmatch
import re

import pytest
from pyspark.sql import functions as F

from winnow.functions.patterns import all_files_match, any_file_match, any_match, glob_regex, java_regex, literal, lowered, matches, pattern_type, required, search_regex
from winnow.sources.catalog import Catalog, catalog_problems

PATTERNS = ["fix", "use-after-free", r"CVE-\*", r"a\?b", "re:^fix", "re:(?i)FIX", "re:a{,2}b", "re:(", "drivers/*", "*.c", "*usb*", "a[!b]c", "a[b-d]c", "[", "[]x]*", "?", "", "naïve", "re:\\bword\\b", "re:x$", "fix*é", "C++", "re:[[]", "re:(a)?(?(1)b|x)", "re:[a&&b]", "re:[]x]1", "re:[^]a]b", r"re:[\[&]x?", "re:(?P<q>a)(?P=q)b(?#note)", r"re:x\Z"]
TEXTS = ["", "fix", "Fix: a bug", "prefix", "fixes", "drivers/usb/core.c", "drivers/", "CVE-*", "cve-* here", "CVE-2020", "a?b", "abc", "acc", "a\nc", "aab", "aaab", "[", "]x1", "x", "x\n", "xy", "naïve", "Naïve text", "word", "a word b", "fixed é", "c++ code", "use-after-free in x", "x\r", "x ", "ﬁx"]

#: Valid in Python, but not on the JVM: never matched, and told as a problem of the catalog.
BEYOND = ["re:(a)?(?(1)b|x)"]


def expected(p: str, t: str) -> bool:
    """The semantics in plain Python."""
    if p in BEYOND:
        return False
    if p.startswith("re:"):
        try:
            return bool(re.search(p[3:], t))
        except re.error:
            return False
    if re.search(r"(?<!\\)[*?\[]", p):
        return fnmatch.fnmatchcase(t.lower(), p.lower())
    word = literal(p)
    body = re.escape(word)
    return bool(re.search(rf"(?i)\b{body}\b" if re.match(r"\w", word) and re.search(r"\w\Z", word) else f"(?i){body}", t))


def test_truth_table(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = df.select("t", *[matches(p, F.col("t")).alias(f"p{j}") for j, p in enumerate(PATTERNS)]).collect()
    wrong = [(p, r["t"]) for r in rows for j, p in enumerate(PATTERNS) if r[f"p{j}"] != expected(p, r["t"])]
    assert not wrong


def test_patterns_in_a_column(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    kept = spark.createDataFrame([(p, search_regex(p)) for p in PATTERNS if search_regex(p)], "p string, e string")
    got = {(r.p, r.t) for r in texts.join(kept, F.regexp_like(F.col("t"), F.col("e"))).collect()}
    assert got == {(p, t) for p in PATTERNS for t in TEXTS if expected(p, t)}


def test_any_match_is_the_or_of_its_patterns(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    for r in df.select("t", any_match(PATTERNS, F.col("t")).alias("m"), any_match([], F.col("t")).alias("none")).collect():
        assert r["m"] == any(expected(p, r["t"] or "") for p in PATTERNS)
        assert r["none"] is False


@pytest.mark.parametrize(
    ("files", "some", "every"),
    [([], False, False), (None, False, False), (["a.c"], True, True), (["a.c", "b.h"], True, False), (["b.h"], False, False)],
)
def test_file_matches(spark, files, some, every):
    df = spark.createDataFrame([(files,)], "f array<string>")
    r = df.select(any_file_match(["*.c"], F.col("f")).alias("a"), all_files_match(["*.c"], F.col("f")).alias("b"), all_files_match([], F.col("f")).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (some, every, False)


def test_expressions_that_neither_side_takes_are_told(spark):
    c = Catalog([("p", "", 100.0, 0)], [("p", "r", 1, 0)], [("r", "keywords_whitelist", i, p) for i, p in enumerate([*BEYOND, "re:(", "re:[[]", "re:[a&&b]"])])
    assert {p for kind, _, p in catalog_problems(c) if kind == "invalid_regex"} == {*BEYOND, "re:("}


def test_types(spark):
    assert [pattern_type(p) for p in ("re:*", "a*", r"a\*", "[x]", "x")] == ["regex", "glob", "keyword", "glob", "keyword"]
    assert java_regex("(") is None
    assert java_regex("a{,3}") == "(?Ud)a{0,3}"
    assert glob_regex("a") == "(?s)\\Aa\\z"


def test_literals_that_are_searched_first_lose_no_match(spark, capsys):
    """Whatever letters a text has, and however it is put together, any_match gives the same with lowered texts as without; and a pattern that requires a literal has it searched for."""
    some = [*PATTERNS, "mask", "KISS", "i.d.", "disk*", "*Kiss*", "re:\\bGNU\\b", "re:[a-z]+@[a-z]+", "re:(?i)gnu", "re:a\\101", "re:(?:GNU|GCC)x", "x\ny", *(f"word{i}" for i in range(9))]
    texts = [*TEXTS, "maſK", "Kıſs", "KİSS it", "i̇.d.", "İ.D.", "DİSK x", "disk", "a kiss b", "GNU", "gnu", "GCCx", "me@x", "@", "ΣxΣ", "x\ny", "word8", None]
    df = spark.createDataFrame([(t, "İ kiss") for t in texts], "t string, u string")
    both = F.concat(F.coalesce("t", F.lit("")), F.lit("\n"), F.col("u"))
    low, lows = lowered(F.col("t")), [lowered(F.col("t")), lowered(F.col("u"))]
    # a few at once: plans with all of them are slow to compile
    for i in range(0, len(some), 9):
        part = some[i : i + 9]
        pairs = [F.struct(any_match([p], F.col("t")).alias("a"), any_match([p], F.col("t"), [low]).alias("b"), any_match([p], both).alias("c"), any_match([p], both, lows).alias("d")) for p in part]
        for r in df.select("t", F.array(*pairs).alias("x")).collect():
            assert [(p, r["t"]) for p, x in zip(part, r["x"]) if x.a != x.b or x.c != x.d] == []
    every = df.select(any_match(some, F.col("t")).alias("a"), any_match(some, F.col("t"), [low]).alias("b")).collect()
    assert all(r.a == r.b for r in every)
    df.select(any_match(["mit", "re:[a-z]+@x"], F.col("t"), [F.col("u")])).explain()
    plan = capsys.readouterr().out
    assert "Contains(u#" in plan and ", @x)" in plan
    assert (required("\\bGNU\\b"), required("(?i)gnu"), required("a|b"), required("ab+c"), required("x[a]?yz"), required("\\x41")) == ("GNU", "", "", "a", "yz", "")
