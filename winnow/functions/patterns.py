r"""Patterns as Columns: keyword, glob and regular expression.

A pattern is a string of one of three types:

* ``re:EXPR``: a regular expression that is searched for, case-sensitive; one that is invalid, or that the JVM cannot express, never matches.
* with an unescaped ``*``, ``?`` or ``[``: a glob over the whole lower-cased text.
* else a keyword: case-insensitive, as a whole word if it starts and ends with a word
  character, anywhere otherwise. ``\*``, ``\?`` and ``\[`` stand for the characters.

All Columns are built from literals on the driver, so the JVM compiles each expression once and
matching stays within generated code. A null text is an empty one.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable
from functools import cache, reduce
from operator import or_
from re import _constants as C  # noqa: PLC2701
from re import _parser as P  # noqa: PLC2701

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_META = re.compile(r"(?<!\\)[*?\[]")
#: Expressions that are joined into one alternation at most; longer ones outgrow generated methods.
CHUNK = 50
#: Keywords of an alternation up to which each is searched for as a literal before the expression runs; more searches cost as much as the expression.
SEARCHED = 8
#: The letters beyond ASCII that equal an ASCII letter where case is ignored, and these.
_ODD, _PLAIN = "ſ\u212aİı", "skii"


def pattern_type(pattern: str) -> str:
    if pattern.startswith("re:"):
        return "regex"
    return "glob" if _META.search(pattern) else "keyword"


def pattern_type_column(pattern: Column) -> Column:
    """pattern_type of a column of patterns."""
    return F.when(pattern.startswith("re:"), "regex").when(pattern.rlike(r"(?<!\\)[*?\[]"), "glob").otherwise("keyword")


def literal(pattern: str) -> str:
    """A keyword without its escapes."""
    return re.sub(r"\\([*?\[])", r"\1", pattern)


def quoted(text: str) -> str:
    """text as a part of a JVM expression that matches it alone."""
    return "".join(c if c.isalnum() or c == "_" or ord(c) > 127 else f"\\x{{{ord(c):x}}}" for c in text)


def is_word(text: str) -> bool:
    """Whether a keyword is held to word boundaries."""
    return bool(re.match(r"\w", text) and re.search(r"\w\Z", text))


def _translated(body: str) -> str | None:
    """A valid Python expression in the JVM's dialect, character by character; None for one with a conditional group, which the JVM lacks.

    Within classes the JVM knows nested classes and intersections, which Python does not; groups' names (the JVM's have no
    underscores, so groups are numbered), comments, open repetitions and the end of the text are written otherwise.
    """
    out, i, n, inside = [], 0, len(body), False
    names: dict[str, str] = {}
    while i < n:
        c = body[i]
        if c == "\\":
            out.append("\\z" if body[i + 1 : i + 2] == "Z" and not inside else body[i : i + 2])
            i += 2
        elif inside:
            inside = c != "]"
            out.append("\\" + c if c in "[&" else c)
            i += 1
        elif c == "[":
            inside = True
            out.append(c)
            i += 1
            if body[i : i + 1] == "^":
                out.append("^")
                i += 1
            if body[i : i + 1] == "]":
                out.append("\\]")
                i += 1
        elif body.startswith("(?(", i):
            return None
        elif m := re.match(r"\(\?P<(\w+)>", body[i:]):
            out.append(f"(?<{names.setdefault(m[1], f'g{len(names)}')}>")
            i += len(m[0])
        elif m := re.match(r"\(\?P=(\w+)\)", body[i:]):
            out.append(f"\\k<{names[m[1]]}>")
            i += len(m[0])
        elif m := re.match(r"\(\?#[^)]*\)", body[i:]):
            i += len(m[0])
        elif m := re.match(r"\{,(\d+)\}", body[i:]):
            out.append("{0," + m[1] + "}")
            i += len(m[0])
        else:
            out.append(c)
            i += 1
    # Python's classes know Unicode, and its dot stops at newlines alone
    return "(?Ud)" + "".join(out)


#: What is known of expressions: whether the JVM takes them.
_taken: dict[str, bool] = {}


def _all_compile(spark: SparkSession, expressions: list[str]) -> bool:
    """Whether the JVM takes all of the expressions, as one job."""
    rows = spark.createDataFrame([(e,) for e in expressions], "e string").repartition(1)
    try:
        rows.select(F.regexp_like(F.lit(""), F.col("e")).alias("x")).agg(F.count_if("x")).collect()
    except (PySparkException, Py4JJavaError) as e:
        # generated code tells of a bad expression in the JVM's own words
        if "PatternSyntaxException" not in str(e) and "INVALID_PARAMETER_VALUE" not in str(e):
            raise
        return False
    return True


def prepare(patterns: Iterable[str]) -> None:
    """Ask once for all patterns whether the JVM takes their expressions, so that no Column built of them has to.

    All are tested in one job; only where it fails, in halves down to the ones that are refused. Without a session nothing is asked, nor remembered.
    """
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    bodies = dict.fromkeys(p[3:] for p in patterns if p.startswith("re:"))
    todo = [[e for e in dict.fromkeys(_translated(b) for b in bodies if _python_takes(b)) if e is not None and e not in _taken]]
    while todo:
        some = todo.pop()
        if not some:
            continue
        if _all_compile(spark, some):
            _taken.update(dict.fromkeys(some, True))
        elif len(some) == 1:
            _taken[some[0]] = False
        else:
            todo += [some[: len(some) // 2], some[len(some) // 2 :]]


@cache
def _python_takes(body: str) -> bool:
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", FutureWarning)
            re.compile(body)
    except (re.error, OverflowError, RecursionError):
        return False
    return True


def java_regex(body: str) -> str | None:
    """A Python expression in the JVM's dialect, or None where it is invalid in either: it never matches, and catalog_problems tells of it."""
    if not _python_takes(body):
        return None
    found = _translated(body)
    if found is None:
        return None
    if found not in _taken:
        prepare(["re:" + body])
    return found if _taken.get(found, True) else None


def glob_regex(pattern: str) -> str:
    """A lower-cased glob as an expression for the whole text."""
    out, i, n = [], 0, len(pattern)
    while i < n:
        c = pattern[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            start = i + (pattern[i : i + 1] == "!")
            end = pattern.find("]", start + 1) if pattern[start : start + 1] == "]" else pattern.find("]", start)
            if end < 0:
                out.append(quoted("["))
                continue
            out.append(_glob_class(pattern[start:end], negated=start > i))
            i = end + 1
        else:
            out.append(quoted(c))
    return "(?s)\\A" + "".join(out) + "\\z"


def _glob_class(body: str, negated: bool) -> str:
    parts, i = [], 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            if body[i] <= body[i + 2]:
                parts.append(f"{quoted(body[i])}-{quoted(body[i + 2])}")
            i += 3
        else:
            parts.append(quoted(body[i]))
            i += 1
    if not parts:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(parts)}]"


def lowered(text: Column) -> Column:
    """The text as keywords' literals are searched for in it: whatever a keyword of ASCII characters matches holds it here, lower-cased."""
    filled = F.coalesce(text, F.lit(""))
    # most texts have none of these letters, and finding that out costs less than mapping every letter
    odd = reduce(or_, [filled.contains(c) for c in _ODD])
    return F.lower(F.when(odd, F.translate(filled, _ODD, _PLAIN)).otherwise(filled))


def with_lowered(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The rows with lowered() of each column as _low_<column>, unless they have it: a column of its own is computed once, however many patterns search it."""
    return rows.withColumns({f"_low_{c}": lowered(F.col(c)) for c in columns if f"_low_{c}" not in rows.columns})


def may_match(words: Iterable[str], lows: Iterable[Column]) -> Column | None:
    """Whether any of the keywords' literals occurs in any of the lowered texts: where none does, no keyword matches. None where that cannot be told, or not for less than the expression costs."""
    words, lows = list(words), list(lows)
    # line ends may stand between two texts that are matched as one
    if not lows or len(words) > SEARCHED or not all(w.isascii() and "\n" not in w for w in words):
        return None
    return reduce(or_, [low.contains(w.lower()) for w in words for low in lows])


@cache
def required(body: str) -> str:
    """A string of ASCII characters that every match of a valid, case-sensitive Python expression holds; empty where none is seen."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)
        parsed = P.parse(body)
    if parsed.state.flags & ~re.UNICODE.value:
        return ""
    runs = [""]
    for op, value in parsed:
        if op is C.LITERAL and value < 128:
            runs[-1] += chr(value)
        elif op is not C.AT:
            runs.append("")
    longest = max(runs, key=len)
    # as it stands there, so that it is no escape that the JVM reads in another way
    return longest if longest in body else ""


def _search(body: str, text: Column) -> Column:
    """Whether an expression, valid in Python and given to the JVM as java_regex tells, is found; texts without what it requires are not searched."""
    found = text.rlike(java_regex(body))
    return text.contains(needle) & found if (needle := required(body)) else found


def matches(pattern: str, text: Column) -> Column:
    """Whether the text matches, as a Column that is never null."""
    text = F.coalesce(text, F.lit(""))
    kind = pattern_type(pattern)
    if kind == "regex":
        return F.lit(False) if java_regex(pattern[3:]) is None else _search(pattern[3:], text)
    if kind == "keyword":
        return text.rlike(_keyword(literal(pattern)))
    low, lowered = pattern.lower(), F.lower(text)
    inner = low.strip("*")
    if inner and not re.search(r"[*?\[]", inner):
        if low == inner + "*":
            return lowered.startswith(inner)
        if low == "*" + inner:
            return lowered.endswith(inner)
        if low == f"*{inner}*":
            return lowered.contains(inner)
    return lowered.rlike(glob_regex(low))


def _keyword(word: str) -> str:
    return rf"(?iUd)\b{quoted(word)}\b" if is_word(word) else f"(?iUd){quoted(word)}"


def search_regex(pattern: str) -> str | None:
    """One expression that finds what the pattern matches, for patterns kept in a column; None for an invalid one.

    A glob's expression lower-cases by itself.
    """
    kind = pattern_type(pattern)
    if kind == "regex":
        return java_regex(pattern[3:])
    if kind == "keyword":
        return _keyword(literal(pattern))
    return "(?iu)" + glob_regex(pattern.lower())


def any_match(patterns: Iterable[str], text: Column, lows: Iterable[Column] = ()) -> Column:
    """Whether any pattern matches; false without patterns. Keywords are tested as one alternation.

    lows: columns of lowered() texts that together are the text. With them keywords' expressions run only where one of their literals occurs.
    """
    patterns, lows = list(dict.fromkeys(patterns)), list(lows)
    words = [literal(p) for p in patterns if pattern_type(p) == "keyword" and is_word(literal(p))]
    others = [literal(p) for p in patterns if pattern_type(p) == "keyword" and not is_word(literal(p))]
    filled = F.coalesce(text, F.lit(""))

    def tested(some: list[str], bound: str) -> Column:
        found, may = filled.rlike(f"(?iUd){bound}(?:{'|'.join(map(quoted, some))}){bound}"), may_match(some, lows)
        return found if may is None else may & found

    tests = [tested(words[i : i + CHUNK], r"\b") for i in range(0, len(words), CHUNK)]
    tests += [tested(others[i : i + CHUNK], "") for i in range(0, len(others), CHUNK)]
    prepare(patterns)
    searched = {b: e for p in patterns if pattern_type(p) == "regex" and (e := java_regex(b := p[3:])) is not None}
    # expressions that refer to their groups keep them: numbers and names would change in an alternation
    alone = [b for b, e in searched.items() if re.search(r"\\[1-9]|\\k<|\(\?<[A-Za-z]", e)]
    # a few that require a string are searched for it first, and run only where it occurs
    sure = [b for b in searched if b not in alone and required(b)]
    alone += sure if len(sure) <= SEARCHED else []
    joined = [f"(?:{e})" for b, e in searched.items() if b not in alone]
    tests += [_search(b, filled) for b in alone]
    tests += [filled.rlike("|".join(joined[i : i + CHUNK])) for i in range(0, len(joined), CHUNK)]
    for p in patterns:
        if pattern_type(p) == "glob":
            inner = p.strip("*")
            may = None if re.search(r"[*?\[]", inner) else may_match([inner], lows)
            tests.append(matches(p, text) if may is None else may & matches(p, text))
    return reduce(or_, tests, F.lit(False)) if tests else F.lit(False)


def any_file_match(patterns: Iterable[str], files: Column) -> Column:
    """Whether any pattern matches any file."""
    patterns = list(patterns)
    return F.coalesce(F.exists(files, lambda f: any_match(patterns, f)), F.lit(False)) if patterns else F.lit(False)


def all_files_match(patterns: Iterable[str], files: Column) -> Column:
    """Whether every file matches some pattern; false without files or patterns."""
    patterns = list(patterns)
    if not patterns:
        return F.lit(False)
    return F.coalesce((F.size(files) > 0) & F.forall(files, lambda f: any_match(patterns, f)), F.lit(False))
