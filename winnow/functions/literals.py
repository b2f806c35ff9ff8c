r"""What a text must hold for a pattern to match: the keys of an index over large catalogs.

A key is a run of lower-case ASCII letters, digits and underscores, as whole token of the folded text or as a part of one; or a joint: the end of
a token and the start of the next one, which a literal with several words asks for, and fewer texts hold than any of its words. Folding lower-cases, and
maps the four letters beyond ASCII that are equal to an ASCII letter where case is ignored; the dot that lower-casing parts from one of
them goes. So whatever a pattern matches, its keys, if it has any, tell the texts that can match from those that cannot.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable
from re import _constants as C  # noqa: PLC2701
from re import _parser as P  # noqa: PLC2701

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.patterns import is_word, literal, pattern_type

#: A token of a folded text, and the letters that folding maps besides capitals: long s, Kelvin, I with and i without a dot; the dot itself has no counterpart, and goes.
TOKEN, LETTERS = "[a-z0-9_]+", ("ſKİı̇", "skii")
#: Characters of either side of a joint at most, and of a part of a token at least; alternatives of a pattern at most.
GRAM, MOST_KEYS = 3, 16
#: Characters of either side of a short joint, which stands with two spaces: for tokens at an open end that are too short to tell a side of GRAM.
SHORT = 2

#: (whether the key is a whole token, the key)
Key = tuple[bool, str]


def fold(text: str) -> str:
    low, ascii_ = LETTERS
    mapped = text.translate(str.maketrans(low[: len(ascii_)], ascii_, low[len(ascii_) :]))
    return "".join(c.lower() if c.isascii() else c for c in mapped)


def folded(text: Column) -> Column:
    """The text as tokens are found in it; a null text is empty."""
    return F.lower(F.translate(F.coalesce(text, F.lit("")), *LETTERS))


def words_of(text: Column) -> Column:
    """The tokens of a text, as they follow each other."""
    return F.regexp_extract_all(folded(text), F.lit(TOKEN), F.lit(0))


def tokens(text: Column) -> Column:
    """The distinct tokens of a text, sorted."""
    return F.array_sort(F.array_distinct(words_of(text)))


def joints_of(words: Column, side: int = GRAM) -> Column:
    """The joints, or with SHORT the short ones, of each two of the tokens that follow each other."""
    n, between = F.lit(side), F.lit(" " if side == GRAM else "  ")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(F.right(a, n), between, F.left(b, n)))
    # the last token has none
    return F.array_compact(pairs)


def joints(text: Column) -> Column:
    """The distinct joints of each two tokens that follow each other, whatever stands between them."""
    return F.array_distinct(joints_of(words_of(text)))


def _joints_of_run(run: str, open_left: bool, open_right: bool) -> list[Key]:
    """The joints of a literal run; a token at an open end may go on, and tells its side only if that is full. Where one is not, but would be in a short joint, that is taken."""
    run = fold(run)
    each = list(re.finditer(TOKEN, run))
    found = []
    for a, b in zip(each, each[1:]):
        # how much of either side is known, whatever goes on beyond the run
        least = min([len(m[0]) for m, is_open in ((a, open_left and a.start() == 0), (b, open_right and b.end() == len(run))) if is_open], default=GRAM)
        if least >= GRAM:
            found.append((True, f"{a[0][-GRAM:]} {b[0][:GRAM]}"))
        elif least >= SHORT:
            found.append((True, f"{a[0][-SHORT:]}  {b[0][:SHORT]}"))
    return found


def _of_run(run: str, open_left: bool, open_right: bool) -> list[Key]:
    """The keys of a literal run: tokens within it are whole, those at an open end may go on."""
    run = fold(run)
    found = []
    for m in re.finditer(TOKEN, run):
        whole = (m.start() > 0 or not open_left) and (m.end() < len(run) or not open_right)
        if whole or len(m[0]) >= GRAM:
            found.append((whole, m[0]))
    return found


def _best(keys: list[Key]) -> list[Key] | None:
    """The key that fewest texts are likely to hold: a long one, and rather a whole token than a part."""
    return [max(keys, key=lambda k: (len(k[1]) + 2 * k[0], k))] if keys else None


def _better(a: list[Key] | None, b: list[Key] | None) -> list[Key] | None:
    rank = lambda keys: (min(len(k[1]) + 2 * k[0] for k in keys), -len(keys))
    return max((x for x in (a, b) if x), key=rank, default=None)


def _of_tree(tree: P.SubPattern, of_run: Callable[..., list[Key]]) -> list[Key] | None:
    """Keys of which any match of a parsed expression holds one; None where nothing is known. of_run: the keys of a literal."""
    best, run = None, ""

    def close() -> None:
        nonlocal best, run
        best = _better(best, _best(of_run(run, True, True)))
        run = ""

    for op, av in tree:
        if op is C.LITERAL:
            run += chr(av)
            continue
        close()
        if op is C.SUBPATTERN:
            best = _better(best, _of_tree(av[3], of_run))
        elif op is C.BRANCH:
            every = [_of_tree(x, of_run) for x in av[1]]
            if all(every):
                keys = sorted({k for x in every for k in x})
                best = _better(best, keys if len(keys) <= MOST_KEYS else None)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and av[0] > 0:
            best = _better(best, _of_tree(av[2], of_run))
        elif op is C.ATOMIC_GROUP:
            best = _better(best, _of_tree(av, of_run))
    close()
    return best


#: How a pattern is decided: by the text, or the lowered text, holding a literal; by its expression where the lowered text holds it; by its expression alone.
IN_TEXT, IN_LOW, IF_IN_LOW, BY_EXPRESSION = "text", "low", "if low", "expression"
_PLAIN = "[A-Za-z0-9_ /-]+"


def shortcut(pattern: str) -> tuple[str, str]:
    """How a pattern is decided (see above), and its literal. Expressions take many times as long on a text as a search for a literal."""
    kind = pattern_type(pattern)
    if kind == "regex":
        body = pattern[3:]
        return (IN_TEXT, body) if re.fullmatch(_PLAIN, body) else (BY_EXPRESSION, "")
    if kind == "keyword":
        word = literal(pattern)
        return (IF_IN_LOW, word.lower()) if word.isascii() else (BY_EXPRESSION, "")
    inner = re.fullmatch(rf"\*+({_PLAIN})\*+", pattern)
    return (IN_LOW, inner[1].lower()) if inner else (BY_EXPRESSION, "")


def lowered(text: Column) -> Column:
    """A text as it equals ASCII letters where case is ignored: as folded, but nothing goes. A null text is empty."""
    low, ascii_ = LETTERS
    return F.lower(F.translate(F.coalesce(text, F.lit("")), low[: len(ascii_)], ascii_))


def decided(text: Column, low: Column, p: Column) -> Column:
    """Whether a text, with its lowered form, matches a pattern as a struct: e (its expression), how and lit (its shortcut)."""
    how, held = p["how"], low.contains(p["lit"])
    full = F.coalesce(text, F.lit(""))
    runs = F.regexp_like(full, p["e"])
    return F.when(how == IN_TEXT, full.contains(p["lit"])).when(how == IN_LOW, held).when(how == IF_IN_LOW, F.when(held, runs).otherwise(False)).otherwise(runs)


def index_keys(pattern: str) -> list[Key]:
    """Keys of which every text that the pattern matches holds one: joints, or else tokens; none where nothing is known."""
    return required(pattern, _joints_of_run) or required(pattern)


def required(pattern: str, of_run: Callable[..., list[Key]] = _of_run) -> list[Key]:
    """Keys of one sort of which every text that the pattern matches holds one; none where nothing is known."""
    kind = pattern_type(pattern)
    if kind == "regex":
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", FutureWarning)
            return _of_tree(P.parse(pattern[3:]), of_run) or []
    if kind == "keyword":
        word = literal(pattern)
        bounded = is_word(word)
        return _best(of_run(word, not bounded, not bounded)) or []
    # the runs between a glob's wildcards and classes; only at the ends of the text is a run closed
    low, runs, at = pattern.lower(), [], 0
    for m in re.finditer(r"\[!?\]?[^\]]*\]|[*?\[]", low):
        runs.append((low[at : m.start()], at > 0, True))
        at = m.end()
    runs.append((low[at:], at > 0, False))
    best = None
    for run, left, right in runs:
        best = _better(best, _best(of_run(run, left, right)))
    return best or []
