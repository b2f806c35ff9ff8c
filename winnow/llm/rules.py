"""Quality rules: a table of thresholds, compiled into one projection.

A text is measured once: lengths, symbols, stop words, lines, repeated words. A rule of the table holds two measures against
each other, as thousandths in whole numbers, and names what a text fails. Measures and rules are one Column of built-in
functions: no user function, no shuffle, one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What parts words, as an expression and as characters, and the symbols that count.
SPACE, SPACES, SYMBOLS = r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 5
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "for", "with", "it", "as", "was", "on", "be", "at", "by", "this", "are", "or", "an", "not", "from",
    "der", "die", "und", "das", "ist", "nicht", "den", "von", "mit", "ein", "eine", "zu", "auf", "sich", "für", "im", "dem", "des", "es",
    "le", "la", "les", "et", "de", "que", "en", "un", "une", "du", "dans", "pas", "est", "qui", "pour", "sur", "au", "il", "elle", "ne",
    "el", "los", "las", "y", "no", "se", "por", "con", "para", "una", "del", "al", "lo", "su",
)


@dataclass(frozen=True)
class Rule:
    """part, in thousandths of whole (a measure, or 1), is to be within least and most; asked of texts with from_words words at least."""

    name: str
    part: str
    whole: str | None = None
    least: int | None = None
    most: int | None = None
    from_words: int = 0


RULES = (
    Rule("short words", "word_chars", "n_words", least=2_000),
    Rule("long words", "word_chars", "n_words", most=12_000),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("exclamations", "n_exclaims", "n_words", most=200),
    Rule("stop words", "n_stop_words", "n_words", least=20, from_words=50),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=400),
    Rule("listed lines", "n_list_lines", "n_lines", most=900),
    Rule("broken lines", "n_open_lines", "n_lines", most=300),
)
#: Words of a text at least, and repeated words in hundredths of all at most, of what passes at all.
LEAST_WORDS, MOST_REPEATED = 10, 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _removed(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count(text: Column, characters: str) -> Column:
    """How many of some ASCII characters a text has."""
    return F.octet_length(text) - F.octet_length(_removed(text, characters))


def repeated_words(words: Column) -> Column:
    """Words that are in a window of WINDOW words that occurs more than once, its first occurrence included.

    Texts in which no two windows have one hash, almost all, have none. In others the windows are sorted, and those that equal a neighbour
    are laid over the text in order.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(WINDOW))))

    def covered(windows: Column) -> Column:
        both = F.zip_with(windows, F.slice(windows, F.lit(2), F.size(windows)), lambda x, y: F.when(x["w"] == y["w"], F.array(x["p"], y["p"])).otherwise(F.array().cast("array<int>")))
        at = F.array_sort(F.array_distinct(F.flatten(both)))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(at, start, lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p + WINDOW - s["end"])).alias("n"), (p + WINDOW).alias("end")), lambda s: s["n"])

    windows = F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("p"))))
    none = F.lit(0).cast("bigint")
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(windows, covered)))
    return F.when(F.size(words) < WINDOW, none).otherwise(some)


def measures(text: Column) -> Column:
    """A struct of whole numbers: what rules may ask of a text. A null text is an empty one."""
    filled = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> dict[str, Column]:
        return {"n_words": F.size(words), "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))), "n_repeat_words": repeated_words(words)}

    def of_lines(lines: Column) -> dict[str, Column]:
        return {
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_list_lines": F.size(F.filter(lines, lambda x: F.ltrim(x).rlike(r"\A[-*\x{2022}]"))),
            "n_open_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
        }

    def packed(columns: dict[str, Column]) -> Column:
        return F.struct(*(c.cast("bigint").alias(k) for k, c in columns.items()))

    words = let(F.array_remove(F.split(filled, SPACE), ""), lambda w: packed(of_words(w)))
    lines = let(F.filter(F.split(filled, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: packed(of_lines(x)))
    counts = {"word_chars": F.length(_removed(filled, SPACES)), "n_symbols": _count(filled, SYMBOLS), "n_exclaims": _count(filled, "!")}
    fields = {"w": ("n_words", "n_stop_words", "n_repeat_words"), "l": ("n_lines", "n_dup_lines", "n_list_lines", "n_open_lines"), "c": tuple(counts)}
    return let(F.struct(words.alias("w"), lines.alias("l"), packed(counts).alias("c")), lambda m: F.struct(*(m[k][f].alias(f) for k, names in fields.items() for f in names)))


def failed(m: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The names of the rules that measures do not keep, in the table's order."""

    def broken(r: Rule) -> Column:
        part, whole = m[r.part] * 1000, m[r.whole] if r.whole else F.lit(1)
        out = F.lit(False)
        if r.least is not None:
            out = out | (part < r.least * whole)
        if r.most is not None:
            out = out | (part > r.most * whole)
        return out & (m["n_words"] >= r.from_words)

    return F.array_compact(F.array(*(F.when(broken(r), r.name) for r in rules)).cast("array<string>"))


def base_failed(m: Column) -> Column:
    """Whether a text is too short, or repeats itself too much, for any table."""
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """A table of thresholds, a list that people write, from CSV files with a header: name, part, whole, least, most, from_words."""
    rows = spark.read.schema("name string, part string, whole string, least int, most int, from_words int").csv(path, header=True)
    return [Rule(r["name"], r["part"], r["whole"] or None, r["least"], r["most"], r["from_words"] or 0) for r in rows.orderBy("name").collect()]


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measures of the text, base_failed, kept, failed (names of the rules that are broken, joined with `; `).

    A null text is an empty one, and fails. A row is judged by its text alone: rows that repeat or lack a doc_id like all others. Extra
    columns are ignored; an empty table gives no rows.
    """
    m = F.col("m")
    measured = docs.select("doc_id", measures(F.col("text")).alias("m")).select("doc_id", "m", failed(m, rules).alias("f"))
    return measured.select("doc_id", "m.*", base_failed(m).alias("base_failed"), (~base_failed(m) & (F.size("f") == 0)).alias("kept"), F.array_join("f", "; ").alias("failed"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows whose text passes, with the columns they have."""
    good = let(measures(F.col("text")), lambda m: ~base_failed(m) & (F.size(failed(m, rules)) == 0))
    return docs.where(good)
