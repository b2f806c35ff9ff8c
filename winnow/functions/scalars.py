"""Scalar helpers as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags of a text and the expressions that set them.
FLAGS = {
    "is_fix": r"(?im)^fixes\s*:\s+[0-9a-f]{6,}",
    "has_cve": r"(?i)CVE-\d{4}-\d{4,}",
    "has_syzbot": r"(?i)syzbot",
    "has_stable_cc": r"(?i)cc\s*:.*stable",
}


def short_id(record_id: Column) -> Column:
    return F.substring(record_id, 1, 12)


def minute_text(value: Column) -> Column:
    """Epoch seconds, as a number or its text, as UTC minutes; 0, empty or null: empty; other text: its first 16 characters."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    seconds = text.try_cast("bigint")
    shown = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm")
    return F.when((text == "") | (seconds == 0), "").otherwise(F.coalesce(shown, F.substring(text, 1, 16)))


def joined(values: Column) -> Column:
    return F.array_join(values, "; ")


def scores_text(scores: Column) -> Column:
    """A map of scores as `name:score` parts, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(scores)), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), "; ")


def flags(text: Column, expressions: dict[str, str] = FLAGS) -> dict[str, Column]:
    """Flag columns of a text by name."""
    filled = F.coalesce(text, F.lit(""))
    return {name: filled.rlike(e) for name, e in expressions.items()}


def true_flags(columns: dict[str, Column]) -> Column:
    """The names of the flags that are set."""
    return F.filter(F.array(*[F.when(c, name) for name, c in columns.items()]), lambda x: x.isNotNull())


def dirname(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)\A(.*)/[^/]*\z", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The path without its extension; leading dots belong to the name."""
    return F.regexp_replace(path, r"(?s)\A((?:.*/)?\.*[^/.][^/]*)\.[^./]*\z", "$1")


def ancestors(path: Column) -> Column:
    """All proper ancestor directories of a path."""
    parts = F.split(path, "/")
    return F.when(
        F.size(parts) > 1,
        F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/")),
    ).otherwise(F.array().cast("array<string>"))


def is_build_file(path: Column) -> Column:
    """Files that steer a build."""
    base = basename(path)
    return base.isin("Makefile", "Kbuild", "Kconfig") | base.startswith("Makefile.") | base.startswith("Kconfig.") | (base.endswith(".mk") & (F.length(base) > 3) & ~base.rlike(r"\A\.+mk\z"))


def tier(score: Column) -> Column:
    return F.when(score >= 70, "hi").when(score >= 30, "mid").otherwise("low")
