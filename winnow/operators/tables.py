"""Interactive tables: filters as people type them, facets, counts, exports."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators.report import write_csv
from winnow.functions.patterns import quoted

#: Facets are offered for columns of so many values at most.
FACET_VALUES = 20


def number(text: Column) -> Column:
    """The number that a text starts with, or null."""
    return F.regexp_extract(text, r"^\s*([-+]?(?:\d+(?:\.\d*)?|\.\d+))", 1).try_cast("double")


def token_filter(column: Column, tokens: str) -> Column:
    """All tokens hold: >N, <N, =text (exact), a*b (anywhere), or a part of the text; letters' case aside."""
    text = F.lower(F.coalesce(column.cast("string"), F.lit("")))
    tests = []
    for t in tokens.lower().split():
        if t[0] in "<>" and len(t) > 1:
            bound = F.lit(t[1:])
            tests.append(F.coalesce(number(text) > number(bound) if t[0] == ">" else number(text) < number(bound), F.lit(False)))
        elif t[0] == "=" and len(t) > 1:
            tests.append(text == t[1:])
        elif "*" in t:
            tests.append(text.rlike("(?s)" + ".*".join(quoted(x) for x in t.split("*"))))
        else:
            tests.append(text.contains(t))
    return reduce(and_, tests, F.lit(True))


def any_of(column: Column, values: list[str]) -> Column:
    """Any chosen value is a part of the text; none chosen: all."""
    text = F.lower(F.coalesce(column.cast("string"), F.lit("")))
    return reduce(or_, [text.contains(v.lower()) for v in values]) if values else F.lit(True)


def search(df: DataFrame, needles: str) -> Column:
    """Every needle is a part of the row's cells, joined by spaces."""
    row = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]))
    return reduce(and_, [row.contains(n) for n in needles.lower().split()], F.lit(True))


def filter_table(df: DataFrame, tokens: dict[str, str] | None = None, chosen: dict[str, list[str]] | None = None, needles: str = "") -> DataFrame:
    """Rows that pass all filters."""
    tests = [token_filter(F.col(c), t) for c, t in (tokens or {}).items()]
    tests += [any_of(F.col(c), v) for c, v in (chosen or {}).items()]
    return df.where(reduce(and_, [*tests, search(df, needles)], F.lit(True)))


def live_count(df: DataFrame, shown: Column) -> DataFrame:
    """One row: visible, total."""
    return df.agg(F.count_if(shown).alias("visible"), F.count("*").alias("total"))


def export(df: DataFrame, path: str, **filters) -> None:
    write_csv(filter_table(df, **filters), path)


def facets(df: DataFrame, column: str, most: int = FACET_VALUES) -> DataFrame:
    """value: the distinct values of a column, lists split at ; and ,; none if there are more than `most`."""
    parts = df.select(F.explode(F.split(F.coalesce(F.col(column).cast("string"), F.lit("")), r"[;,]\s*")).alias("value")).where("value <> ''")
    # most + 1 rows
    few = parts.distinct().limit(most + 1).withColumn("n", F.count("*").over(Window.partitionBy()))
    return few.where(F.col("n") <= most).select("value")


def sort_table(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Numbers before texts, numbers by value."""
    text = F.col(column).cast("string")
    keys = [text.try_cast("double"), text]
    return df.orderBy(*[k.desc_nulls_last() if descending else k.asc_nulls_last() for k in keys])
