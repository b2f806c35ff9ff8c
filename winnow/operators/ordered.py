"""Joins by the order of strings: what starts with what, without a nested loop.

All strings with one start stand together in sorted order, from the start itself on. So a start is looked up by the first string that does
not stand before it. Strings and starts are sorted into ranges together, each range is merged by itself, and what a range
has no answer to is the first string of a later one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.sources.stages import cut


def prefixes(text: Column) -> Column:
    """All starts of a text, the text itself included, without the empty one."""
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda n: F.left(text, n))).otherwise(F.array().cast("array<string>"))


def suffixes(text: Column) -> Column:
    """All ends of a text, the text itself included, without the empty one."""
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda n: F.substring(text, n, F.length(text)))).otherwise(F.array().cast("array<string>"))


def at_or_after(points: DataFrame, strings: DataFrame) -> DataFrame:
    """point, string: for each of points (distinct values of one column) the first of strings, in order of their bytes, that does not stand before it.

    Points after all strings are left out, and so are nulls.
    """
    spark = points.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = F.col("s")
    both = points.toDF("s").select("s", F.lit(True).alias("asked")).union(strings.toDF("s").select("s", F.lit(False).alias("asked"))).where(s.isNotNull())
    ranged = cut(both.repartitionByRange(n, "s").withColumn("range", F.spark_partition_id()), "ranges")
    string = F.when(~F.col("asked"), s)
    # of equal ones the string comes first, as it answers
    later = F.last(string, ignorenulls=True).over(Window.partitionBy("range").orderBy(F.desc("s"), "asked").rowsBetween(Window.unboundedPreceding, 0))
    merged = ranged.withColumn("string", later).where("asked").select("s", "range", "string")
    # as many rows as there are ranges
    firsts = ranged.groupBy("range").agg(F.min(string).alias("first"))
    onward = firsts.select("range", F.min("first").over(Window.orderBy("range").rowsBetween(1, Window.unboundedFollowing)).alias("onward"))
    found = merged.join(F.broadcast(onward), "range").select(s.alias("point"), F.coalesce("string", "onward").alias("string"))
    return found.where("string is not null")
