"""Threshold, rank and top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.sources.catalog import Catalog
from winnow.sources.stages import cut

#: Records that are ranked in one window.
WIDTH = 50_000
#: Columns of scored records that no rank or report needs: they would make the table that is ranked as large as the texts.
WIDE = ("body", "hits", "blocks")


def threshold_of(value: object) -> float:
    """A threshold as a number; what is none counts as 0."""
    try:
        return float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return 0.0


def postfilter(scored: DataFrame, least: object) -> DataFrame:
    """The records with filter_reason: null for a score of at least the threshold; 0 or less keeps all."""
    t = threshold_of(least)
    reason = F.when((F.col("score") < t) & F.lit(t > 0), f"score_below_threshold ({t})")
    return scored.withColumn("filter_reason", reason)


def ranked(scored: DataFrame, width: int = WIDTH) -> DataFrame:
    """The records with rank, from 1: by score descending, ties by seq. Their texts (WIDE) stay behind.

    Scores are computed once, into a written table. A window ranks the records of one score and one range of seq.
    What stands before it is a running sum over that score's ranges, and one over the scores: those are few, as
    they are whole numbers up to the sum of the profiles' caps.
    """
    rows = cut(scored.drop(*WIDE), "scores").withColumn("_range", F.floor(F.col("seq") / width))
    counts = rows.groupBy("score", "_range").agg(F.count("*").alias("_n"))
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = counts.select("score", "_range", earlier(Window.partitionBy("score").orderBy("_range")).alias("_within"))
    above = counts.groupBy("score").agg(F.sum("_n").alias("_n")).select("score", earlier(Window.orderBy(F.desc("score"))).alias("_above"))
    at = F.row_number().over(Window.partitionBy("score", "_range").orderBy("seq"))
    out = rows.withColumn("_at", at).join(within, ["score", "_range"]).join(above, "score")
    return out.withColumn("rank", F.col("_above") + F.col("_within") + F.col("_at")).drop("_range", "_at", "_within", "_above")


def top_n(ranked_records: DataFrame, n: int = 5000) -> DataFrame:
    """The first n by rank; 0: no limit."""
    if n < 0:
        raise ValueError("n counts from the top")
    return ranked_records.where(F.col("rank") <= n) if n else ranked_records


def best(scored: DataFrame, n: int) -> DataFrame:
    """The first n records, with rank: every task keeps its own first n, so no other is moved or ranked."""
    first = scored.orderBy(F.desc("score"), "seq").limit(n)
    # n rows
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "seq")).cast("long"))


def profile_frame(catalog: Catalog, like: DataFrame) -> DataFrame:
    """profile, description, ord of a catalog."""
    rows = [(p, d, o) for p, d, _, o in catalog.profiles]
    return like.sparkSession.createDataFrame(rows, "profile string, description string, ord int")
