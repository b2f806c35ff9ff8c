"""The whole triage of records as one plan: pre-filter, score, threshold, rank, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators import prefilter, rank, report, score
from winnow.sources.catalog import Catalog


@dataclass
class Triage:
    decided: DataFrame
    scored: DataFrame
    ranked: DataFrame
    dropped: DataFrame


def judged(decided: DataFrame, catalog: Catalog, threshold: object = 0) -> DataFrame:
    """Decided records with their scores, unless they have them, filter_reason (why either filter drops them, else null) and src (0: the pre-filter drops it, 1: the threshold decides)."""
    early = F.col("action") == "drop"
    late = rank.postfilter(decided if "score" in decided.columns else score.scored(decided, catalog), threshold)
    return late.withColumns({"filter_reason": F.when(early, F.col("reason")).otherwise(F.col("filter_reason")), "src": F.when(early, 0).otherwise(1)})


def triage(records: DataFrame, catalog: Catalog, sets: DataFrame | None = None, threshold: float = 0, require_coverage: bool | None = None) -> Triage:
    """The tables of each step, of which ranked is written. sets: what is built; see compiled_sets."""
    decided = prefilter.decide(records, catalog, sets, require_coverage=require_coverage)
    every = judged(decided, catalog, threshold)
    scored = every.where("action = 'keep'").drop("action", "reason", "src")
    dropped = every.where("filter_reason is not null").drop("action", "reason", "hits", "blocks")
    return Triage(decided, scored, rank.ranked(scored.where("filter_reason is null")), dropped)


def full_report(t: Triage, catalog: Catalog, n: int = 5000) -> dict[str, DataFrame]:
    ranked = t.ranked if "product_evidence" in t.ranked.columns else t.ranked.withColumn("product_evidence", F.array().cast("array<string>"))
    return report.report(ranked, t.dropped, rank.profile_frame(catalog, ranked), n)
