"""Checks of records and results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fields that every record needs, and those of a scored one.
REQUIRED = ("record_id", "subject", "author_name", "author_time")
SCORED_TYPES = {"matched_profiles": "array<string>", "product_evidence": "array<string>", "score": "int"}


def missing_fields(records: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """record_id, field: every required field that is null or not there."""
    null = F.lit(None).cast("string")
    tests = [F.when((F.col(c) if c in records.columns else null).isNull(), F.lit(c)) for c in required]
    return records.select("record_id", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())).alias("field"))


def scored_problems(scored: DataFrame) -> list[str]:
    """What the schema of scored records lacks."""
    have = dict(scored.dtypes)
    return [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in SCORED_TYPES.items() if have.get(c) != t]


def incomplete_scores(scored: DataFrame) -> DataFrame:
    """record_id, field: every field of a scored record that is null or not there."""
    return missing_fields(scored, tuple(SCORED_TYPES))


def without_reason(dropped: DataFrame) -> DataFrame:
    """Dropped rows that do not say why."""
    return dropped.where(F.coalesce("filter_reason", F.lit("")) == "")


def profile_problems(profiles: DataFrame, profile_rules: DataFrame, patterns: DataFrame) -> DataFrame:
    """problem, name: weights out of 0-100, profiles without rules, rules without patterns."""
    weights = profiles.where(~F.col("weight").between(0, 100)).select(F.lit("weight_range").alias("problem"), F.col("profile").alias("name"))
    empty = profiles.join(profile_rules, "profile", "left_anti").select(F.lit("no_rules").alias("problem"), F.col("profile").alias("name"))
    bare = profile_rules.select("rule").distinct().join(patterns.select("rule").distinct(), "rule", "left_anti").select(F.lit("empty_rule").alias("problem"), F.col("rule").alias("name"))
    return weights.union(empty).union(bare)
