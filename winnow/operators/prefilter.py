"""The pre-filter: what is dropped before scoring, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.patterns import all_files_match, any_file_match, any_match, prepare, with_lowered
from winnow.operators.evidence import file_flags, list_key
from winnow.sources.catalog import KINDS, Catalog
from winnow.sources.stages import cut

#: Lists of files with flags, at 18 bytes each, up to which they are sent to the records.
FEW_LISTS = 1_000_000
TEXTS = ("subject", "body")
LOWS = tuple(f"_low_{t}" for t in TEXTS)
#: Reasons that stand whatever is known of the product.
SETTLED = ("commit_whitelist", "commit_blacklist", "filter_disabled", "path_blacklist_all", "path_whitelist")


def _says(action: str, reason: str) -> Column:
    return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))


def decision(lists: dict[str, list[str]], enabled: bool = True, lows: Sequence[Column] = ()) -> Column:
    """struct(action, reason): the first rule that holds, in this order, for a record by itself; see in_product.

    lists: patterns by kind, over all profiles. Texts are subject and body as one. lows: the lowered() subject and body; see any_match.
    """
    text = F.concat(F.coalesce("subject", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")))
    of = lambda kind: lists.get(kind, [])
    chain = F.when(any_match(of("commit_whitelist"), F.col("record_id")), _says("keep", "commit_whitelist"))
    chain = chain.when(any_match(of("commit_blacklist"), F.col("record_id")), _says("drop", "commit_blacklist"))
    if not enabled:
        return chain.otherwise(_says("keep", "filter_disabled"))
    chain = chain.when(all_files_match(of("path_blacklist"), F.col("files")), _says("drop", "path_blacklist_all"))
    chain = chain.when(any_file_match(of("path_whitelist"), F.col("files")), _says("keep", "path_whitelist"))
    chain = chain.when(any_match(of("keywords_whitelist"), text, lows), _says("keep", "keywords_whitelist"))
    chain = chain.when(any_match(of("keywords_blacklist"), text, lows), _says("drop", "keywords_blacklist"))
    return chain.otherwise(_says("keep", "default"))


def in_product(own: Column, has_artifact: Column, covered: Column, required: bool) -> Column:
    """A decision() with what is known of the record's files: an artifact keeps what is not settled, and where coverage is required uncovered records without a wanted word are dropped."""
    chain = F.when(own["reason"].isin(*SETTLED), own).when(has_artifact, _says("keep", "build_artifact"))
    if required:
        chain = chain.when(~covered & (own["reason"] != "keywords_whitelist"), _says("drop", "no_kconfig_coverage"))
    return chain.otherwise(own)


def decide(records: DataFrame, catalog: Catalog, sets: DataFrame | None = None, enabled: bool = True, require_coverage: bool | None = None) -> DataFrame:
    """The records with action and reason. sets: what is built; see compiled_sets. Every row is decided by itself, whether its record_id is null or repeated.

    Coverage is required as told, or else where a product map is available; without one nothing is required. A record without files is not covered.
    Records keep their place: what is known of their files comes in a narrow table by a digest of the list of files, which
    is written, counted, and sent to them up to FEW_LISTS rows. Beyond that they are joined by the digest. Texts and
    files are tested before, and so not moved unless the caller asks for them: give records with their scores where these are wanted.
    """
    prepare(p for *_, p in catalog.patterns)
    lists = {k: catalog.overall(k) for k in KINDS}
    if sets is None:
        made = decision(lists, enabled, lows=[F.col(c) for c in LOWS])
        return with_lowered(records, TEXTS).withColumn("d", made).select(*records.columns, "d.action", "d.reason")
    available = not sets.isEmpty()
    # two numbers are sorted by the first of them as it is, a struct only by comparing rows
    flags = cut(file_flags(records, sets).select(F.col("key.a").alias("_a"), F.col("key.b").alias("_b"), "has_artifact", "covered"), "flags")
    few = flags.count() <= FEW_LISTS
    no = F.lit(False)
    key = list_key(F.col("files"))
    own = records.withColumns({"_own": decision(lists, enabled), "_a": key["a"], "_b": key["b"]})
    flagged = own.join(F.broadcast(flags) if few else flags, ["_a", "_b"], "left")
    made = in_product(F.col("_own"), F.coalesce("has_artifact", no), F.coalesce("covered", no), available and require_coverage is not False)
    return flagged.withColumn("d", made).select(*records.columns, "d.action", "d.reason")


def kept(decided: DataFrame) -> DataFrame:
    return decided.where("action = 'keep'").drop("action", "reason")


def dropped(decided: DataFrame) -> DataFrame:
    return decided.where("action = 'drop'").withColumnRenamed("reason", "filter_reason").drop("action")


def reason_counts(rows: DataFrame, column: str = "filter_reason") -> DataFrame:
    """filter_reason, n."""
    return rows.groupBy(F.col(column).alias("filter_reason")).agg(F.count("*").alias("n"))


def dropped_counts(judged: DataFrame) -> DataFrame:
    """filter_reason, n of all records that triage.judged has seen, without those that nothing drops.

    A condition on the reason itself would be put before the count and below the scores, and every record be decided and scored once for it and once more for its reason.
    """
    some = judged.groupBy("filter_reason").agg(F.count_if(F.col("filter_reason").isNotNull()).alias("n"))
    return some.where("n > 0")


def by_reason_class(rows: DataFrame, which: str = "all") -> DataFrame:
    """Dropped rows of a class: all, prefilter or low-score."""
    low = F.col("filter_reason").startswith("score_below_threshold")
    return rows if which == "all" else rows.where(low if which == "low-score" else ~low)


def inspect(rows: DataFrame, which: str = "all", n: int = 50) -> tuple[DataFrame, DataFrame]:
    """Reasons of a class by count, descending, and a sample of its rows, in log order."""
    some = by_reason_class(rows, which)
    return reason_counts(some).orderBy(F.desc("n"), "filter_reason"), some.orderBy("seq").limit(n)
