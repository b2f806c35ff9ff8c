"""Reports: summaries, matrices, statistics, and what is written of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.scalars import joined, minute_text, scores_text, short_id
from winnow.operators.rank import top_n
from winnow.sources.stages import cut

#: The order of fields in a written record.
FIELDS = ("record_id", "subject", "body", "author_name", "author_email", "author_time", "commit_time", "files", "numstat", "score", "matched_profiles", "product_evidence", "filter_reason", "rank")


def tenth(average: Column) -> Column:
    """An average to one decimal, halves to even."""
    return F.coalesce(F.bround(average, 1), F.lit(0.0))


def profile_summary(scored: DataFrame, profiles: DataFrame) -> DataFrame:
    """profile, description, n, total_score, avg_score (one decimal): of the records that match a profile, with their total scores; profiles without any have zeros."""
    # outer: an explode that skips rows without any would compute them twice
    rows = scored.select("score", F.explode_outer("matched_profiles").alias("profile")).where("profile is not null")
    by = rows.groupBy("profile").agg(F.count("*").alias("n"), F.sum("score").alias("total_score"), F.avg("score").alias("avg_score"))
    zero = F.lit(0).cast("long")
    joined = profiles.select("profile", "description").join(by, "profile", "left")
    return joined.select("profile", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("n", zero).alias("n"), F.coalesce("total_score", zero).alias("total_score"), tenth(F.col("avg_score")).alias("avg_score"))


def by_count(summary: DataFrame) -> DataFrame:
    """A summary in the order of a report: most records first, ties by profile."""
    return summary.orderBy(F.desc("n"), "profile")


def coverage_metrics(scored: DataFrame) -> DataFrame:
    """One row: records without a matched profile, records with product evidence."""
    return scored.agg(F.count_if(F.size("matched_profiles") == 0).alias("unmatched"), F.count_if(F.size("product_evidence") > 0).alias("with_evidence"))


def report_stats(judged: DataFrame, threshold: float, n: int) -> DataFrame:
    """One row of counts, of records that triage.judged has seen: collected ones, then those kept, dropped and scored, and the scores and matches of those reported.

    Reported are the first n by rank of those that pass, with n = 0 all. One pass, and one more over a written table
    of scores for the reported ones.
    """
    evidence = F.size("product_evidence") if "product_evidence" in judged.columns else F.lit(0)
    rows = cut(judged.select("seq", "action", "score", "filter_reason", F.size("matched_profiles").alias("n_profiles"), evidence.alias("n_evidence")), "judged")
    keep, passed = F.col("action") == "keep", F.col("filter_reason").isNull()
    counts = rows.agg(
        F.count("*").alias("collected"),
        F.count_if(keep).alias("kept"),
        F.count_if(~keep).alias("dropped"),
        F.count_if(keep).alias("scored"),
        F.count_if(keep & ~passed).alias("post_dropped"),
    )
    some = rows.where(keep & passed)
    of = (some.orderBy(F.desc("score"), "seq").limit(n) if n else some).agg(
        F.count("*").alias("reported"),
        F.coalesce(F.max("score"), F.lit(0)).cast("long").alias("max_score"),
        F.coalesce(F.min("score"), F.lit(0)).cast("long").alias("min_score"),
        tenth(F.avg("score")).alias("avg_score"),
        F.count_if(F.col("n_profiles") == 0).alias("unmatched"),
        F.count_if(F.col("n_evidence") > 0).alias("with_evidence"),
    )
    # two rows in all
    one = counts.crossJoin(of)
    return one.select(
        "collected", "kept", "dropped", "scored", F.lit(float(threshold)).alias("threshold"), "post_dropped", "reported", F.lit(n).cast("long").alias("top_n"), "max_score", "min_score", "avg_score", "unmatched", "with_evidence"
    )


def stats_kv(stats: DataFrame) -> DataFrame:
    """metric, value of a one-row table."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in sorted(stats.columns)])
    return stats.select(F.explode(cells).alias("c")).select("c.metric", "c.value")


def seen_profiles(scored: DataFrame) -> list[str]:
    """The profiles that any record matches, sorted: no more than the catalog has."""
    return sorted(r[0] for r in scored.select(F.explode("matched_profiles")).distinct().collect())


def profile_matrix_wide(ranked: DataFrame, names: list[str]) -> DataFrame:
    """rank, commit (the short id), score, subject and a column per profile of names (see seen_profiles): its score, else 0."""
    of = lambda name: F.coalesce(F.get(F.filter("profile_scores", lambda p: p["profile"] == name), F.lit(0))["final_score"], F.lit(0))
    return ranked.select("rank", short_id(F.col("record_id")).alias("commit"), "score", "subject", *[of(name).alias(name) for name in sorted(names)])


def profile_matrix_long(scored: DataFrame) -> DataFrame:
    """record_id, profile, score: a row per matched profile."""
    pairs = F.map_from_arrays(F.transform("profile_scores", lambda p: p["profile"]), F.transform("profile_scores", lambda p: p["final_score"]))
    rows = scored.select("record_id", pairs.alias("m"), F.explode_outer("matched_profiles").alias("profile")).where("profile is not null")
    return rows.select("record_id", "profile", F.col("m")[F.col("profile")].alias("score"))


def all_dropped(prefiltered: DataFrame, postfiltered: DataFrame) -> DataFrame:
    """Dropped records of both filters, with src (0, 1) for the order; columns that one lacks are null."""
    return prefiltered.withColumn("src", F.lit(0)).unionByName(postfiltered.withColumn("src", F.lit(1)), allowMissingColumns=True)


def dedup_first(rows: DataFrame) -> DataFrame:
    """The first row of each record_id by src, seq."""
    first = F.row_number().over(Window.partitionBy("record_id").orderBy("src", "seq"))
    return rows.withColumn("_at", first).where("_at = 1").drop("_at")


def with_shards(rows: DataFrame) -> DataFrame:
    """Rows with s1 and s2, the folders of their detail file."""
    return rows.withColumns({"s1": F.substring("record_id", 1, 2), "s2": F.substring("record_id", 3, 2)})


def details(kept: DataFrame, dropped: DataFrame) -> DataFrame:
    """The detail records of a report: every kept and every dropped record, the first row of each record_id, kept ones first, with s1 and s2. Rows without an id have none."""
    rows = kept.withColumn("src", F.lit(0)).unionByName(dropped.withColumn("src", F.lit(1)), allowMissingColumns=True)
    return with_shards(dedup_first(rows.where(F.coalesce("record_id", F.lit("")) != "")))


def commit_rows(records: DataFrame) -> DataFrame:
    """The nine columns of a report, as text. Expects score, matched_profiles, profile_scores, product_evidence; records without times have an empty date."""
    time = F.col("author_time") if "author_time" in records.columns else F.lit("")
    scores = F.map_from_arrays(F.transform("profile_scores", lambda p: p["profile"]), F.transform("profile_scores", lambda p: p["final_score"]))
    return records.select(
        short_id(F.col("record_id")).alias("commit"),
        "subject",
        F.coalesce("author_name", F.lit("")).alias("author"),
        minute_text(time).alias("date"),
        F.col("score").cast("string").alias("score"),
        joined(F.col("matched_profiles")).alias("profiles"),
        scores_text(scores).alias("profile_scores"),
        joined(F.col("product_evidence")).alias("evidence"),
        F.size("files").cast("string").alias("n_files"),
    )


def table_rows(records: DataFrame) -> DataFrame:
    """The slim projection of a table: a missing reason is left out by the JSON writer, and so are columns that records lack."""
    given = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    return records.select("record_id", "subject", "author_name", given("author_time").alias("author_time"), "score", "matched_profiles", F.nullif(given("filter_reason"), F.lit("")).alias("filter_reason"))


def ordered(records: DataFrame) -> DataFrame:
    """Fixed fields first, then others by name, then those that start with an underscore."""
    rest = sorted(c for c in records.columns if c not in FIELDS)
    return records.select([c for c in FIELDS if c in records.columns] + [c for c in rest if c[0] != "_"] + [c for c in rest if c[0] == "_"])


def write_json(records: DataFrame, path: str) -> None:
    """A JSON row per record, with its fields in the fixed order."""
    ordered(records).write.mode("overwrite").json(path)


def write_lines(records: DataFrame, path: str, **options: object) -> None:
    """Collected records as they are, a JSON row each. options: those of Spark's writer of JSON (compression, maxRecordsPerFile)."""
    records.write.mode("overwrite").options(**options).json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_details(rows: DataFrame, path: str) -> None:
    """A JSON row per record, first occurrence, in folders by the start of its id."""
    sharded = with_shards(dedup_first(rows.where(F.coalesce("record_id", F.lit("")) != "")))
    sharded.repartition("s1").write.mode("overwrite").partitionBy("s1", "s2").json(path)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def report(ranked: DataFrame, dropped: DataFrame, profiles: DataFrame, n: int = 5000) -> dict[str, DataFrame]:
    """What a report holds, as tables. ranked: records that passed."""
    top = top_n(ranked, n)
    return {
        "relevant": commit_rows(top),
        "table": table_rows(top),
        "filtered": dropped,
        "summary": by_count(profile_summary(top, profiles)),
        "matrix": profile_matrix_wide(top, seen_profiles(top)),
        "matrix_long": profile_matrix_long(top),
        "details": details(top, dropped),
    }
