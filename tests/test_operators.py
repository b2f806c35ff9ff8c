"""Filters, scores, ranks, reports and streams on small records."""

import re

import pytest
from pyspark.sql import functions as F

from winnow.functions.patterns import matches
from winnow.operators import evidence, prefilter, rank, report, score, tables
from winnow.plans import bindings as B
from winnow.plans.triage import full_report, triage
from winnow.plans.triage import judged as judged_of
from winnow.queries import _judged as judged_orders
from winnow.sources import product
from winnow.sources.catalog import Catalog
from winnow.streaming import increments
from winnow.streaming import scores as streaming

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return B.documents(spark, SMALL).cache()


def test_invariants(spark, docs):
    t = triage(docs, B.DOC_CATALOG, threshold=20)
    kept, dropped = prefilter.kept(t.decided).count(), prefilter.dropped(t.decided).count()
    assert kept + dropped == docs.count() and dropped
    n = t.ranked.count()
    assert sorted(r["rank"] for r in t.ranked.select("rank").collect()) == list(range(1, n + 1))
    assert all(r.score >= 20 for r in t.ranked.collect())
    assert n + t.dropped.count() == docs.count()
    sums = score.profile_scores(t.scored).groupBy("record_id").agg(F.sum("final_score").alias("s")).join(t.scored, "record_id")
    assert sums.where("s <> score").isEmpty()
    tables_ = full_report(t, B.DOC_CATALOG, 5)
    assert tables_["relevant"].count() == 5 and len(tables_["relevant"].columns) == 9


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_rank_by_ranges_is_the_plain_rank(docs, width):
    from pyspark.sql import Window

    s = score.scored(docs, B.DOC_CATALOG)
    plain = s.withColumn("r", F.row_number().over(Window.orderBy(F.desc("score"), "seq"))).select("record_id", "r")
    assert rank.ranked(s, width).join(plain, "record_id").where("rank <> r").isEmpty()


def test_cap_and_truncation(spark):
    c = Catalog([("p", "", 29.0, 0), ("q", "", None, 1), ("z", "", -5.0, 2)], [("p", "a", 80, 0), ("p", "b", 70, 1), ("q", "a", 80, 0), ("z", "a", 80, 0)], [("a", "keywords_whitelist", 0, "x"), ("b", "keywords_whitelist", 0, "y")])
    r = spark.createDataFrame([("1", 0, "x y", None, None)], "record_id string, seq long, subject string, body string, files array<string>")
    s = score.scored(r, c).first()
    assert [p.final_score for p in s.profile_scores] == [28, 80, 0] and s.score == 108 and s.matched_profiles == ["p", "q", "z"]


def test_blocked_counts_as_matched(spark):
    c = Catalog([("p", "", 100.0, 0)], [("p", "a", 80, 0)], [("a", "keywords_whitelist", 0, "x"), ("a", "path_blacklist", 0, "bad/*")])
    r = spark.createDataFrame([("1", 0, "x", "", ["ok/a", "bad/b"])], "record_id string, seq long, subject string, body string, files array<string>")
    s = score.scored(r, c).first()
    assert s.score == 0 and s.matched_profiles == ["p"]
    assert score.rule_hits(score.scored(r, c), c).first().matched_level == "blocked"


def test_coverage_needs_a_product(spark):
    c = Catalog([("p", "", 100.0, 0)], [("p", "a", 80, 0)], [])
    r = spark.createDataFrame([("1", 0, "s", "", ["drivers/a/x.c"]), ("2", 1, "s", "", []), ("3", 2, "s", "", ["Makefile"])], "record_id string, seq long, subject string, body string, files array<string>")
    paths = spark.createDataFrame([("CONFIG_A", "drivers/a/y.c")], "symbol string, path string")
    none = spark.createDataFrame([], "path string"), spark.createDataFrame([], "name string")
    on = product.compiled_sets(paths, spark.createDataFrame([("CONFIG_A=y",)], "symbol string"), *none)
    off = product.compiled_sets(paths, spark.createDataFrame([("CONFIG_B=y",)], "symbol string"), *none)
    reasons = lambda sets, **k: [x.reason for x in prefilter.decide(r, c, sets, **k).orderBy("seq").collect()]
    assert reasons(on) == ["default", "no_kconfig_coverage", "default"]
    assert reasons(off) == ["default"] * 3 and reasons(None, require_coverage=True) == ["default"] * 3
    assert off.isEmpty()


def test_every_row_is_decided_by_itself(spark):
    c = Catalog([("p", "", 100.0, 0)], [("p", "a", 80, 0)], [("a", "keywords_whitelist", 0, "x")])
    r = spark.createDataFrame([("1", 0, "x", "", ["a/b.c"]), ("1", 1, "y", "", ["z/z.c"]), (None, 2, "y", "", ["a/b.c"]), (None, 3, "y", None, None), ("2", 4, "y", "", [])], "record_id string, seq long, subject string, body string, files array<string>")
    paths = spark.createDataFrame([("CONFIG_A", "a/b.c")], "symbol string, path string")
    sets = product.compiled_sets(paths, spark.createDataFrame([("CONFIG_A=y",)], "symbol string"), spark.createDataFrame([], "path string"), spark.createDataFrame([], "name string"))
    got = [(x.seq, x.reason) for x in prefilter.decide(r, c, sets).orderBy("seq").collect()]
    assert got == [(0, "keywords_whitelist"), (1, "no_kconfig_coverage"), (2, "default"), (3, "no_kconfig_coverage"), (4, "no_kconfig_coverage")]


def scans_and_tests(df, capsys):
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    return plan.count("FileScan parquet"), plan.count("RLIKE")


def test_records_are_scored_once(spark, capsys):
    """However much is asked of a score, texts are read once and each pattern is tested once for a record."""
    from winnow.queries import queries

    d = "/root/testdata/sf0.01"
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    scans, tests = scans_and_tests(queries()["total_scores"](spark, d), capsys)
    assert scans == 1 and tests
    for name, most in (("profile_scores", tests), ("rule_hits", tests), ("top_n", tests), ("profile_summary", tests), ("profile_matrix_long", tests), ("pattern_hits", 2 * tests), ("rule_trace", 3 * tests)):
        n, m = scans_and_tests(queries()[name](spark, d), capsys)
        assert n == 1 and m <= most, name
    assert scans_and_tests(queries()["ranked"](spark, d), capsys)[1] == 0  # scores are written before


def test_steps_are_made_once_for_a_source(spark, monkeypatch, capsys):
    """Each source's scores read the texts once, and what passes reads scores alone; sums and matches of profiles are generated code, not functions that are interpreted for every record."""
    from winnow.queries import queries
    from winnow.streaming import increments

    plans, commit = [], increments.Table.commit

    def told(table, batch, rows, note=""):
        capsys.readouterr()
        rows.explain()
        plans.append((table.path.rsplit("/", 1)[1], note, capsys.readouterr().out))
        commit(table, batch, rows, note)

    monkeypatch.setattr(increments.Table, "commit", told)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    made = queries()["resumed_steps"](spark, "/root/testdata/sf0.001")
    assert [(step, note) for step, note, _ in plans] == [("scores", "some"), ("passed", "some"), ("scores", "all"), ("passed", "all")]
    for step, _, plan in plans:
        assert plan.count("FileScan parquet") == 1 and ("RLIKE" in plan) == (step == "scores")
        assert "aggregate(" not in plan
    s = score.scored(B.documents(spark, "/root/testdata/sf0.001"), B.DOC_CATALOG)
    rows = s.select("record_id", "score", "matched_profiles", "profile_scores").collect()
    for r in rows:
        assert r.score == sum(p.final_score for p in r.profile_scores)
        assert r.matched_profiles == [p.profile for p in r.profile_scores if p.final_score > 0 or p.any_match]
    assert {(r.record_id, r.score) for r in made.collect()} == {(r.record_id, r.score) for r in rows if r.score >= 40}


def test_a_table_of_one_row_group_is_scored_by_all_tasks(spark, tmp_path, monkeypatch):
    """A file is parted by its size: with one row group, one of many tasks reads all rows, and they are dealt again; rows that are even already are not moved."""
    from winnow.queries import queries
    from winnow.sources.stages import spread

    cores, commit, shares = spark.sparkContext.defaultParallelism, increments.Table.commit, []
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs.coalesce(1).write.parquet(str(tmp_path / "one" / "documents.parquet"))
    docs.repartition(4 * cores).write.parquet(str(tmp_path / "many" / "documents.parquet"))

    def by_task(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())

    def told(table, batch, rows, note=""):
        if table.path.endswith("/scores"):
            shares.append(by_task(rows))
        commit(table, batch, rows, note)

    monkeypatch.setattr(increments.Table, "commit", told)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        one, many = (spark.read.parquet(str(tmp_path / d / "documents.parquet")) for d in ("one", "many"))
        assert one.rdd.getNumPartitions() >= cores and len(by_task(one)) == 1
        assert len(by_task(spread(one))) >= cores and spread(one).exceptAll(docs).isEmpty() and docs.exceptAll(spread(one)).isEmpty()
        assert spread(many) is many and spread(one.where("false")).isEmpty()
        made = queries()["resumed_steps"](spark, str(tmp_path / "one"))
        got = {(r.record_id, r.score) for r in made.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(shares) == 2 and all(len(s) >= cores and s[-1] * cores <= 2 * sum(s) for s in shares)
    assert got == {(r.record_id, r.score) for r in score.scored(B.documents(spark, "/root/testdata/sf0.01"), B.DOC_CATALOG).where("score >= 40").select("record_id", "score").collect()} and got


def test_best_is_the_start_of_the_rank(docs):
    s = score.scored(docs, B.DOC_CATALOG)
    want = {(r.record_id, r.rank) for r in rank.top_n(rank.ranked(s), 15).collect()}
    assert {(r.record_id, r.rank) for r in rank.best(s, 15).collect()} == want and len(want) == 15
    assert rank.top_n(rank.ranked(s), 0).count() == s.count()
    with pytest.raises(ValueError, match="top"):
        rank.top_n(s, -1)


def test_report_of_a_worked_example(spark):
    """Averages to one decimal, halves to even; only profiles that are seen have a column; what is reported counts."""
    rows = [("a" * 16, 0, "s0", 80, ["p"]), ("b" * 16, 1, "s1", 15, ["p", "q"]), ("c" * 16, 2, "s2", 14, []), ("d" * 16, 3, "s3", 5, ["p"])]
    df = spark.createDataFrame(rows, "record_id string, seq long, subject string, score int, matched_profiles array<string>")
    df = df.withColumn("profile_scores", F.transform("matched_profiles", lambda p: F.struct(p.alias("profile"), (F.col("score") - 1).alias("final_score"))))
    profiles = spark.createDataFrame([("p", "first"), ("q", None), ("z", "last")], "profile string, description string")
    got = [tuple(r) for r in report.by_count(report.profile_summary(df, profiles)).collect()]
    assert got == [("p", "first", 3, 100, 33.3), ("q", "", 1, 15, 15.0), ("z", "last", 0, 0, 0.0)]
    halves = spark.createDataFrame([(22.25,), (22.75,), (None,)], "x double").select(report.tenth(F.col("x"))).collect()
    assert [r[0] for r in halves] == [22.2, 22.8, 0.0]
    r = rank.ranked(df)
    matrix = report.profile_matrix_wide(r, report.seen_profiles(r))
    assert matrix.columns == ["rank", "commit", "score", "subject", "p", "q"]
    assert [tuple(x) for x in matrix.orderBy("rank").collect()][:2] == [(1, "a" * 12, 80, "s0", 79, 0), (2, "b" * 12, 15, "s1", 14, 14)]
    judged = df.withColumns({"action": F.when(F.col("seq") == 3, "drop").otherwise("keep"), "filter_reason": F.when(F.col("seq") >= 2, "no")})
    s = report.report_stats(judged, 15, 1).first()
    assert (s.collected, s.kept, s.dropped, s.post_dropped, s.reported, s.max_score, s.min_score, s.avg_score, s.unmatched) == (4, 3, 1, 1, 1, 80, 80, 80.0, 0)
    every = report.report_stats(judged, 15, 0).first()
    assert (every.reported, every.min_score, every.avg_score) == (2, 15, 47.5)


def test_patterns_beyond_one_list(spark, docs, monkeypatch):
    patterns = [(r, k, p) for r, k, _, p in B.DOC_CATALOG.patterns]
    whole = {tuple(r) for r in score.pattern_join(docs.select("record_id", "body"), patterns, "body").select("record_id", "rule", "kind", "pattern").collect()}
    monkeypatch.setattr(score, "PATTERNS_TOGETHER", 3)
    assert {tuple(r) for r in score.pattern_join(docs.select("record_id", "body"), patterns, "body").select("record_id", "rule", "kind", "pattern").collect()} == whole and whole


def test_trigram_join_is_the_plain_join(spark, docs, monkeypatch):
    words = spark.createDataFrame([("CONFIG_THE",), ("CONFIG_TION=y",), ("CONFIG_OF",), ("CONFIG_ZZZZ",)], "symbol string")
    plain = {tuple(r) for r in evidence.config_text(docs, words).collect()}
    monkeypatch.setattr(evidence, "FEW_SYMBOLS", 0)
    assert {tuple(r) for r in evidence.config_text(docs, words).collect()} == plain and plain


def test_config_dir_either_way(spark):
    touched = spark.createDataFrame([("1", ["drivers/usb"]), ("2", ["net"])], "record_id string, touched array<string>")
    dirs = spark.createDataFrame([("drivers/usb/host/",), ("drivers/usb/",), ("netx/",)], "dir string")
    assert {tuple(r) for r in evidence.config_dir(touched, dirs).collect()} == {("1", "config_dir:drivers/usb/"), ("2", "config_dir:netx/")}


def test_table_filters(spark):
    df = spark.createDataFrame([("10", "ab"), ("9x", "a-b"), ("x", "B")], "n string, t string")
    pick = lambda **k: sorted(r.n for r in tables.filter_table(df, **k).collect())
    assert pick(tokens={"n": ">9"}) == ["10"] and pick(tokens={"n": "<10"}) == ["9x"]
    assert pick(tokens={"t": "a*b"}) == ["10", "9x"] and pick(tokens={"t": "=b"}) == ["x"]
    assert pick(chosen={"t": ["A"]}) == ["10", "9x"] and pick(needles="X b") == ["9x", "x"]
    assert [r.n for r in tables.sort_table(df, "n").collect()] == ["10", "9x", "x"]
    assert tables.facets(df, "t", most=2).isEmpty()


def test_sinks(spark, docs, tmp_path):
    s = rank.ranked(score.scored(docs, B.DOC_CATALOG)).withColumn("product_evidence", F.array().cast("array<string>"))
    report.write_csv(report.commit_rows(s), str(tmp_path / "csv"))
    assert len(spark.read.option("header", True).csv(str(tmp_path / "csv")).columns) == 9
    report.write_details(s.select("record_id", "seq", "subject", F.lit(0).alias("src")), str(tmp_path / "details"))
    assert spark.read.json(str(tmp_path / "details")).count() == docs.count()
    report.write_json(s.limit(3), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3


def test_stream_is_the_batch(spark, docs, tmp_path):
    docs.write.json(str(tmp_path / "in"))
    q = streaming.write_stream(streaming.score_stream(streaming.read_stream(spark, str(tmp_path / "in")), B.DOC_CATALOG), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination()
    got = {(r.record_id, r.reason, r.score) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(r.record_id, r.reason, r.score) for r in streaming.score_stream(docs, B.DOC_CATALOG).collect()}


def test_inspection_of_dropped(docs):
    t = triage(docs, B.DOC_CATALOG, threshold=20)
    low, early, every = (prefilter.inspect(t.dropped, c, 5) for c in ("low-score", "prefilter", "all"))
    assert [r.filter_reason for r in low[0].collect()] == ["score_below_threshold (20.0)"] and low[1].count() == 5
    counts = [r.n for r in every[0].collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == t.dropped.count() and not early[0].isEmpty()


def test_increment(spark, docs, tmp_path):
    path = str(tmp_path / "scores")
    first = streaming.score_increment(docs.limit(50), path, B.DOC_CATALOG, "f1")
    assert first.count() == 50
    assert streaming.score_increment(docs, path, B.DOC_CATALOG, "f1").count() == docs.count()
    assert streaming.score_increment(docs, path, B.DOC_CATALOG, "f2").count() == 2 * docs.count()


def test_a_trace_tests_single_patterns_where_their_rule_hits(spark, docs, capsys):
    """A rule without a hit in a record has none of its patterns tested there; what is traced is what the patterns match one by one."""
    s = score.scored(docs, B.DOC_CATALOG)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    score.rule_trace(s, B.DOC_CATALOG).explain()
    plan = capsys.readouterr().out
    assert re.search(r"CASE WHEN hits#\d+\[0\] THEN (concat|filter|transform)", plan)
    got = {(r.record_id, r.rule, r.kind, r.pattern, r.value) for r in score.rule_trace(s, B.DOC_CATALOG).where("pattern is not null").collect()}
    want = set()
    for rule, kind, _, p in B.DOC_CATALOG.patterns:
        if kind.endswith("_whitelist"):
            for c in {"keywords": ("subject", "body"), "path": ("files",), "commit": ("record_id",)}[kind.removesuffix("_whitelist")]:
                each = docs.select("record_id", F.explode("files").alias("v")) if c == "files" else docs.select("record_id", F.col(c).alias("v"))
                want |= {(r.record_id, rule, kind, p, r.v) for r in each.where(matches(p, F.col("v"))).collect()}
    assert got == want and got


def test_repeated_records_are_one_without_moving_texts_for_it(spark, docs, tmp_path, capsys, monkeypatch):
    told, commit = [], increments.Table.commit

    def seen(self, batch, rows, note=""):
        capsys.readouterr()
        rows.explain()
        told.append(capsys.readouterr().out)
        commit(self, batch, rows, note)

    monkeypatch.setattr(increments.Table, "commit", seen)
    table = increments.scores_table(spark, str(tmp_path / "scores"))
    increments.score_batch(docs.union(docs.where("seq % 3 = 0")), table, B.DOC_CATALOG, "now", "one")
    want = {(r.record_id, r.score) for r in score.scored(docs, B.DOC_CATALOG).collect()}
    rows = increments.current_scores(table)
    assert rows.count() == table.rows().count() == docs.count() and {(r.record_id, r.score) for r in rows.collect()} == want
    increments.score_batch(docs, table, B.DOC_CATALOG, "now", "two")
    assert table.manifests().where("batch = 'two'").first().n == 0
    # rows are put together by id and content, and hold no text by then
    assert not any("first(body" in plan for plan in told) and len(told) == 2


def test_reasons_are_counted_without_scoring_twice(spark, docs, capsys):
    judged = judged_of(prefilter.decide(docs, B.DOC_CATALOG), B.DOC_CATALOG, 20)
    got = {tuple(r) for r in prefilter.dropped_counts(judged).collect()}
    assert got == {tuple(r) for r in prefilter.reason_counts(judged.where("filter_reason is not null")).collect()} and len(got) > 1
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    from winnow.queries import queries

    d = "/root/testdata/sf0.001"
    tests = scans_and_tests(judged_orders(spark, d).select("filter_reason"), capsys)[1]
    assert 0 < scans_and_tests(queries()["dropped_reasons"](spark, d), capsys)[1] <= tests
