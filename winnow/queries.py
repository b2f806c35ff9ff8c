"""Registered queries of the library's own operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow import oracle as O
from winnow.functions import patterns as P
from winnow.functions import scalars as S
from winnow.operators import evidence, literal_index, prefilter, quality, rank, report, score, tables, tokens
from winnow.plans import bindings as B
from winnow.plans import triage
from winnow.sources import catalog as C
from winnow.sources import product, records
from winnow.sources.stages import cut, dropping_shuffles, new_path, remove, spread
from winnow.streaming import increments
from winnow.streaming import scores as streaming

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL on top of common table expressions."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def text_of(column: str, name: str | None = None):
    return F.array_join(F.col(column), "; ").alias(name or column)


def _scored(s: SparkSession, d: str) -> DataFrame:
    return score.scored(B.documents(s, d), B.DOC_CATALOG)


def _sets(s: SparkSession, d: str) -> DataFrame:
    return product.compiled_sets(B.config_paths(s, d), B.enabled(s, d), B.artifacts(s, d), product.log_objects(B.log_lines(s, d)))


def _decided(s: SparkSession, d: str) -> DataFrame:
    # several joins read both: written once
    return prefilter.decide(cut(B.orders(s, d), "orders"), B.ORDER_CATALOG, cut(_sets(s, d), "sets"))


def _judged(s: SparkSession, d: str, *more: Column) -> DataFrame:
    """Orders, with more columns of them, scored before what is known of their files is joined: rows are narrow there."""
    o = score.scored(cut(B.orders(s, d).drop("author_name", "author_time"), "orders"), B.ORDER_CATALOG).select("*", *more)
    return triage.judged(prefilter.decide(o, B.ORDER_CATALOG, cut(_sets(s, d), "sets")), B.ORDER_CATALOG, 50)


def _order_scores(s: SparkSession, d: str) -> DataFrame:
    return _judged(s, d).where("action = 'keep'")


def _all_dropped(s: SparkSession, d: str) -> DataFrame:
    return _judged(s, d).where("filter_reason is not null")


def _guesses(s: SparkSession, d: str) -> DataFrame:
    """Guessed paths need no files: they are read from the orders alone."""
    r = B.table(s, d, "orders").select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("record_id"), F.col("o_orderpriority").alias("subject"))
    return evidence.infer_paths(r, B.hints(s))


# sources


@query(
    """SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id, o_orderpriority AS subject, 'status ' || o_orderstatus || '  subject=not this' AS body,
    'customer ' || o_custkey AS author_name, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS author_time, CAST(7 AS BIGINT) AS commit_time,
    CASE WHEN o_orderkey % 4 = 0 THEN 'a; b' ELSE 'a' END AS parents, (SELECT string_agg(f, '; ' ORDER BY f) FROM (SELECT DISTINCT 'p/' || l_partkey AS f FROM lineitem WHERE l_orderkey = o_orderkey UNION SELECT 'alone.txt')) AS files
    FROM orders"""
)
def ingest_log(s, d):
    r = records.parse_log(B.raw_log(s, d))
    return r.select("record_id", "subject", "body", "author_name", "author_time", "commit_time", text_of("parents"), text_of("files"))


@query(
    """SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id, count(DISTINCT l_partkey) + 1 AS n_files,
    CAST(coalesce(sum(CASE WHEN l_quantity > 40 THEN 0 ELSE trunc(l_quantity) END), 0) AS BIGINT) AS added, CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS deleted, count(*) FILTER (l_quantity > 40) AS "binary"
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey"""
)
def numstat_rollup(s, d):
    return records.numstat_rollup(records.parse_log(B.raw_log(s, d)))


@query("SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id FROM orders WHERE o_orderkey % 4 <> 0")
def without_merges(s, d):
    return records.without_merges(records.parse_log(B.raw_log(s, d))).select("record_id")


@query(
    """WITH RECURSIVE c AS (SELECT max(event_id) AS e FROM events UNION ALL SELECT e - 1 - e % 97 FROM c WHERE e - 1 - e % 97 IN (SELECT event_id FROM events))
    SELECT CAST(e AS VARCHAR) AS record_id FROM c"""
)
def first_parents(s, d):
    return records.first_parents(B.event_history(s, d)).select("record_id")


@query("SELECT DISTINCT 'CONFIG_BRAND_' || b || '=y' AS symbol FROM pp WHERE p_size % 2 = 0", O.PARTS)
def kconfig_enabled(s, d):
    p = B.table(s, d, "part").withColumn("name", F.concat(F.lit("CONFIG_BRAND_"), F.regexp_extract("p_brand", r"(\d+)$", 1)))
    line = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("  "), "name", F.lit("=y "))).otherwise(F.concat(F.lit("# "), "name", F.lit(" is not set")))
    return product.enabled_symbols(p.select(line.alias("value"))).distinct()


@query(
    """SELECT 'CONFIG_BRAND_' || b AS symbol, arg_max(CASE WHEN p_size % 2 = 0 THEN 'y' ELSE 'm' END, p_partkey) FILTER (p_size % 5 > 0) AS "value", true AS enabled FROM pp GROUP BY b HAVING count(*) FILTER (p_size % 5 > 0) > 0
    UNION ALL SELECT DISTINCT 'CONFIG_BRAND_' || b, CAST(NULL AS VARCHAR), false FROM pp WHERE p_size % 5 = 0""",
    O.PARTS,
)
def config_values(s, d):
    p = B.table(s, d, "part").withColumn("name", F.concat(F.lit("CONFIG_BRAND_"), F.regexp_extract("p_brand", r"(\d+)$", 1)))
    line = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("# "), "name", F.lit(" is not set"))).otherwise(F.concat("name", F.when(F.col("p_size") % 2 == 0, "=y").otherwise("=m")))
    return product.parse_config(p.select(F.col("p_partkey").alias("line_no"), line.alias("line")))


@query("SELECT symbol, path FROM mk", O.PARTS, O.MAKEFILES)
def makefile_map(s, d):
    lines = B.makefile_blobs(s, d).select(S.dirname(F.col("path")).alias("dir"), F.explode(F.split("text", "\n")).alias("line"))
    return product.makefile_map(lines, F.col("dir"))


@query(
    r"""SELECT DISTINCT regexp_extract(t, '([^/]*)$', 1) AS name FROM (SELECT unnest(string_split_regex(coalesce(text, ''), '\s+')) AS t FROM documents
    UNION ALL SELECT 'drivers/' || replace(path, '.c', '.o') FROM pp WHERE p_partkey % 37 = 0) WHERE regexp_matches(t, '\.k?o$')""",
    O.ORDERS,
)
def log_objects(s, d):
    return product.log_objects(spread(B.table(s, d, "documents")).select(F.col("text").alias("value")).union(B.log_lines(s, d)))


@query("SELECT sha256(CAST(doc_id AS VARCHAR)) AS record_id, doc_id AS seq FROM documents ORDER BY doc_id LIMIT 100")
def first_n(s, d):
    return records.first_n(B.documents(s, d), 100).select("record_id", "seq")


# scalar functions


@query(
    """SELECT page_id, CASE WHEN contains(p, '/') THEN regexp_extract(p, '^(.*)/[^/]*$', 1) ELSE '' END AS "dir", regexp_extract(p, '([^/]*)$', 1) AS base,
    CASE WHEN regexp_matches(p, '^((?:.*/)?\\.*[^/.][^/]*)\\.[^./]*$') THEN regexp_extract(p, '^((?:.*/)?\\.*[^/.][^/]*)\\.[^./]*$', 1) ELSE p END AS stem
    FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*/?([^?#]*)', 1) AS p FROM pages)""".replace("\\\\", "\\")
)
def path_parts(s, d):
    p = F.col("files")[0]
    return records.from_pages(B.table(s, d, "pages")).select(F.col("seq").alias("page_id"), S.dirname(p).alias("dir"), S.basename(p).alias("base"), S.stem(p).alias("stem"))


@query(
    r"""SELECT doc_id, regexp_matches(x, '(?im)^licensed under') AS has_license, regexp_matches(x, '[A-Za-z0-9._%+-]+@[a-z]+\.[a-z]+') AS has_email, regexp_matches(x, 'https?://') AS has_url
    FROM (SELECT doc_id, split_part(coalesce(text, ''), chr(10), 1) || chr(10) || coalesce(text, '') AS x FROM documents)"""
)
def annotation_flags(s, d):
    found = score.annotated(B.documents(s, d), {"has_license": r"(?im)^licensed under", "has_email": B.EMAIL, "has_url": "https?://"})
    return found.select(F.col("seq").alias("doc_id"), "has_license", "has_email", "has_url")


@query("SELECT CASE WHEN score >= 70 THEN 'hi' WHEN score >= 30 THEN 'mid' ELSE 'low' END AS tier, count(*) AS n FROM t GROUP BY 1", O.DOCS)
def score_tiers(s, d):
    return _scored(s, d).groupBy(S.tier(F.col("score")).alias("tier")).agg(F.count("*").alias("n"))


@query("SELECT record_id, coalesce(string_agg(prefix, '; ' ORDER BY prefix), '') AS touched FROM r LEFT JOIN guess USING (record_id) GROUP BY record_id", O.ORDERS)
def infer_paths(s, d):
    return _guesses(s, d).select("record_id", text_of("touched"))


@query("SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS rev FROM events WHERE event_id % 100 = 0 OR event_id = (SELECT max(event_id) FROM events)")
def sample_every_n(s, d):
    revisions = B.table(s, d, "events").select(F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("rev"))
    return product.sample_revisions(revisions, 100)


# patterns


@query(
    r"""SELECT ptype, count(*) AS n FROM (SELECT CASE WHEN starts_with(pattern, 're:') THEN 'regex' WHEN regexp_matches(pattern, '(^|[^\\])[*?\[]') THEN 'glob' ELSE 'keyword' END AS ptype FROM pat) GROUP BY 1""", O.PARTS
)
def pattern_types(s, d):
    return B.part_patterns(s, d).groupBy("ptype").agg(F.count("*").alias("n"))


@query("SELECT record_id, license_hit AS hit FROM (SELECT *, " + "(" + " OR ".join(t("body") for t in O._LICENSE) + ") AS license_hit FROM d)", O.DOCS.split(",\nh AS")[0])
def any_match(s, d):
    return B.documents(s, d).select("record_id", P.any_match(B.DOC_CATALOG.of_rule("license_terms", "keywords_whitelist"), F.col("body")).alias("hit"))


@query("SELECT record_id, coalesce(bool_or(starts_with(path, 'promo/brand_1/') OR regexp_matches(path, '(^|[^a-z0-9_])ring')), false) AS hit FROM r LEFT JOIN fl USING (k) GROUP BY record_id", O.ORDERS)
def any_file_match(s, d):
    return B.orders(s, d).select("record_id", P.any_file_match(["promo/brand_1/*", r"re:(^|[^a-z0-9_])ring"], F.col("files")).alias("hit"))


@query("SELECT record_id, coalesce(bool_and(starts_with(path, 'economy/') OR starts_with(path, 'small/')), false) AS hit FROM r LEFT JOIN fl USING (k) GROUP BY record_id", O.ORDERS)
def all_files_match(s, d):
    return B.orders(s, d).select("record_id", P.all_files_match(["economy/*", "small/*"], F.col("files")).alias("hit"))


@query(
    "SELECT record_id, rule, kind, pattern, value, CAST(row_number() OVER (PARTITION BY record_id, rule, kind ORDER BY pord, vord) AS INTEGER) AS ord FROM ph", O.DOCS, O.PATTERN_HITS
)
def pattern_hits(s, d):
    return score.pattern_hits(B.documents(s, d), B.DOC_CATALOG)


@query("SELECT DISTINCT record_id, rule, kind, pattern FROM ph WHERE kind = 'keywords_whitelist' AND (vord = 1 OR value = body_of)".replace("body_of", "(SELECT body FROM d WHERE d.record_id = ph.record_id)"), O.DOCS, O.PATTERN_HITS)
def pattern_join(s, d):
    wanted = [(r, k, p) for r, k, _, p in B.DOC_CATALOG.patterns if k == "keywords_whitelist"]
    return score.pattern_join(B.documents(s, d).select("record_id", "body"), wanted, "body").select("record_id", "rule", "kind", "pattern")


@query(
    "SELECT record_id, rule, kind, pattern, value, CAST(row_number() OVER (PARTITION BY record_id, rule, kind ORDER BY pord, vord) AS INTEGER) AS ord FROM ph", O.DOCS, O.PATTERN_HITS
)
def catalog_hits(s, d):
    return literal_index.catalog_hits(B.documents(s, d), B.DOC_CATALOG)


@query("SELECT record_id, profile, blocked, raw_total, capped, multiplier, final_score FROM ps WHERE any_hit OR blocked", O.DOCS)
def catalog_scores(s, d):
    return literal_index.catalog_scores(B.documents(s, d), B.DOC_CATALOG)


@query("SELECT record_id, rule, 'keywords_whitelist' AS kind, pattern FROM ht WHERE hit", O.PHRASES)
def pattern_index(s, d):
    return literal_index.pattern_index(B.documents(s, d).select("record_id", "body"), B.phrase_patterns(s, d), "body").select("record_id", "rule", "kind", "pattern")


@query(
    "SELECT record_id, rule, kind, pattern, value FROM (SELECT *, row_number() OVER (PARTITION BY record_id, rule, kind ORDER BY pord, vord) AS n FROM ph) WHERE n = 1", O.DOCS, O.PATTERN_HITS
)
def first_hit(s, d):
    return score.first_hit(score.pattern_hits(B.documents(s, d), B.DOC_CATALOG))


# catalogs


@query(
    """SELECT rule, arg_min(dir, tier) AS "dir", min(tier) AS tier, arg_min(dirs > 1, tier) AS collision FROM (
    SELECT p_brand AS rule, CAST(p_size % 2 AS INTEGER) AS tier, min(p_type) AS dir, count(DISTINCT p_type) AS dirs FROM pp GROUP BY 1, 2) GROUP BY rule""",
    O.PARTS,
)
def resolve_tiered(s, d):
    p = B.table(s, d, "part")
    wanted = p.select(F.concat(F.lit("shared:"), "p_brand").alias("rule")).distinct()
    found = C.resolve_tiered(wanted, p.select((F.col("p_size") % 2).cast("int").alias("tier"), F.col("p_brand").alias("name"), F.col("p_type").alias("dir")).distinct(), {"shared": "shared"})
    return found.select(F.col("name").alias("rule"), "dir", "tier", "collision")


@query("SELECT DISTINCT profile, kind, pattern FROM pr JOIN pat USING (rule)", O.PARTS)
def merged_patterns(s, d):
    return C.merged_patterns(B.part_patterns(s, d), B.part_profile_rules(s, d))


@query("SELECT kind, pattern, min(pf.ord) AS first FROM pr JOIN pat USING (rule) JOIN pf USING (profile) GROUP BY kind, pattern", O.PARTS)
def overall_patterns(s, d):
    return C.overall_patterns(B.part_patterns(s, d), B.part_profile_rules(s, d), B.part_profiles(s, d))


@query("SELECT profile, rule, weight, kind, pat.ord AS ord, pattern FROM pr JOIN pat USING (rule)", O.PARTS)
def inflated_rules(s, d):
    return C.inflated(B.part_patterns(s, d), B.part_profile_rules(s, d)).select("profile", "rule", "weight", "kind", "ord", "pattern")


@query("SELECT profile, count(DISTINCT rule) AS n_rules FROM pf LEFT JOIN pr USING (profile) GROUP BY profile", O.PARTS)
def rule_counts(s, d):
    return C.rule_counts(B.part_profiles(s, d), B.part_profile_rules(s, d))


@query(
    """SELECT 'weight_range' AS problem, profile AS name FROM pf WHERE NOT weight BETWEEN 0 AND 100
    UNION ALL SELECT 'no_rules', r_name FROM region UNION ALL SELECT DISTINCT 'empty_rule', 'rule of ' || p_type FROM part""",
    O.PARTS,
)
def dq_profiles(s, d):
    bare = B.table(s, d, "region").select(F.col("r_name").alias("profile"), F.lit(50.0).alias("weight"), F.lit(0).alias("ord"))
    profiles, rules = B.part_profiles(s, d), B.part_profile_rules(s, d)
    unknown = profiles.select("profile", F.concat(F.lit("rule of "), "profile").alias("rule"), F.lit(1).alias("weight"), F.lit(0).alias("ord"))
    return quality.profile_problems(profiles.union(bare), rules.union(unknown), B.part_patterns(s, d))


@query("SELECT profile, weight / 100 AS multiplier FROM pf", O.PARTS)
def profile_multipliers(s, d):
    return B.part_profiles(s, d).select("profile", C.multiplier_column(F.col("weight").cast("string")).alias("multiplier"))


@query(
    "SELECT 0 AS tier, 'file:/rules/brand' || b AS \"dir\", 'brand' || b AS rule, 'keywords_whitelist' AS kind, CAST(row_number() OVER (PARTITION BY b ORDER BY p_partkey) AS INTEGER) AS ord, p_name AS pattern FROM pp",
    O.PARTS,
)
def catalog_patterns(s, d):
    return C.parse_patterns(B.pattern_files(s, d))


_NAMED = "CASE WHEN length(profile) % 2 = 0 THEN 'all ' || profile ELSE profile END"


@query(f"SELECT {_NAMED} AS profile, rule, CAST(CASE WHEN weight % 3 = 2 THEN 50 ELSE weight END AS INTEGER) AS weight FROM pr", O.PARTS)
def catalog_profiles(s, d):
    return C.parse_profiles(B.profile_files(s, d))[1].select("profile", "rule", "weight")


@query(
    f"""SELECT rule, profile, 'path_whitelist' AS kind, CAST(ord AS INTEGER) AS ord, pattern FROM (SELECT rule, profile, unnest([0, 1]) AS ord, unnest(['a/*', type || '/*']) AS pattern FROM (
    SELECT rule, min({_NAMED}) AS profile, arg_min(profile, {_NAMED}) AS type FROM pr WHERE weight % 3 = 1 GROUP BY rule))""",
    O.PARTS,
)
def rule_extras(s, d):
    return C.parse_profiles(B.profile_files(s, d))[2]


@query("SELECT profile AS stem, 'all ' || profile AS profile FROM pf WHERE length(profile) % 2 = 0", O.PARTS)
def profile_stems(s, d):
    return C.profile_name_problems(C.parse_profiles(B.profile_files(s, d))[0])


@query(
    """SELECT sha256(concat_ws(':', count(*), sum(('0x' || substring(h, 1, 16))::UBIGINT), sum(('0x' || substring(h, 17, 16))::UBIGINT), sum(('0x' || substring(h, 33, 16))::UBIGINT), sum(('0x' || substring(h, 49, 16))::UBIGINT))) AS fingerprint FROM (SELECT sha256(line) AS h FROM (SELECT concat_ws(chr(9), 'pattern', rule, kind, ord, pattern) AS line FROM pat
    UNION ALL SELECT concat_ws(chr(9), 'profile', profile, CAST(weight AS VARCHAR)) FROM pf UNION ALL SELECT concat_ws(chr(9), 'rule', profile, rule, weight) FROM pr))""",
    O.PARTS,
)
def catalog_fingerprint(s, d):
    return C.fingerprint(B.part_patterns(s, d), B.part_profiles(s, d), B.part_profile_rules(s, d))


@query("SELECT p_brand AS rule, 'keywords_whitelist' AS kind, CASE WHEN p_size % 3 = 0 THEN 're:(' || p_name ELSE 're:(x)?(?(1)' || p_name || '|n)' END AS pattern FROM part WHERE p_size % 3 <> 1")
def invalid_patterns(s, d):
    return C.pattern_problems(s, B.odd_patterns(s, d))


@query("SELECT n_name AS keyword, unnest(CASE WHEN n_nationkey % 2 = 0 THEN ['a/' || n_name, 'b'] ELSE ['c/' || n_name] END) AS prefix FROM nation")
def hints_scan(s, d):
    return product.parse_hints(B.hint_files(s, d))


@query("SELECT replace(path, '.c', CASE WHEN p_size % 2 = 0 THEN '.o' ELSE '.ko' END) AS path FROM pp", O.ORDERS)
def artifact_listing(s, d):
    return product.artifact_paths(B.build_files(s, d), "file:/build/out/")


# pre-filter


@query("SELECT record_id, action, reason FROM dk", O.ORDERS)
def prefilter_decision(s, d):
    return _decided(s, d).select("record_id", "action", "reason")


@query("SELECT record_id, subject FROM dk WHERE action = 'keep'", O.ORDERS)
def prefilter_kept(s, d):
    return prefilter.kept(_decided(s, d)).select("record_id", "subject")


@query("SELECT record_id, reason AS filter_reason FROM dk WHERE action = 'drop'", O.ORDERS)
def prefilter_dropped(s, d):
    return prefilter.dropped(_decided(s, d)).select("record_id", "filter_reason")


@query("SELECT reason AS filter_reason, count(*) AS n FROM dk WHERE action = 'drop' GROUP BY 1 UNION ALL SELECT filter_reason, count(*) FROM low WHERE filter_reason IS NOT NULL GROUP BY 1", O.ORDERS)
def dropped_reasons(s, d):
    return prefilter.dropped_counts(_judged(s, d))


@query("SELECT DISTINCT 'file' AS kind, path AS value FROM s_file UNION ALL SELECT 'dir', dir FROM s_dir UNION ALL SELECT 'artifact', replace(path, '.c', '') FROM s_art UNION ALL SELECT 'log', base_stem FROM s_log", O.ORDERS)
def compiled_sets(s, d):
    return _sets(s, d)


@query("SELECT DISTINCT record_id FROM r JOIN fl USING (k) WHERE path IN (SELECT path FROM s_art)", O.ORDERS)
def semi_artifact(s, d):
    return evidence.with_artifact(B.orders(s, d), _sets(s, d))


@query("SELECT DISTINCT record_id FROM r JOIN fl USING (k) WHERE base_stem IN (SELECT base_stem FROM s_log)", O.ORDERS)
def semi_log(s, d):
    return evidence.in_log(B.orders(s, d), _sets(s, d))


@query("SELECT record_id FROM r JOIN ff USING (k) WHERE covered", O.ORDERS)
def coverage(s, d):
    return evidence.covered(B.orders(s, d), _sets(s, d))


@query("SELECT record_id FROM r JOIN ff USING (k) WHERE NOT covered", O.ORDERS)
def uncovered(s, d):
    return evidence.uncovered(B.orders(s, d), _sets(s, d))


# scores


@query("SELECT record_id, profile, blocked FROM ps", O.DOCS)
def profile_blocked(s, d):
    return score.profile_scores(_scored(s, d)).select("record_id", "profile", "blocked")


@query("SELECT record_id, profile, rule, weight, matched, matched_level, CASE WHEN matched THEN weight ELSE 0 END AS score FROM rl", O.DOCS, O.RULES)
def rule_hits(s, d):
    return score.rule_hits(_scored(s, d), B.DOC_CATALOG)


@query("SELECT record_id, profile, blocked, raw_total, capped, multiplier, final_score FROM ps", O.DOCS)
def profile_scores(s, d):
    return score.profile_scores(_scored(s, d))


@query("SELECT record_id, score FROM t", O.DOCS)
def total_scores(s, d):
    return _scored(s, d).select("record_id", "score")


@query("SELECT record_id, matched AS matched_profiles FROM t", O.DOCS)
def matched_profiles(s, d):
    return _scored(s, d).select("record_id", text_of("matched_profiles"))


@query(
    "SELECT record_id, profile, rule, matched_level, CASE WHEN matched THEN weight ELSE 0 END AS rule_score, final_score AS profile_score, kind, pattern, value FROM rl JOIN ps USING (record_id, profile) LEFT JOIN (SELECT record_id, rule, kind, pattern, value FROM ph) USING (record_id, rule)", O.DOCS, O.RULES, O.PATTERN_HITS
)
def rule_trace(s, d):
    return score.rule_trace(_scored(s, d), B.DOC_CATALOG)


@query(
    """SELECT record_id, string_agg(profile || ':' || m || '/' || n || '=' || final_score, '; ' ORDER BY profile) AS summary FROM (
    SELECT record_id, profile, count(*) FILTER (matched) AS m, count(*) AS n FROM rh GROUP BY 1, 2) JOIN ps USING (record_id, profile) GROUP BY record_id""",
    O.DOCS,
    O.RULES,
)
def trace_summary(s, d):
    return score.trace_summary(_scored(s, d), B.DOC_CATALOG)


# threshold and rank


@query("SELECT record_id, score, filter_reason FROM low", O.ORDERS)
def postfilter(s, d):
    return _order_scores(s, d).select("record_id", "score", "filter_reason")


@query("SELECT record_id, score, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM t", O.DOCS)
def ranked(s, d):
    return rank.ranked(_scored(s, d).select("record_id", "seq", "score")).select("record_id", "score", "rank")


@query("SELECT record_id, subject, score, rank FROM (SELECT *, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM t) WHERE rank <= 20", O.DOCS)
def top_n(s, d):
    return rank.best(_scored(s, d), 20).select("record_id", "subject", "score", "rank")


# evidence


@query("SELECT record_id, tag FROM ev_map", O.ORDERS)
def evidence_config_map(s, d):
    return evidence.config_map(cut(B.orders(s, d).select("record_id", "files"), "orders"), B.config_paths(s, d))


@query("SELECT record_id, tag FROM ev_dir", O.ORDERS)
def evidence_config_dir(s, d):
    return evidence.config_dir(_guesses(s, d), product.config_dirs(B.config_paths(s, d)))


@query("SELECT record_id, tag FROM ev_log", O.ORDERS)
def evidence_build_log(s, d):
    return evidence.build_log(_guesses(s, d), product.log_objects(B.log_lines(s, d)))


@query("SELECT record_id, tag FROM ev_art", O.ORDERS)
def evidence_artifact(s, d):
    return evidence.artifact(_guesses(s, d), B.artifacts(s, d))


@query("SELECT record_id, tag FROM ev_text", O.ORDERS)
def evidence_config_text(s, d):
    return evidence.config_text(B.orders(s, d), B.symbols(s, d))


@query("SELECT record_id, coalesce(string_agg(tag, '; ' ORDER BY tag), '') AS product_evidence FROM r LEFT JOIN ev USING (record_id) GROUP BY record_id", O.ORDERS)
def product_evidence(s, d):
    r, paths = cut(B.orders(s, d).select("record_id", "subject", "body", "files"), "orders"), cut(B.config_paths(s, d), "paths")
    found = evidence.product_evidence(evidence.with_touched(r, B.hints(s)), paths, product.config_dirs(paths), product.log_objects(B.log_lines(s, d)), B.artifacts(s, d), B.symbols(s, d))
    return found.select("record_id", text_of("product_evidence"))


@query("SELECT 'CONFIG_BRAND_' || b AS symbol, string_agg(path, '; ' ORDER BY path) AS paths FROM pp GROUP BY b", O.ORDERS)
def config_to_paths(s, d):
    return product.config_to_paths(B.config_paths(s, d)).select("symbol", text_of("paths"))


@query("""SELECT DISTINCT dir || '/' AS "dir" FROM pp""", O.ORDERS)
def config_dirs(s, d):
    return product.config_dirs(B.config_paths(s, d))


@query("SELECT symbol, path FROM mk UNION SELECT 'CONFIG_BRAND_' || b, path FROM pp", O.ORDERS, O.MAKEFILES)
def history_merge(s, d):
    return product.history_merge(product.history_paths(B.makefile_blobs(s, d)), B.config_paths(s, d))


@query(
    """SELECT 'CONFIG_BRAND_' || b AS symbol, 'brand_' || b || '/part_' || p_partkey || '.c' AS path, kf.first AS "first", CASE WHEN p_size % 7 = 0 THEN (SELECT min(l.first) FROM kf l WHERE l.k > kf.k) END AS "end"
    FROM pp JOIN kf ON kf.k = (p_size - 1) // 10""",
    O.PARTS,
    "kf AS (SELECT (p_size - 1) // 10 AS k, CAST(min(p_size - 1) AS BIGINT) AS first FROM part GROUP BY 1)",
)
def history_intervals(s, d):
    return product.history_intervals(B.makefile_history(s, d))


@query(
    """SELECT substring(sha256(rev || ':' || path), 1, 24) AS key, rev, path FROM (SELECT DISTINCT lower(p_type) AS rev, 'brand_' || b || '/Makefile' AS path FROM pp) WHERE rev NOT IN ('economy', 'promo')""",
    O.PARTS,
)
def blob_misses(s, d):
    blobs = B.makefile_blobs(s, d)
    return product.blob_misses(blobs.select("rev", "path"), blobs.where("rev in ('economy', 'promo')"))


@query("SELECT record_id FROM r WHERE k % 3 <> 0", O.ORDERS)
def incremental_new(s, d):
    r = B.orders(s, d)
    done = r.select("record_id", F.when(F.col("seq") % 3 == 0, "now").otherwise("before").alias("fingerprint"))
    return streaming.incremental_new(r, done, "now").select("record_id")


# reports


_SUMMARY = """SELECT p.profile AS profile, description, count(t.record_id) AS n, CAST(coalesce(sum(score), 0) AS BIGINT) AS total_score, coalesce(round_even(avg(score), 1), 0) AS avg_score
    FROM (VALUES ('legal', 'licence terms'), ('safety', 'abuse and secrets'), ('broad', 'anything of note')) p(profile, description) LEFT JOIN t ON contains(matched, p.profile) GROUP BY ALL"""


@query(_SUMMARY, O.DOCS)
def profile_summary(s, d):
    scored = _scored(s, d)
    return report.profile_summary(scored, rank.profile_frame(B.DOC_CATALOG, scored))


@query(f"SELECT * FROM ({_SUMMARY}) ORDER BY n DESC, profile LIMIT 2", O.DOCS)
def summary_by_count(s, d):
    return report.by_count(profile_summary(s, d)).limit(2)


@query("SELECT count(*) FILTER (matched = '') AS unmatched, count(*) FILTER (f IS NOT NULL) AS with_evidence FROM t JOIN (SELECT record_id, CASE WHEN starts_with(f, 'src1/') THEN f END AS f FROM d) USING (record_id)", O.DOCS)
def coverage_metrics(s, d):
    return report.coverage_metrics(_scored(s, d).withColumn("product_evidence", F.filter("files", lambda f: f.startswith("src1/"))))


_STATS_COLUMNS = ("collected", "kept", "dropped", "scored", "threshold", "post_dropped", "reported", "top_n", "max_score", "min_score", "avg_score", "unmatched", "with_evidence")
_STATS = """(SELECT * FROM (SELECT (SELECT count(*) FROM r) AS collected, count(*) AS kept, (SELECT count(*) FROM r) - count(*) AS dropped, count(*) AS scored, CAST(50 AS DOUBLE) AS threshold,
    count(*) FILTER (filter_reason IS NOT NULL) AS post_dropped, CAST(5000 AS BIGINT) AS top_n FROM low), (SELECT count(*) AS reported, CAST(coalesce(max(score), 0) AS BIGINT) AS max_score, CAST(coalesce(min(score), 0) AS BIGINT) AS min_score,
    coalesce(round_even(avg(score), 1), 0) AS avg_score, count(*) FILTER (score = 0 AND NOT blocked AND capped = 0) AS unmatched, count(*) FILTER (k IN (SELECT k FROM fl WHERE starts_with(path, 'promo/'))) AS with_evidence
    FROM (SELECT * FROM low WHERE filter_reason IS NULL ORDER BY score DESC, seq LIMIT 5000)))"""


@query(f"SELECT * FROM {_STATS}", O.ORDERS)
def report_stats(s, d):
    judged = _judged(s, d, F.filter("files", lambda f: f.startswith("promo/")).alias("product_evidence"))
    return report.report_stats(judged, 50, 5000)


@query(
    f"SELECT metric, value FROM (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _STATS_COLUMNS)} FROM {_STATS}) UNPIVOT (value FOR metric IN ({', '.join(_STATS_COLUMNS)}))",
    O.ORDERS,
)
def stats_kv(s, d):
    return report.stats_kv(report_stats(s, d))


@query(
    """SELECT rank, substring(record_id, 1, 12) AS "commit", score, subject, broad, legal, safety FROM (SELECT record_id, subject, score, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM t)
    JOIN (SELECT record_id, max(final_score) FILTER (profile = 'broad') AS broad, max(final_score) FILTER (profile = 'legal') AS legal, max(final_score) FILTER (profile = 'safety') AS safety FROM ps GROUP BY record_id) USING (record_id)""",
    O.DOCS,
)
def profile_matrix_wide(s, d):
    ranked = rank.ranked(_scored(s, d).select("record_id", "seq", "subject", "score", "matched_profiles", "profile_scores"))
    return report.profile_matrix_wide(ranked, report.seen_profiles(ranked))


@query("SELECT record_id, profile, final_score AS score FROM ps WHERE final_score > 0 OR blocked OR any_hit", O.DOCS)
def profile_matrix_long(s, d):
    return report.profile_matrix_long(_scored(s, d))


@query("SELECT record_id, reason AS filter_reason, 0 AS src FROM dk WHERE action = 'drop' UNION ALL SELECT record_id, filter_reason, 1 FROM low WHERE filter_reason IS NOT NULL", O.ORDERS)
def all_dropped(s, d):
    judged = cut(_judged(s, d).select("record_id", "seq", "action", "reason", "filter_reason"), "judged")
    early, low = prefilter.dropped(judged.drop("filter_reason")), judged.where("action = 'keep' and filter_reason is not null").drop("action", "reason")
    return report.all_dropped(early, low).select("record_id", "filter_reason", "src")


@query(
    """SELECT record_id, src, seq FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY src, seq) AS n FROM (
    SELECT record_id, 0 AS src, seq FROM r WHERE k % 2 = 0 UNION ALL SELECT record_id, 1, seq FROM r)) WHERE n = 1""",
    O.ORDERS,
)
def dedup_first(s, d):
    r = B.orders(s, d).select("record_id", "seq")
    both = r.where("seq % 2 = 0").withColumn("src", F.lit(0)).union(r.withColumn("src", F.lit(1)))
    return report.dedup_first(both).select("record_id", "src", "seq")


@query("SELECT substring(record_id, 1, 2) AS s1, substring(record_id, 3, 2) AS s2, count(*) AS n FROM r GROUP BY 1, 2", O.ORDERS)
def detail_shards(s, d):
    return report.with_shards(B.orders(s, d)).groupBy("s1", "s2").agg(F.count("*").alias("n"))


@query(
    """SELECT substring(record_id, 1, 12) AS "commit", subject, author_name AS author, strftime(make_timestamp(author_time * 1000000), '%Y-%m-%d %H:%M') AS date, CAST(score AS VARCHAR) AS score,
    CASE WHEN score > 0 OR blocked OR capped > 0 THEN 'orders' ELSE '' END AS profiles, 'orders:' || score AS profile_scores, '' AS evidence, CAST((SELECT count(*) FROM fl WHERE fl.k = so.k) AS VARCHAR) AS n_files FROM so""",
    O.ORDERS,
)
def commit_rows(s, d):
    scored = score.scored(prefilter.kept(_decided(s, d)), B.ORDER_CATALOG)
    return report.commit_rows(scored.withColumn("product_evidence", F.array().cast("array<string>")))


@query("SELECT record_id, 'author_time' AS field FROM d UNION ALL SELECT record_id, 'subject' FROM d WHERE seq % 7 = 0", O.DOCS)
def dq_required(s, d):
    r = B.documents(s, d)
    return quality.missing_fields(r.withColumn("subject", F.when(F.col("seq") % 7 != 0, F.col("subject"))))


# tables


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_totalprice < 300000 AND lower(o_orderpriority) = '1-urgent' AND regexp_matches(lower(o_orderstatus), 'o')")
def filter_tokens(s, d):
    return tables.filter_table(B.table(s, d, "orders"), {"o_totalprice": ">100000 <300000", "o_orderpriority": "=1-URGENT", "o_orderstatus": "o"}).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE contains(lower(c_mktsegment), 'build') OR contains(lower(c_mktsegment), 'mach')")
def filter_multi(s, d):
    return tables.filter_table(B.table(s, d, "customer"), chosen={"c_mktsegment": ["Build", "mach"]}).select("c_custkey")


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'ring') AND contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'brand#1')")
def search_all(s, d):
    return tables.filter_table(B.table(s, d, "part").select("p_partkey", "p_name", "p_brand", "p_type"), needles="Ring brand#1").select("p_partkey")


@query("SELECT count(*) FILTER (c_acctbal > 500) AS visible, count(*) AS total FROM customer")
def live_count(s, d):
    c = B.table(s, d, "customer")
    return tables.live_count(c, tables.token_filter(F.col("c_acctbal"), ">500"))


@query("SELECT DISTINCT o_orderstatus AS value FROM orders UNION SELECT DISTINCT o_orderpriority FROM orders")
def facets(s, d):
    both = B.table(s, d, "orders").select(F.concat_ws("; ", "o_orderstatus", "o_orderpriority").alias("x"))
    return tables.facets(both, "x")


@query("SELECT token, n FROM tc", O.TOKENS)
def token_counts(s, d):
    return tokens.token_counts(spread(B.table(s, d, "documents")))


_PREFERRED = [*tokens.PREFERRED, "license", "zzz", "token", "mit"]
_ALWAYS = ", ".join(f"'{t}'" for t in tokens.ALWAYS)


@query(
    f"""SELECT token FROM (SELECT unnest({_PREFERRED}) AS token) WHERE token IN (SELECT token FROM tc) OR token IN ({_ALWAYS})
    UNION ALL SELECT token FROM (SELECT * FROM (SELECT * FROM tc ORDER BY n DESC, token LIMIT 200) WHERE n >= 2 AND regexp_matches(token, '^[a-z][a-z0-9+.-]*$') AND token NOT IN (SELECT token FROM (SELECT unnest({_PREFERRED}) AS token) WHERE token IN (SELECT token FROM tc) OR token IN ({_ALWAYS}))
    ORDER BY n DESC, token LIMIT (SELECT 80 - count(*) FROM (SELECT unnest({_PREFERRED}) AS token) WHERE token IN (SELECT token FROM tc) OR token IN ({_ALWAYS})))""",
    O.TOKENS,
)
def top_prefixes(s, d):
    found = cut(tokens.tokens_of(spread(B.table(s, d, "documents"))), "tokens")
    return tokens.top_prefixes(tokens.prefix_counts(found, _PREFERRED), _PREFERRED).select("token")


@query("SELECT token, n FROM tc ORDER BY n DESC, token LIMIT 200", O.TOKENS)
def top_tokens(s, d):
    return tokens.most_frequent(cut(tokens.tokens_of(spread(B.table(s, d, "documents"))), "tokens"), 200)


@query(r"SELECT 're:^' || token || '(?:\s|:|$)' AS pattern FROM tc WHERE regexp_matches(token, '^[a-z0-9]+$') AND n >= 5", O.TOKENS)
def prefix_patterns(s, d):
    counts = tokens.token_counts(spread(B.table(s, d, "documents"))).where("n >= 5")
    return tokens.pattern_lines(counts.where(F.col("token").rlike("^[a-z0-9]+$")))


# streaming


@query("SELECT record_id, score FROM t", O.DOCS)
def stream_scores(s, d):
    at = new_path(s, "stream")
    report.write_lines(B.documents(s, d), f"{at}/in")
    done = streaming.write_stream(streaming.score_stream(streaming.read_stream(s, f"{at}/in"), B.DOC_CATALOG), f"{at}/out", f"{at}/state")
    done.awaitTermination()
    return s.read.parquet(f"{at}/out").select("record_id", "score")


@query("SELECT record_id, 'now' AS fingerprint, score FROM t", O.DOCS)
def score_increments(s, d):
    path, docs = new_path(s, "increments"), B.documents(s, d)
    early = docs.where("author_name < 'src2'")
    streaming.score_increment(early, path, B.DOC_CATALOG, "now")
    return streaming.score_increment(docs, path, B.DOC_CATALOG, "now")


@query("SELECT record_id, score FROM t", O.DOCS)
def increment_batches(s, d):
    """Some documents under another text, then all: what has changed is scored again, each record counts once, and a batch that is told twice is one."""
    docs, table = B.documents(s, d), increments.scores_table(s, new_path(s, "batches"))
    early = docs.where("author_name < 'src2'").withColumn("body", F.lit("license"))
    increments.score_batch(early, table, B.DOC_CATALOG, "now", "first")
    increments.score_batch(docs, table, B.DOC_CATALOG, "now", "second")
    increments.score_batch(early, table, B.DOC_CATALOG, "now", "second")
    return increments.current_scores(table).select("record_id", "score")


@query("SELECT record_id, action, reason FROM dk", O.ORDERS)
def stream_decisions(s, d):
    at, sets = new_path(s, "stream"), cut(_sets(s, d), "sets")
    # every fifth order comes again: twice where it is made, and not made once more for it
    times = F.when(F.col("seq") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    with dropping_shuffles(s):
        report.write_lines(B.orders(s, d).withColumn("_n", F.explode(times)).drop("_n"), f"{at}/in", compression="gzip", maxRecordsPerFile=500_000)
    table = increments.scores_table(s, f"{at}/out")
    # what decides, and the time: no more of a record is moved
    read = streaming.read_stream(s, f"{at}/in", "record_id string, subject string, body string, files array<string>, author_time long", streaming.AT_ONCE)
    # orders are years apart and not in order of time
    with dropping_shuffles(s):
        streaming.decide_stream(streaming.once(read, "author_time", "10000 days"), table, B.ORDER_CATALOG, "now", f"{at}/state", sets).awaitTermination()
    for done in ("in", "state"):
        remove(s, f"{at}/{done}")
    return increments.current_scores(table).select("record_id", "action", "reason")


@query("SELECT record_id, score FROM t WHERE score >= 40", O.DOCS)
def resumed_steps(s, d):
    """Scores, and what passes: made, made again for a changed source, and kept for the same one."""
    steps, every = increments.Steps(s, new_path(s, "steps"), ("scores", "passed")), B.documents(s, d)
    for source, docs in (("some", every.where("author_name < 'src2'")), ("all", every), ("all", None)):
        scores = steps.run("scores", source, lambda docs=docs: score.scored(docs, B.DOC_CATALOG).select("record_id", "score"))
        passed = steps.run("passed", source, lambda scores=scores: scores.where("score >= 40"))
    return passed.select("record_id", "score")


# flags


@query(
    r"""SELECT record_id, is_fix, has_cve, has_syzbot, has_stable_cc, array_to_string(list_filter([CASE WHEN is_fix THEN 'is_fix' END, CASE WHEN has_cve THEN 'has_cve' END, CASE WHEN has_syzbot THEN 'has_syzbot' END, CASE WHEN has_stable_cc THEN 'has_stable_cc' END], lambda x: x IS NOT NULL), '; ') AS meta_flags
    FROM (SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id, starts_with(o_orderpriority, '1') OR o_orderstatus <> 'F' AS is_fix, starts_with(o_orderpriority, '2') AS has_cve, starts_with(o_orderpriority, '3') AS has_syzbot, o_orderstatus = 'F' AS has_stable_cc FROM orders)"""
)
def commit_flags(s, d):
    return score.annotated(B.flagged_orders(s, d)).select("record_id", "is_fix", "has_cve", "has_syzbot", "has_stable_cc", text_of("meta_flags"))


@query("SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id FROM orders WHERE starts_with(o_orderpriority, '1')")
def flags_of_flat_bodies(s, d):
    return score.annotated(B.flagged_orders(s, d), flatten_body=True).where("is_fix").select("record_id")


# checks


@query("SELECT record_id, 'score' AS field FROM d WHERE author_name = 'src1' UNION ALL SELECT record_id, 'product_evidence' FROM d", O.DOCS)
def dq_scored(s, d):
    return quality.incomplete_scores(_scored(s, d).withColumn("score", F.when(F.col("author_name") != "src1", F.col("score"))))


@query("SELECT record_id FROM dk WHERE action = 'drop' AND starts_with(subject, '5')", O.ORDERS)
def dq_reasons(s, d):
    dropped = prefilter.dropped(_decided(s, d))
    return quality.without_reason(dropped.withColumn("filter_reason", F.when(~F.col("subject").startswith("5"), F.col("filter_reason")))).select("record_id")


@query("SELECT record_id, reason AS filter_reason FROM dk WHERE action = 'drop' ORDER BY seq LIMIT 50", O.ORDERS)
def dropped_sample(s, d):
    return prefilter.inspect(_all_dropped(s, d), "prefilter", 50)[1].select("record_id", "filter_reason")


# sinks, each read back


@query("SELECT record_id, 'record_id,subject,body,author_name,files,score,matched_profiles,seq,_note' AS keys FROM t", O.DOCS)
def json_records(s, d):
    path = new_path(s, "json")
    report.write_json(_scored(s, d).select(F.lit("x").alias("_note"), "seq", "score", "matched_profiles", "files", "body", "author_name", "subject", "record_id"), path)
    return s.read.text(path).select(F.get_json_object("value", "$.record_id").alias("record_id"), F.array_join(F.json_object_keys("value"), ",").alias("keys"))


@query("SELECT record_id, seq, subject, author_name FROM r", O.ORDERS)
def collected_lines(s, d):
    path = new_path(s, "lines")
    report.write_lines(B.orders(s, d).select("record_id", "seq", "subject", "author_name"), path)
    return s.read.schema("record_id string, seq long, subject string, author_name string").json(path)


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 500 AND contains(lower(c_mktsegment), 'auto')")
def export_csv(s, d):
    path = new_path(s, "csv")
    tables.export(B.table(s, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path, tokens={"c_acctbal": ">500"}, chosen={"c_mktsegment": ["AUTO"]})
    return s.read.schema("c_custkey long, c_name string, c_acctbal double, c_mktsegment string").csv(path, header=True).select("c_custkey", "c_name")


@query("SELECT record_id, substring(record_id, 1, 2) AS s1, substring(record_id, 3, 2) AS s2 FROM d", O.DOCS)
def detail_files(s, d):
    path = new_path(s, "details")
    docs = B.documents(s, d).select("record_id", "seq", F.lit(1).alias("src"))
    report.write_details(docs.union(docs.withColumn("src", F.lit(2))), path)
    return s.read.schema("record_id string, s1 string, s2 string").json(path)


@query(
    """SELECT record_id, CASE WHEN action = 'keep' AND low.filter_reason IS NULL THEN 0 ELSE 1 END AS src, coalesce(low.filter_reason, CASE WHEN action = 'drop' THEN reason END) AS filter_reason, substring(record_id, 1, 2) AS s1, substring(record_id, 3, 2) AS s2
    FROM dk LEFT JOIN (SELECT record_id, filter_reason FROM low) low USING (record_id)""",
    O.ORDERS,
)
def report_details(s, d):
    judged = cut(_judged(s, d).select("record_id", "seq", "filter_reason"), "judged")
    kept = judged.where("filter_reason is null")
    return report.details(kept, judged).select("record_id", "src", "filter_reason", "s1", "s2")


@query("SELECT record_id, subject, author_name, CAST(NULL AS VARCHAR) AS author_time, score, matched AS matched_profiles, CASE WHEN score < 40 THEN 'score_below_threshold (40.0)' END AS filter_reason FROM t", O.DOCS)
def table_rows(s, d):
    rows = report.table_rows(rank.postfilter(_scored(s, d), "40"))
    return rows.withColumn("matched_profiles", text_of("matched_profiles"))


@query("SELECT record_id, score FROM t", O.DOCS)
def stage_tables(s, d):
    path = new_path(s, "table")
    report.write_table(_scored(s, d).select("record_id", "score"), path)
    none = records.stage_table(s, new_path(s, "absent"), "record_id string, score int")
    return records.stage_table(s, path, "record_id string, score int").union(none)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def sorted_table(s, d):
    o = B.table(s, d, "orders").select("o_orderkey", "o_totalprice")
    return tables.sort_table(o.withColumn("shown", F.col("o_totalprice").cast("string")), "shown", descending=True).limit(100).drop("shown")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name DESC, c_custkey DESC LIMIT 50")
def sorted_texts(s, d):
    c = B.table(s, d, "customer").select("c_custkey", "c_name")
    return tables.sort_table(c, "c_name", descending=True).limit(50)
