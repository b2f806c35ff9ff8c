"""The operators bound to the test tables: records, catalogs and product context derived from them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions.patterns import pattern_type_column
from winnow.sources import records as R
from winnow.sources.catalog import Catalog
from winnow.sources.stages import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(n: int) -> str:
    return hashlib.sha256(str(n).encode()).hexdigest()


EMAIL = r"[A-Za-z0-9._%+-]+@[a-z]+\.[a-z]+"

DOC_CATALOG = Catalog(
    profiles=[("legal", "licence terms", 100.0, 0), ("safety", "abuse and secrets", 29.0, 1), ("broad", "anything of note", 70.0, 2)],
    profile_rules=[
        ("legal", "license_terms", 60, 0),
        ("legal", "source_paths", 25, 1),
        ("safety", "abuse_words", 55, 0),
        ("safety", "secrets", 30, 1),
        ("safety", "source_paths", 25, 2),
        ("broad", "license_terms", 80, 0),
        ("broad", "abuse_words", 50, 1),
        ("broad", "secrets", 30, 2),
    ],
    patterns=[
        ("license_terms", "keywords_whitelist", 0, "license"),
        ("license_terms", "keywords_whitelist", 1, "mit"),
        ("license_terms", "keywords_whitelist", 2, "apache"),
        ("license_terms", "keywords_whitelist", 3, r"re:\bGNU\b"),
        ("license_terms", "keywords_whitelist", 4, "*public license*"),
        ("source_paths", "path_whitelist", 0, "src1/*"),
        ("source_paths", "path_whitelist", 1, "src2/en/*"),
        ("abuse_words", "keywords_whitelist", 0, "idiot"),
        ("abuse_words", "keywords_whitelist", 1, "stupid"),
        ("abuse_words", "keywords_whitelist", 2, "worthless"),
        ("abuse_words", "keywords_blacklist", 0, "apache"),
        ("abuse_words", "path_blacklist", 0, "src3/*"),
        ("secrets", "keywords_whitelist", 0, "token"),
        ("secrets", "keywords_whitelist", 1, f"re:{EMAIL}"),
        # invalid, beyond the JVM, and a class that is an intersection to the JVM alone: none of them matches a document
        ("secrets", "keywords_whitelist", 2, "re:(token"),
        ("secrets", "keywords_whitelist", 3, "re:(t)?(?(1)oken|never)"),
        ("secrets", "keywords_whitelist", 4, "re:[\u2603&&\u2604][[]"),
        ("secrets", "commit_whitelist", 0, sha(12)),
        ("secrets", "commit_blacklist", 0, sha(11)),
    ],
)

ORDER_CATALOG = Catalog(
    profiles=[("orders", "orders of note", 100.0, 0)],
    profile_rules=[("orders", "paths", 40, 0), ("orders", "words", 50, 1), ("orders", "ids", 30, 2)],
    patterns=[
        ("paths", "path_whitelist", 0, "promo/brand_1/*"),
        ("paths", "path_blacklist", 0, "economy/*"),
        ("words", "keywords_whitelist", 0, "1-URGENT"),
        ("words", "keywords_blacklist", 0, "P"),
        ("ids", "commit_whitelist", 0, sha(3)),
        ("ids", "commit_whitelist", 1, sha(5)),
        ("ids", "commit_blacklist", 0, sha(6)),
        ("ids", "commit_blacklist", 1, sha(7)),
    ],
)

#: Priorities and where their parts are looked for.
HINTS = [("urgent", "promo/brand_1"), ("high", "economy/brand_2/bolt"), ("high", "small/brand_3"), ("low", "large/ring"), ("medium", "medium/brand_30/nothing"), ("5-", "standard/brand_4/widget")]
EXTRA_SYMBOLS = [("CONFIG_URGENT=y",), ("CONFIG_LOW=m",)]


def documents(spark: SparkSession, d: str) -> DataFrame:
    return R.from_documents(spread(table(spark, d, "documents")))


def orders(spark: SparkSession, d: str) -> DataFrame:
    return R.from_orders(*(table(spark, d, t) for t in ("orders", "lineitem", "part", "customer")))


def _parts(spark: SparkSession, d: str) -> DataFrame:
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return table(spark, d, "part").select("*", R.part_path().alias("path"), number.alias("b"))


def config_paths(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select(F.concat(F.lit("CONFIG_BRAND_"), F.col("b").cast("string")).alias("symbol"), "path")


def enabled(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).where("b <= 8").select(F.concat(F.lit("CONFIG_BRAND_"), F.col("b").cast("string"), F.lit("=y")).alias("symbol")).distinct()


def artifacts(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).where("p_size > 45").select(F.regexp_replace("path", r"\.c$", ".o").alias("path"))


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).where("p_partkey % 37 = 0").select(F.concat(F.lit("  CC [M]  drivers/"), F.regexp_replace("path", r"\.c$", ".o")).alias("value"))


def hints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HINTS, "keyword string, prefix string")


def symbols(spark: SparkSession, d: str) -> DataFrame:
    return enabled(spark, d).union(spark.createDataFrame(EXTRA_SYMBOLS, "symbol string"))


def part_patterns(spark: SparkSession, d: str) -> DataFrame:
    """A large catalog: brands are rules, names, types and sizes patterns of all three types."""
    p = _parts(spark, d)
    kind = F.when(F.col("p_partkey") % 3 == 0, "path_whitelist").otherwise("keywords_whitelist")
    pattern = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lower("p_type"), F.lit("/brand_"), F.col("b").cast("string"), F.lit("/*")))
        .when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("re:^"), "p_name"))
        .when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit(r"\*")))
        .otherwise(F.col("p_name"))
    )
    rows = p.select(F.col("p_brand").alias("rule"), kind.alias("kind"), F.col("p_partkey").cast("int").alias("ord"), pattern.alias("pattern"))
    return rows.withColumn("ptype", pattern_type_column(F.col("pattern")))


def part_profile_rules(spark: SparkSession, d: str) -> DataFrame:
    """Types are profiles, the brands they have are their rules."""
    by = _parts(spark, d).groupBy(F.col("p_type").alias("profile"), F.col("p_brand").alias("rule"))
    return by.agg((F.sum("p_size") % 101).cast("int").alias("weight"), F.min("p_partkey").cast("int").alias("ord"))


def part_profiles(spark: SparkSession, d: str) -> DataFrame:
    by = _parts(spark, d).groupBy(F.col("p_type").alias("profile"))
    return by.agg((F.length(F.first("p_type")) * 15).cast("double").alias("weight"), F.min("p_partkey").cast("int").alias("ord"))


def pattern_files(spark: SparkSession, d: str) -> DataFrame:
    """A pattern file per brand, with comments and blank lines: path, value."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: F.concat(x["p_name"], F.lit("  # "), x["p_partkey"].cast("string")))
    by = _parts(spark, d).groupBy("b").agg(F.array_join(lines, "\n").alias("lines"))
    folder = F.concat(F.lit("file:/rules/brand"), F.col("b").cast("string"))
    return by.select(F.concat(folder, F.lit("/keywords_whitelist.txt")).alias("path"), F.concat(F.lit("# names\n"), "lines", F.lit("\n\n")).alias("value")).union(by.select(F.concat(folder, F.lit("/notes.txt")), F.lit("none")))


def profile_files(spark: SparkSession, d: str) -> DataFrame:
    """A profile file per type, with comments: a rule's entry is a number, an object with a weight and extras, or empty. file, value.

    Types of an even length have a name of their own.
    """
    by = part_profile_rules(spark, d)
    weight = F.col("weight").cast("string")
    extras = F.concat(F.lit('{"weight": '), weight, F.lit(', "path_whitelist_extra": ["a/*", "'), "profile", F.lit('/*"]}'))
    spec = F.when(F.col("weight") % 3 == 0, weight).when(F.col("weight") % 3 == 1, extras).otherwise("{}")
    entry = F.concat(F.lit('"'), "rule", F.lit('": '), spec)
    rules = by.groupBy("profile").agg(F.array_join(F.array_sort(F.collect_list(entry)), ",\n").alias("rules"))
    name = F.when(F.length("profile") % 2 == 0, F.concat(F.lit("all "), "profile")).otherwise(F.col("profile"))
    value = F.concat(F.lit('{ // a profile\n"name": "'), name, F.lit('", # and\n"description": "https://x # y",\n"rules": {'), "rules", F.lit("}}"))
    return rules.select(F.concat("profile", F.lit(".json")).alias("file"), value.alias("value"))


def hint_files(spark: SparkSession, d: str) -> DataFrame:
    """A hint file per region: nations with two prefixes or one that stands alone. value."""
    n = table(spark, d, "nation")
    entry = F.concat(F.lit('"'), "n_name", F.lit('": '), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit('["a/'), "n_name", F.lit('", "b"]'))).otherwise(F.concat(F.lit('"c/'), "n_name", F.lit('"'))))
    return n.groupBy("n_regionkey").agg(F.concat(F.lit('{"// note": "x", '), F.array_join(F.collect_list(entry), ", "), F.lit("}")).alias("value")).select("value")


def build_files(spark: SparkSession, d: str) -> DataFrame:
    """Sources and what is built of them, as a listing: path."""
    p = _parts(spark, d)
    built = F.regexp_replace("path", r"\.c$", F.when(F.col("p_size") % 2 == 0, ".o").otherwise(".ko"))
    at = lambda c: F.concat(F.lit("file:///build/out/"), c).alias("path")
    return p.select(at(F.col("path"))).union(p.select(at(built))).union(p.select(F.concat(F.lit("file:///elsewhere/"), built)))


def flagged_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as records whose texts say what their priority and status tell."""
    o, key = table(spark, d, "orders"), F.col("o_orderkey").cast("string")
    first = F.substring("o_orderpriority", 1, 1)
    subject = F.when(first == "1", F.concat(F.lit("Fixes : "), F.substring(F.sha2(key, 256), 1, 8), F.lit(" in orders"))).otherwise(F.concat(F.lit("order "), key))
    body = F.concat(
        F.when(first == "2", F.concat(F.lit("see cve-2024-"), F.lpad(key, 5, "0"))).when(first == "3", "found by SyzBot").when(first == "4", "fixes: none").otherwise("plain"),
        F.when(F.col("o_orderstatus") == "F", "\nCC: someone, stable list").otherwise("\nfixes: 0123456789ab"),
    )
    return o.select(F.sha2(key, 256).alias("record_id"), F.col("o_orderkey").alias("seq"), subject.alias("subject"), body.alias("body"))


def event_history(spark: SparkSession, d: str) -> DataFrame:
    """Events as a history, newest first, in which every seventh is a merge: record_id, seq, parents."""
    e = F.col("event_id")
    first, second = (e - 1 - e % 97).cast("string"), (e - 1).cast("string")
    return table(spark, d, "events").select(e.cast("string").alias("record_id"), (-e).alias("seq"), F.when(e % 7 == 0, F.array(first, second)).otherwise(F.array(first)).alias("parents"))


def makefile_blobs(spark: SparkSession, d: str) -> DataFrame:
    """A revision per type: a makefile per brand with a line per part, some of which lead through other folders."""
    key, symbol = F.col("p_partkey").cast("string"), F.concat(F.lit("obj-$(CONFIG_BRAND_"), F.col("b").cast("string"), F.lit(") += "))
    line = F.concat(symbol, F.regexp_replace("p_name", " ", "_"), F.lit("_"), key, F.lit(".o"))
    around = F.concat(F.lit("\n"), symbol, F.lit("../dotted.d/x"), key, F.lit(".o ./sub.d/e/../../y"), key, F.lit(".o ../../above"), key, F.lit(".o"))
    line = F.concat(line, F.when(F.col("p_partkey") % 11 == 0, around).otherwise(""))
    by = _parts(spark, d).groupBy(F.lower("p_type").alias("rev"), F.concat(F.lit("brand_"), F.col("b").cast("string"), F.lit("/Makefile")).alias("path"))
    return by.agg(F.concat(F.lit("# parts\nobj-y += always.o\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("text"))


def makefile_history(spark: SparkSession, d: str) -> DataFrame:
    """A revision per size: a makefile per brand that changes with every tenth size, when parts of these sizes come and some of the former go. seq, path, text."""
    p = _parts(spark, d).withColumn("size", (F.col("p_size") - 1).cast("long"))
    revisions = p.select(F.col("size").alias("seq")).distinct().withColumn("k", F.expr("seq div 10"))
    # a handful of sizes, for each part
    told = p.join(F.broadcast(revisions.select("k").distinct()), (F.expr("size div 10") <= F.col("k")) & ((F.col("p_size") % 7 != 0) | (F.expr("size div 10") == F.col("k"))))
    line = F.concat(F.lit("obj-$(CONFIG_BRAND_"), F.col("b").cast("string"), F.lit(") += part_"), F.col("p_partkey").cast("string"), F.lit(".o"))
    texts = told.groupBy("b", "k").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
    every = p.select("b").distinct().crossJoin(F.broadcast(revisions)).join(texts, ["b", "k"], "left")
    return every.select("seq", F.concat(F.lit("brand_"), F.col("b").cast("string"), F.lit("/Makefile")).alias("path"), F.coalesce("text", F.lit("# none")).alias("text"))


def phrase_patterns(spark: SparkSession, d: str) -> list[tuple[str, str, str]]:
    """A large catalog, as a list: each two words that follow each other in an item of the benchmark, as keyword, glob or expression. (rule, kind, pattern)."""
    words = table(spark, d, "benchmark").select("item_id", F.split("text", r"\s+").alias("w"))
    pairs = words.select("item_id", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.struct(F.get("w", i - 1).alias("a"), F.get("w", i).alias("b")))).alias("i", "x"))
    plain = r"\A[A-Za-z]{2,}\z"
    both = pairs.where(F.col("x.a").rlike(plain) & F.col("x.b").rlike(plain)).select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("rule"), (F.col("i") % 3).alias("k"), F.concat_ws(" ", "x.a", "x.b").alias("p"))
    pattern = F.when(F.col("k") == 0, F.col("p")).when(F.col("k") == 1, F.concat(F.lit("*"), "p", F.lit("*"))).otherwise(F.concat(F.lit("re:"), "p"))
    return [(r["rule"], "keywords_whitelist", r["p"]) for r in both.select("rule", pattern.alias("p")).distinct().collect()]


def odd_patterns(spark: SparkSession, d: str) -> Catalog:
    """A catalog of expressions made of parts' names: invalid ones, ones with a named group, and ones beyond the JVM."""
    p = table(spark, d, "part")
    body = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("re:("), "p_name")).when(F.col("p_size") % 3 == 1, F.concat(F.lit("re:(?P<a_b>"), "p_name", F.lit(")(?P=a_b)"))).otherwise(F.concat(F.lit("re:(x)?(?(1)"), "p_name", F.lit("|n)")))
    return Catalog(patterns=[tuple(r) for r in p.select("p_brand", F.lit("keywords_whitelist"), F.col("p_partkey").cast("int"), body).collect()])


def raw_log(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a text log: seq, value."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("\t", F.when(F.col("l_quantity") > 40, "-").otherwise(F.col("l_quantity").cast("long").cast("string")), F.col("l_linenumber").cast("string"), F.concat(F.lit("p/"), F.col("l_partkey").cast("string"))))), "\n").alias("tail")
    )
    o = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    head = F.concat(
        F.lit("\ncommit="),
        F.sha2(F.col("o_orderkey").cast("string"), 256),
        F.lit("\nauthor_name=customer "),
        F.col("o_custkey").cast("string"),
        F.lit("\nauthor_email=none\nauthor_time="),
        F.when(F.col("o_orderkey") % 10 == 0, "unknown").otherwise(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")),
        F.lit("\ncommit_time=7\nparents="),
        F.when(F.col("o_orderkey") % 4 == 0, "a b").otherwise("a"),
        F.lit("\nsubject="),
        F.col("o_orderpriority"),
        F.lit("\nbody=status "),
        F.col("o_orderstatus"),
        F.lit("\n\nsubject=not this\n"),
    )
    return o.select(F.col("o_orderkey").alias("seq"), F.concat(head, F.lit(R.TAIL_MARK), F.lit("\n"), F.coalesce("tail", F.lit("")), F.lit("\nalone.txt\n")).alias("value"))
