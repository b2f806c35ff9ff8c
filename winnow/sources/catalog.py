"""Rule catalogs: patterns, profiles and their weights, as small driver-side tables.

A catalog is what users write by hand, folders of pattern files and profile files, so its size
does not grow with the data; it is read by Spark and kept as lists, from which Columns are built.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.patterns import java_regex, pattern_type_column, prepare

#: The lists that a rule may have, in the order they are traced.
KINDS = ("keywords_whitelist", "keywords_blacklist", "path_whitelist", "path_blacklist", "commit_whitelist", "commit_blacklist")
DEFAULT_WEIGHT, CAP = 50, 100

PATTERNS = "rule string, kind string, ord int, pattern string"
PROFILES = "profile string, description string, weight double, ord int"
PROFILE_RULES = "profile string, rule string, weight int, ord int"


@dataclass
class Catalog:
    """profiles: (profile, description, weight, ord); profile_rules: (profile, rule, weight, ord); patterns: (rule, kind, ord, pattern)."""

    profiles: list[tuple] = field(default_factory=list)
    profile_rules: list[tuple] = field(default_factory=list)
    patterns: list[tuple] = field(default_factory=list)

    def of_rule(self, rule: str, kind: str) -> list[str]:
        return [p for r, k, _, p in sorted(self.patterns, key=lambda x: x[2]) if (r, k) == (rule, kind)]

    def rules_of(self, profile: str) -> list[tuple[str, int]]:
        return [(r, w) for p, r, w, _ in sorted(self.profile_rules, key=lambda x: x[3]) if p == profile]

    def names(self) -> list[str]:
        return [p[0] for p in sorted(self.profiles, key=lambda x: x[3])]

    def rules(self) -> list[str]:
        return list(dict.fromkeys(r for p in self.names() for r, _ in self.rules_of(p)))

    def merged(self, profile: str, kind: str) -> list[str]:
        """A profile's patterns of a kind: the union over its rules, sorted."""
        return sorted({x for r, _ in self.rules_of(profile) for x in self.of_rule(r, kind)})

    def overall(self, kind: str) -> list[str]:
        """All profiles' patterns of a kind, in order of first occurrence."""
        return list(dict.fromkeys(x for p in self.names() for x in self.merged(p, kind)))

    def multiplier(self, profile: str) -> float:
        w = next(p[2] for p in self.profiles if p[0] == profile)
        return 1.0 if w is None else max(0.0, w) / 100

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        """patterns with ptype, profiles, profile_rules."""
        patterns = spark.createDataFrame(self.patterns, PATTERNS).withColumn("ptype", pattern_type_column(F.col("pattern")))
        return patterns, spark.createDataFrame(self.profiles, PROFILES), spark.createDataFrame(self.profile_rules, PROFILE_RULES)


def multiplier_column(weight: Column) -> Column:
    """A profile's weight as a factor; one without a usable weight counts in full."""
    return F.coalesce(F.greatest(F.lit(0.0), weight.try_cast("double")) / 100, F.lit(1.0))


def rule_weight(spec: Column) -> Column:
    """The weight in a profile's entry of a rule: a number, or an object's weight, or the default."""
    return F.coalesce(spec.try_cast("int"), F.get_json_object(spec, "$.weight").try_cast("int"), F.lit(DEFAULT_WEIGHT))


def parse_patterns(files: DataFrame, tier: int = 0) -> DataFrame:
    """Pattern files(path, value), <folder>/<rule>/<kind>.txt: tier, dir, rule, kind, ord, pattern. Comments and blank lines are left out."""
    lines = files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))
    pattern = F.trim(F.regexp_replace("line", r"(^|(?<=\s))#.*$", ""))
    return (
        lines.select(
            F.lit(tier).alias("tier"),
            F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
            F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("rule"),
            F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("kind"),
            "ord",
            pattern.alias("pattern"),
        )
        .where("pattern <> ''")
        .where(F.col("kind").isin(*KINDS))
    )


def read_patterns(spark: SparkSession, folder: str, tier: int = 0) -> DataFrame:
    """The pattern files below a folder; see parse_patterns."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*list.txt").text(folder, wholetext=True)
    return parse_patterns(files.select(F.col("_metadata.file_path").alias("path"), "value"), tier)


#: A comment, and what stands before it: strings go first, so that marks within them are none.
_COMMENT = r'("(?:[^"\\]|\\.)*")|(?://|#)[^\n]*'


def parse_profiles(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Profile files(file, value): (profiles with each file's stem, profile_rules, extras).

    `//` and `#` comments are allowed outside of strings. A rule's entry is a weight or an object with one and with lists named
    <kind>_extra; of a rule's extras those of the first profile, by name, that lists any count. A file that is no
    JSON object is a profile with problem set, named after its file.
    """
    text = F.regexp_replace("value", _COMMENT, "$1")
    shape = "name string, description string, weight string, rules map<string,string>, _bad string"
    parsed = files.select("file", F.from_json(text, shape, {"columnNameOfCorruptRecord": "_bad"}).alias("p"))
    stem = F.regexp_replace("file", r"\.json$", "")
    problem = F.when(F.col("p").isNull() | F.col("p._bad").isNotNull(), "no JSON object").alias("problem")
    named = parsed.select(stem.alias("stem"), F.coalesce("p.name", stem).alias("profile"), F.coalesce("p.description", F.lit("")).alias("description"), F.col("p.weight").try_cast("double").alias("weight"), problem, "p.rules")
    profiles = named.select("stem", "profile", "description", "weight", "problem")
    entries = named.select("profile", F.posexplode("rules").alias("ord", "rule", "spec"))
    rules = entries.select("profile", "rule", rule_weight(F.col("spec")).alias("weight"), "ord")
    extra = F.from_json("spec", T.StructType([T.StructField(f"{k}_extra", T.ArrayType(T.StringType())) for k in KINDS]))
    lists = entries.select("profile", "rule", extra.alias("x"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"x.{k}_extra").alias("patterns")) for k in KINDS])
    extras = lists.select("profile", "rule", F.explode(kinds).alias("e")).where("e.patterns is not null")
    extras = extras.select("profile", "rule", "e.kind", F.posexplode("e.patterns").alias("ord", "pattern"))
    first = extras.groupBy("rule").agg(F.min("profile").alias("profile"))
    return profiles, rules, extras.join(first, ["rule", "profile"])


def read_profiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The profile files of a folder; see parse_profiles."""
    raw = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return parse_profiles(raw.select(F.col("_metadata.file_name").alias("file"), "value"))


def read_catalog(spark: SparkSession, rules: str, profiles: str, fallback_rules: str | None = None, aliases: dict[str, str] | None = None) -> Catalog:
    """A catalog from folders. Rules come from the first folder that has them.

    A rule that one folder has in several places is an error, and so are two files of one profile and a file that is no profile.
    """
    found = read_patterns(spark, rules)
    if fallback_rules:
        found = found.union(read_patterns(spark, fallback_rules, tier=1))
    heads, entries, extras = read_profiles(spark, profiles)
    order = sorted(heads.collect(), key=lambda r: r["profile"])
    if bad := [r["stem"] for r in order if r["problem"]]:
        raise ValueError(f"no JSON object in {bad}")
    if twice := sorted({a["profile"] for a, b in zip(order, order[1:], strict=False) if a["profile"] == b["profile"]}):
        raise ValueError(f"name collision: several files for the profiles {twice}")
    wanted = entries.select("rule").distinct()
    best = resolve_tiered(wanted, found.select("tier", F.col("rule").alias("name"), "dir").distinct(), aliases)
    # as many rows as the profiles name rules
    if twice := sorted(r["rule"] for r in best.where("collision").select("rule").collect()):
        raise ValueError(f"name collision: several folders for the rules {twice}")
    patterns = found.drop("rule").join(best.select("rule", "dir"), "dir").select("rule", "kind", "ord", "pattern")
    offset = patterns.groupBy("rule", "kind").agg((F.max("ord") + 1).alias("offset"))
    extra = extras.join(offset, ["rule", "kind"], "left").select("rule", "kind", (F.col("ord") + F.coalesce("offset", F.lit(0))).alias("ord"), "pattern")
    return Catalog(
        [(r["profile"], r["description"], 100.0 if r["weight"] is None else r["weight"], i) for i, r in enumerate(order)],
        sorted(tuple(r) for r in entries.select("profile", "rule", "weight", "ord").collect()),
        sorted(tuple(r) for r in patterns.union(extra).distinct().collect()),
    )


def resolve_tiered(wanted: DataFrame, candidates: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """rule -> the directory it is taken from.

    wanted: rule; candidates: tier, name, dir. A rule is looked for under its name, then without an alias
    prefix; within a name the lowest tier wins. A name with several directories in one tier is an error, told in
    `collision`.
    """
    prefixes = "|".join(map(lambda a: a.replace(".", r"\."), (aliases or {}).values())) or r"[^:]+"
    plain = F.regexp_replace("rule", rf"^(?:{prefixes}):", "")
    names = wanted.select("rule", F.posexplode(F.array_distinct(F.array("rule", plain))).alias("attempt", "name"))
    by_tier = candidates.groupBy("tier", "name").agg(F.count_distinct("dir").alias("dirs"), F.min("dir").alias("dir"))
    found = names.join(by_tier, "name")
    best = F.min_by(F.struct("dir", "dirs", "tier", "name"), F.struct("attempt", "tier")).alias("b")
    return found.groupBy("rule").agg(best).select("rule", "b.name", "b.tier", "b.dir", (F.col("b.dirs") > 1).alias("collision"))


def merged_patterns(patterns: DataFrame, profile_rules: DataFrame) -> DataFrame:
    """profile, kind, pattern: the union over a profile's rules."""
    return profile_rules.select("profile", "rule").join(patterns.select("rule", "kind", "pattern"), "rule").select("profile", "kind", "pattern").distinct()


def overall_patterns(patterns: DataFrame, profile_rules: DataFrame, profiles: DataFrame) -> DataFrame:
    """kind, pattern, first: every pattern once, by the first profile that has it."""
    merged = merged_patterns(patterns, profile_rules).join(profiles.select("profile", "ord"), "profile")
    return merged.groupBy("kind", "pattern").agg(F.min("ord").alias("first"))


def inflated(patterns: DataFrame, profile_rules: DataFrame) -> DataFrame:
    """Every profile's patterns with the weight that it gives their rule."""
    return profile_rules.select("profile", "rule", "weight").join(patterns, "rule")


def rule_counts(profiles: DataFrame, profile_rules: DataFrame) -> DataFrame:
    counted = profile_rules.groupBy("profile").agg(F.count_distinct("rule").alias("n_rules"))
    return profiles.select("profile").join(counted, "profile", "left").select("profile", F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"))


#: Hexadecimal digits of a lane of the fingerprint, and lanes: together a whole digest. Sums of 64-bit numbers stay exact for any catalog.
LANE, LANES = 16, 4


def fingerprint(patterns: DataFrame, profiles: DataFrame, profile_rules: DataFrame) -> DataFrame:
    """One row: a digest of the whole catalog, the same for the same content in any order.

    It is that of a multiset: every line's whole digest is cut into LANES numbers, which are summed up by lane, so that parts of a catalog
    are summed up where they are and no task sees all lines.
    """
    lines = (
        patterns.select(F.concat_ws("\t", F.lit("pattern"), "rule", "kind", "ord", "pattern").alias("line")),
        profiles.select(F.concat_ws("\t", F.lit("profile"), "profile", F.col("weight").cast("string")).alias("line")),
        profile_rules.select(F.concat_ws("\t", F.lit("rule"), "profile", "rule", "weight").alias("line")),
    )
    hashed = lines[0].union(lines[1]).union(lines[2]).select(F.sha2("line", 256).alias("h"))
    lane = lambda i: F.conv(F.substring("h", LANE * i + 1, LANE), 16, 10).cast("decimal(20,0)")
    sums = hashed.agg(F.count("*").alias("n"), *(F.sum(lane(i)).alias(f"s{i}") for i in range(LANES)))
    parts = [F.col("n").cast("string"), *(F.coalesce(F.col(f"s{i}").cast("string"), F.lit("0")) for i in range(LANES))]
    return sums.select(F.sha2(F.concat_ws(":", *parts), 256).alias("fingerprint"))


def pattern_problems(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """rule, kind, pattern of the expressions that Python or the JVM does not take: they never match."""
    prepare(p for *_, p in catalog.patterns)
    bad = [(r, k, p) for r, k, _, p in catalog.patterns if p.startswith("re:") and java_regex(p[3:]) is None]
    return spark.createDataFrame(bad, "rule string, kind string, pattern string")


def catalog_problems(catalog: Catalog) -> list[tuple[str, str, str]]:
    """(check, name, detail) of what is wrong: weights out of range, nothing active, rules without patterns, invalid expressions."""
    prepare(p for *_, p in catalog.patterns)
    out = [("weight_range", p, f"{w}") for p, _, w, _ in catalog.profiles if w is not None and not 0 <= w <= 100]
    if not catalog.profiles:
        out.append(("no_profile", "", ""))
    out += [("no_rules", p, "") for p in catalog.names() if not catalog.rules_of(p)]
    have = {r for r, *_ in catalog.patterns}
    out += [("empty_rule", r, "") for r in catalog.rules() if r not in have]
    out += [("invalid_regex", r, p) for r, _, _, p in catalog.patterns if p.startswith("re:") and java_regex(p[3:]) is None]
    return out


def profile_name_problems(profiles: DataFrame) -> DataFrame:
    """Profiles whose name is not their file's."""
    return profiles.where("profile <> stem").select("stem", "profile")
