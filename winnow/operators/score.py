"""Scoring: profiles of weighted rules, with a trace of every pattern that matched.

Scores are computed row by row, without a shuffle: the catalog becomes literal Columns, each
rule's hit is computed once and fanned out to the profiles that weigh it. Long tables for
the trace are exploded from the same Columns.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.patterns import any_file_match, any_match, matches, prepare, search_regex, with_lowered
from winnow.functions.scalars import flags, true_flags
from winnow.sources.catalog import CAP, Catalog

TEXTS = ("subject", "body")
#: Patterns of a large catalog that a task holds together.
PATTERNS_TOGETHER = 5000


def _any_text(patterns: list[str]) -> Column:
    """Whether any keyword matches, in records with_lowered() texts."""
    return reduce(or_, [any_match(patterns, F.col(t), [F.col(f"_low_{t}")]) for t in TEXTS]) if patterns else F.lit(False)


def _hit(patterns: dict[str, list[str]]) -> Column:
    """Whether any keyword (in subject or body), path or id matches."""
    return _any_text(patterns["keywords"]) | any_file_match(patterns["path"], F.col("files")) | any_match(patterns["commit"], F.col("record_id"))


def _lists(of, side: str) -> dict[str, list[str]]:
    return {k: of(f"{k}_{side}") for k in ("keywords", "path", "commit")}


def with_hits(records: DataFrame, catalog: Catalog) -> DataFrame:
    """The records with a boolean per rule (hit_<i>) and per profile (blocked_<j>), as arrays hits and blocks."""
    prepare(p for *_, p in catalog.patterns)
    rules, names = catalog.rules(), catalog.names()
    hits = [_hit(_lists(lambda k, r=r: catalog.of_rule(r, k), "whitelist")) for r in rules]
    blocks = [_hit(_lists(lambda k, p=p: catalog.merged(p, k), "blacklist")) for p in names]
    # no test is null; compacted arrays are values of their own, while elements of plain ones would be tested again wherever they are used
    out = with_lowered(records, TEXTS).withColumns({"hits": F.array_compact(F.array(*hits).cast("array<boolean>")), "blocks": F.array_compact(F.array(*blocks).cast("array<boolean>"))})
    return out.drop(*(f"_low_{t}" for t in TEXTS))


def scored(records: DataFrame, catalog: Catalog) -> DataFrame:
    """The records with score, profile_scores (an array in profile order) and matched_profiles.

    A profile's score is the sum of its hit rules' weights, capped, times its multiplier, cut to a whole number; 0 if
    blocked. It is matched if that is positive or any of its patterns matches, deny lists included.
    """
    rules, names = catalog.rules(), catalog.names()
    out = with_hits(records, catalog)
    per = []
    for j, p in enumerate(names):
        weighed = [(rules.index(r), w) for r, w in catalog.rules_of(p)]
        raw = reduce(add, [F.when(F.col("hits")[i], F.lit(w)).otherwise(F.lit(0)) for i, w in weighed], F.lit(0))
        any_hit = reduce(or_, [F.col("hits")[i] for i, _ in weighed], F.lit(False))
        blocked = F.col("blocks")[j]
        capped = F.least(raw, F.lit(CAP))
        final = F.when(blocked, F.lit(0)).otherwise((capped * F.lit(catalog.multiplier(p))).cast("int"))
        per.append(
            F.struct(
                F.lit(p).alias("profile"),
                blocked.alias("blocked"),
                raw.cast("int").alias("raw_total"),
                capped.cast("int").alias("capped"),
                F.lit(catalog.multiplier(p)).alias("multiplier"),
                final.alias("final_score"),
                (blocked | any_hit).alias("any_match"),
            )
        )
    out = out.withColumn("profile_scores", F.array(*per))
    # by place: generated code, where functions over an array are interpreted for each record
    each, none = [F.col("profile_scores")[j] for j in range(len(names))], F.array().cast("array<string>")
    total = reduce(add, [x["final_score"] for x in each], F.lit(0))
    matched = F.concat(none, *[F.when((x["final_score"] > 0) | x["any_match"], F.array(F.lit(p))).otherwise(none) for x, p in zip(each, names, strict=True)])
    return out.withColumns({"score": total, "matched_profiles": matched})


def _each(rows: DataFrame, values: Column, name: str) -> DataFrame:
    """record_id and each of the values. The plain explode would first filter rows by whether they have any, and compute all of them once more for it."""
    return rows.select("record_id", F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def profile_scores(scored_records: DataFrame) -> DataFrame:
    """record_id, profile, blocked, raw_total, capped, multiplier, final_score."""
    rows = _each(scored_records, F.col("profile_scores"), "p")
    return rows.select("record_id", "p.profile", "p.blocked", "p.raw_total", "p.capped", "p.multiplier", "p.final_score")


def rule_hits(scored_records: DataFrame, catalog: Catalog) -> DataFrame:
    """record_id, profile, rule, weight, matched, matched_level (matched, no-match or blocked), score."""
    rules = catalog.rules()
    rows = []
    for j, p in enumerate(catalog.names()):
        for r, w in catalog.rules_of(p):
            hit = F.col("hits")[rules.index(r)]
            level = F.when(F.col("blocks")[j], "blocked").when(hit, "matched").otherwise("no-match")
            rows.append(F.struct(F.lit(p).alias("profile"), F.lit(r).alias("rule"), F.lit(w).alias("weight"), hit.alias("matched"), level.alias("matched_level"), F.when(hit, F.lit(w)).otherwise(F.lit(0)).alias("score")))
    if not rows:
        return scored_records.select("record_id").where("false").selectExpr("record_id", "'' profile", "'' rule", "0 weight", "false matched", "'' matched_level", "0 score")
    return _each(scored_records, F.array(*rows), "h").select("record_id", "h.*")


_HIT = "struct<rule:string,kind:string,pattern:string,value:string,ord:int>"


def _pairs(pattern: str, values: Column) -> Column:
    """The values that match, each with the pattern."""
    return F.transform(F.filter(values, lambda v: matches(pattern, v)), lambda v: F.struct(F.lit(pattern).alias("pattern"), v.alias("value")))


def _numbered(rule: str, kind: str, pairs: Column) -> Column:
    return F.transform(pairs, lambda h, at: F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), h["pattern"].alias("pattern"), h["value"].alias("value"), (at + 1).cast("int").alias("ord")))


def _found(catalog: Catalog, rule: str, side: str) -> Column:
    """A rule's hits in a record, as an array of _HIT: by kind, pattern and value."""
    values = {
        "keywords": F.array_distinct(F.array(*[F.coalesce(t, F.lit("")) for t in TEXTS])),
        "path": F.array_distinct(F.coalesce("files", F.array().cast("array<string>"))),
        "commit": F.array("record_id"),
    }
    parts = [F.array().cast(f"array<{_HIT}>")]
    for kind, of in values.items():
        patterns = list(dict.fromkeys(catalog.of_rule(rule, f"{kind}_{side}")))
        if patterns:
            parts.append(_numbered(rule, f"{kind}_{side}", F.concat(*[_pairs(p, of) for p in patterns])))
    return F.concat(*parts)


def pattern_hits(records: DataFrame, catalog: Catalog, side: str = "whitelist") -> DataFrame:
    """record_id, rule, kind, pattern, value, ord: every pattern with every value it matches, distinct.

    Values are the subject, the body, each file, the id. ord counts a record's hits within a rule and kind, by
    pattern and then by value as they stand in the record. One pass, whatever the catalog's size.
    """
    prepare(p for *_, p in catalog.patterns)
    none = F.array().cast(f"array<{_HIT}>")
    each = [F.when(_hit(_lists(lambda k, r=r: catalog.of_rule(r, k), side)), _found(catalog, r, side)).otherwise(none) for r in catalog.rules()]
    return _each(with_lowered(records, TEXTS), F.concat(none, *each), "h").select("record_id", "h.*")


def pattern_join(texts: DataFrame, patterns: list[tuple[str, str, str]], column: str) -> DataFrame:
    """The texts with each pattern that they match: rule, kind, pattern. patterns: (rule, kind, pattern).

    For catalogs that are too large for one literal Column per pattern: patterns go to the texts in lists of
    PATTERNS_TOGETHER, which bounds what a task holds of them; each text is tested against every list.
    """
    prepare(p for _, _, p in patterns)
    rows = [(r, k, p, e) for r, k, p in patterns if (e := search_regex(p)) is not None]
    text = F.coalesce(F.col(column), F.lit(""))
    out = texts.withColumns({c: F.lit("") for c in ("rule", "kind", "pattern")}).where("false")
    for at in range(0, len(rows), PATTERNS_TOGETHER):
        some = [dict(zip(("rule", "kind", "pattern", "e"), r, strict=True)) for r in rows[at : at + PATTERNS_TOGETHER]]
        listed = texts.sparkSession.createDataFrame([(some,)], "_l array<struct<rule:string,kind:string,pattern:string,e:string>>")
        # one row
        paired = texts.crossJoin(F.broadcast(listed)).withColumn("_h", F.explode(F.filter("_l", lambda x: F.regexp_like(text, x["e"]))))
        out = out.union(paired.select(*texts.columns, "_h.rule", "_h.kind", "_h.pattern"))
    return out


def first_hit(hits: DataFrame) -> DataFrame:
    """record_id, rule, kind, pattern, value of the first hit of each rule and kind."""
    first = F.min_by(F.struct("pattern", "value"), "ord").alias("h")
    return hits.groupBy("record_id", "rule", "kind").agg(first).select("record_id", "rule", "kind", "h.pattern", "h.value")


def rule_trace(scored_records: DataFrame, catalog: Catalog) -> DataFrame:
    """record_id, profile, rule, matched_level, rule_score, profile_score, kind, pattern, value: a row per match, one for a rule without any, one for a profile without rules.

    A record's whole trace is one array, and so one pass and no join. Single patterns are tested where their rule hits: elsewhere none matches.
    """
    rules, kinds, none = catalog.rules(), ("kind", "pattern", "value"), F.array().cast(f"array<{_HIT}>")
    traced = scored_records.withColumn("_found", F.array_compact(F.array(*[F.when(F.col("hits")[i], _found(catalog, r, "whitelist")).otherwise(none) for i, r in enumerate(rules)]).cast(f"array<array<{_HIT}>>")))

    def row(profile: str, j: int, rule: str | None, level: Column, gained: Column, hit: Column | None) -> Column:
        cells = [F.lit(None).cast("string") if hit is None else hit[c] for c in kinds]
        return F.struct(
            F.lit(profile).alias("profile"),
            F.lit(rule).cast("string").alias("rule"),
            level.alias("matched_level"),
            gained.cast("int").alias("rule_score"),
            F.col("profile_scores")[j]["final_score"].alias("profile_score"),
            *[c.alias(k) for c, k in zip(cells, kinds, strict=True)],
        )

    def rows(profile: str, j: int, rule: str, weight: int) -> Column:
        i = rules.index(rule)
        hit, found = F.col("hits")[i], F.col("_found")[i]
        level = F.when(F.col("blocks")[j], "blocked").when(hit, "matched").otherwise("no-match")
        gained = F.when(hit, F.lit(weight)).otherwise(F.lit(0))
        return F.when(F.size(found) == 0, F.array(row(profile, j, rule, level, gained, None))).otherwise(F.transform(found, lambda h: row(profile, j, rule, level, gained, h)))

    parts = []
    for j, p in enumerate(catalog.names()):
        of = catalog.rules_of(p)
        parts += [rows(p, j, r, w) for r, w in of] or [F.array(row(p, j, None, F.lit(""), F.lit(0), None))]
    if not parts:
        return scored_records.select("record_id").where("false").selectExpr("record_id", "'' profile", "'' rule", "'' matched_level", "0 rule_score", "0 profile_score", *[f"'' {c}" for c in kinds])
    return _each(traced, F.concat(*parts), "t").select("record_id", "t.*")


def trace_summary(scored_records: DataFrame, catalog: Catalog) -> DataFrame:
    """record_id, summary: `profile:matched/rules=score` parts, by profile, of the profiles that have rules."""
    rules, parts = catalog.rules(), []
    for j, p in enumerate(catalog.names()):
        if of := [rules.index(r) for r, _ in catalog.rules_of(p)]:
            matched = reduce(add, [F.when(F.col("hits")[i], 1).otherwise(0) for i in of])
            parts.append(F.concat(F.lit(f"{p}:"), matched.cast("string"), F.lit(f"/{len(of)}="), F.col("profile_scores")[j]["final_score"].cast("string")))
    return scored_records.select("record_id", F.array_join(F.array_sort(F.array(*parts).cast("array<string>")), "; ").alias("summary"))


def annotated(records: DataFrame, expressions: dict[str, str] | None = None, flatten_body: bool = False) -> DataFrame:
    """The records with a boolean per flag of `subject\\nbody` and meta_flags, the names of those that hold.

    flatten_body: as a log's body is, its lines joined with spaces, so that a line's start is only the body's.
    """
    body = F.coalesce("body", F.lit(""))
    text = F.concat(F.coalesce("subject", F.lit("")), F.lit("\n"), F.regexp_replace(body, "\n", " ") if flatten_body else body)
    found = flags(text, expressions) if expressions else flags(text)
    return records.withColumns(found).withColumn("meta_flags", true_flags({k: F.col(k) for k in found}))
