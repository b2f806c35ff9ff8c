"""Patterns of large catalogs, found by what a text must hold for them to match.

Texts and patterns meet at keys (see winnow.functions.literals): a text is cut into distinct tokens and joints of two tokens, and a pattern is
tested only against texts that hold one of its keys. Keys that are parts of tokens are looked up among the distinct tokens of all
texts, by trigrams, so that texts themselves are joined by equality of tokens alone. The number of tests grows with the texts that
nearly match, and not with the catalog.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.literals import BY_EXPRESSION, GRAM, SHORT, decided, index_keys, joints, joints_of, lowered, shortcut, tokens, words_of  # noqa: F401  (tokens, joints: as literals has them)
from winnow.functions.patterns import prepare, search_regex
from winnow.operators.score import PATTERNS_TOGETHER, TEXTS
from winnow.sources.catalog import CAP, Catalog
from winnow.sources.stages import cut

#: Pairs of a token and a pattern that are sent to the tokens of all texts, and of a text and a pattern that are sent to the texts; more are joined.
FEW_LINKS = 200_000
#: Distinct tokens that may hold a part before it is too common to look for.
MOST_TOKENS = 500
_KEYS = "array<struct<whole:boolean,key:string>>"
#: Literals that two parts of a text decide, where it is cut at its spaces.
_TWO_WORDS = r"\A[A-Za-z0-9_]+ [A-Za-z0-9_]+\z"
#: Patterns of such literals for which texts are cut into parts in a pass of its own, where other patterns need one anyhow.
WORTH_PARTS = 100


def _grams(text: Column) -> Column:
    """The distinct trigrams of a column of tokens with three characters at least."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM))))


def _digest(text: Column) -> Column:
    full = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(full), F.xxhash64(F.lit(1), full))


def token_rows(texts: DataFrame, column: str, *sides: int) -> DataFrame:
    """_d, token: a digest of each text with each of its tokens, and joints of these sides (GRAM, SHORT), which have a space where tokens have none; repeated as they are in the text.

    Rows are narrow: where a text stands beside an array that is exploded, a task may hold a copy of it for every element.
    """
    words = texts.select(_digest(F.col(column)).alias("_d"), words_of(F.col(column)).alias("_w"))
    # outer: an explode that skips empty arrays would compute each of them twice
    return words.select("_d", F.explode_outer(F.concat("_w", *(joints_of(F.col("_w"), side) for side in sides))).alias("token")).where("token is not null")


def key_tokens(vocabulary: DataFrame, keyed: DataFrame) -> DataFrame:
    """whole, key, token: the tokens of vocabulary(token) that hold each distinct key of keyed(id, keys) which is a part; a whole key is its own token, whether a text has it or not."""
    each = keyed.select(F.explode("keys").alias("k")).select("k.whole", "k.key").distinct()
    exact = each.where("whole").select("whole", "key", F.col("key").alias("token"))
    # a part is looked up by the trigram that fewest tokens have
    wide = vocabulary.where(F.length("token") >= GRAM).select("token", F.explode(_grams(F.col("token"))).alias("gram"))
    parts = each.where("not whole").select("key", F.explode(_grams(F.col("key"))).alias("gram"))
    rare = parts.join(wide.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left").groupBy("key").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("gram"))
    within = rare.join(wide, "gram").where(F.col("token").contains(F.col("key"))).select(F.lit(False).alias("whole"), "key", "token")
    return exact.union(within)


def links(by_key: DataFrame, keyed: DataFrame) -> DataFrame:
    """token, id: the tokens that hold a key of keyed(id, keys), by what key_tokens found."""
    each = keyed.select("id", F.explode("keys").alias("k")).select("id", "k.whole", "k.key")
    return each.join(by_key, ["whole", "key"]).select("token", "id").distinct()


def survivors(texts: DataFrame, column: str, keyed: DataFrame, by_key: DataFrame | None = None) -> DataFrame:
    """The texts with _p, a pattern of keyed(id, keys, ...) as a struct, for each pattern of which they hold a key, and _f, their lowered form; each pair once. by_key: see key_tokens.

    Only digests and tokens are exploded and joined; a text meets the list of its patterns once.
    """
    by_key = key_tokens(vocabulary(texts, column, keyed), keyed) if by_key is None else by_key
    found = cut(links(by_key, keyed), "links")
    short = F.col("token").contains("  ")
    n, full, shorter = found.agg(F.count("*"), F.bool_or(F.col("token").contains(" ") & ~short), F.bool_or(short)).first()
    each = token_rows(texts, column, *[GRAM] * bool(full), *[SHORT] * bool(shorter))
    if n > FEW_LINKS:
        found = cut(found.join(each.select("token").distinct(), "token", "left_semi"), "links")
        n = found.count()
    pairs = each.join(F.broadcast(found) if n <= FEW_LINKS else found, "token").select("_d", "id").distinct()
    met = _with_lists(texts, column, pairs).withColumn("_f", lowered(F.col(column)))
    # a catalog, which the driver has as a list
    whole = F.broadcast(keyed.select("id", F.struct(*keyed.columns).alias("_p")))
    return met.withColumn("id", F.explode("_ids")).drop("_ids").join(whole, "id").drop("id")


def _with_lists(texts: DataFrame, column: str, pairs: DataFrame) -> DataFrame:
    """The texts of pairs(_d, id) with _ids, all ids of a text as one list: a text meets it once."""
    lists = cut(pairs.groupBy("_d").agg(F.collect_list("id").alias("_ids")), "pairs")
    few = lists.agg(F.coalesce(F.sum(F.size("_ids")), F.lit(0))).first()[0] <= FEW_LINKS
    return texts.withColumn("_d", _digest(F.col(column))).join(F.broadcast(lists) if few else lists, "_d").drop("_d")


def met_by_parts(texts: DataFrame, column: str, near: DataFrame) -> DataFrame:
    """_d, id: the digest of each text with each pattern of near(id, e, how, lit) that it matches, whose literals are two words with a space between them.

    A text holds such a literal where one of its parts, cut at its spaces, ends with the first word and the next part starts with the second; what stands around is told by these two parts, as a space is
    no letter. So a pattern is tested on two parts that have the ends it asks for, and never on a whole text.
    """
    first, second = F.substring_index("lit", " ", 1), F.substring_index("lit", " ", -1)
    side = lambda word: F.least(F.length(word), F.lit(GRAM))
    joint = lambda a, n, b, m: F.concat(F.right(a, F.lit(n)), F.lit(" "), F.left(b, F.lit(m)))
    # as many as nine
    sides = [tuple(r) for r in near.select(side(first).alias("n"), side(second).alias("m")).distinct().collect()]
    # a catalog, which the driver has as a list
    whole = F.broadcast(near.select(F.lower(joint(first, GRAM, second, GRAM)).alias("key"), "id", F.struct("e", "how", "lit").alias("_p")))
    parts = texts.select(_digest(F.col(column)).alias("_d"), F.split(F.coalesce(F.col(column), F.lit("")), " ").alias("_w"))
    # the last part has none that follows
    pairs = F.array_compact(F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)))
    each = parts.select("_d", F.explode_outer(pairs).alias("pair")).where("pair is not null").select("_d", "pair", lowered(F.col("pair")).alias("_f"))
    left, right = F.substring_index("_f", " ", 1), F.substring_index("_f", " ", -1)
    asked = each.withColumn("key", F.explode(F.array(*(joint(left, n, right, m) for n, m in sides))))
    return asked.join(whole, "key").where(decided(F.col("pair"), F.col("_f"), F.col("_p"))).select("_d", "id").distinct()


def vocabulary(texts: DataFrame, column: str, keyed: DataFrame) -> DataFrame:
    """token: a written table of the distinct tokens of all texts, if any pattern of keyed(id, keys) asks for a part of one."""
    if keyed.where(F.exists("keys", lambda k: ~k["whole"])).isEmpty():
        return texts.sparkSession.createDataFrame([], "token string")
    return cut(token_rows(texts, column).select("token").distinct(), "vocabulary")


def keyed_patterns(texts: DataFrame, patterns: Iterable[tuple[str, str, str]]) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """A written table of the patterns that have keys: id, keys, rule, kind, pattern, e (its expression), how and lit (its shortcut); and those that have none.

    patterns: (rule, kind, pattern). Patterns that neither Python nor the JVM takes are left out: they never match.
    """
    patterns = list(patterns)
    prepare(p for _, _, p in patterns)
    rows, others = [], []
    for i, (rule, kind, pattern) in enumerate(patterns):
        if (e := search_regex(pattern)) is None:
            continue
        if keys := index_keys(pattern):
            rows.append((i, keys, rule, kind, pattern, e, *shortcut(pattern)))
        else:
            others.append((rule, kind, pattern))
    spark = texts.sparkSession
    table = spark.createDataFrame(rows, f"id int, keys {_KEYS}, rule string, kind string, pattern string, e string, how string, lit string")
    return cut(table, "patterns"), others


def pattern_index(texts: DataFrame, patterns: Iterable[tuple[str, str, str]], column: str) -> DataFrame:
    """The texts with each pattern that they match: rule, kind, pattern; as score.pattern_join has them, for catalogs of any size.

    patterns: (rule, kind, pattern). A pattern whose expression tells nothing of what a text must hold, or that asks for a part of more than MOST_TOKENS distinct tokens, is tested against every text. Names of columns
    that begin with an underscore, and `token` and `id`, are used here.
    """
    if taken := {"_w", "_p", "_d", "_f", "_l", "_h", "_ids", "token", "id", "rule", "kind", "pattern"} & set(texts.columns):
        raise ValueError(f"rename the columns {sorted(taken)}")
    keyed, others = keyed_patterns(texts, patterns)
    two = (F.col("how") != BY_EXPRESSION) & F.col("lit").rlike(_TWO_WORDS)
    near, rest, out = keyed.where(two), keyed.where(~two), []
    n, m = near.count(), rest.count()
    if n and (n >= WORTH_PARTS or not m):
        keyed = rest
        met = _with_lists(texts, column, met_by_parts(texts, column, near)).withColumn("id", F.explode("_ids"))
        out.append(met.join(F.broadcast(near.select("id", "rule", "kind", "pattern")), "id"))
    if not keyed.isEmpty():
        by_key = cut(key_tokens(vocabulary(texts, column, keyed), keyed), "keys")
        common = by_key.where("not whole").groupBy("whole", "key").agg(F.count("*").alias("n")).where(F.col("n") > MOST_TOKENS).select("whole", "key")
        each = keyed.select("id", "rule", "kind", "pattern", F.explode("keys").alias("k")).select("id", "rule", "kind", "pattern", "k.whole", "k.key")
        # a part of the catalog, which is a list of the driver's
        wide = {r["id"]: (r["rule"], r["kind"], r["pattern"]) for r in each.join(common, ["whole", "key"]).select("id", "rule", "kind", "pattern").distinct().collect()}
        others = others + list(wide.values())
        if wide:
            known = texts.sparkSession.createDataFrame([(i,) for i in wide], "id int")
            keyed = keyed.join(known, "id", "left_anti")
        tested = survivors(texts, column, keyed, by_key).where(decided(F.col(column), F.col("_f"), F.col("_p")))
        out.append(tested.select(*texts.columns, "_p.rule", "_p.kind", "_p.pattern"))
    if others or not out:
        out.append(every(texts.withColumn("_f", lowered(F.col(column))), others, column))
    return reduce(DataFrame.union, [df.select(*texts.columns, "rule", "kind", "pattern") for df in out])


def every(texts: DataFrame, patterns: list[tuple[str, str, str]], column: str) -> DataFrame:
    """The texts with each pattern that they match: rule, kind, pattern. texts have _f, their lowered form; each is tested against every list of PATTERNS_TOGETHER patterns."""
    rows = [(r, k, p, e, *shortcut(p)) for r, k, p in patterns if (e := search_regex(p)) is not None]
    out = texts.withColumns({c: F.lit("") for c in ("rule", "kind", "pattern")}).where("false")
    for at in range(0, len(rows), PATTERNS_TOGETHER):
        listed = texts.sparkSession.createDataFrame([(rows[at : at + PATTERNS_TOGETHER],)], "_l array<struct<rule:string,kind:string,pattern:string,e:string,how:string,lit:string>>")
        # one row
        met = texts.crossJoin(F.broadcast(listed)).withColumn("_h", F.explode(F.filter("_l", lambda x: decided(F.col(column), F.col("_f"), x))))
        out = out.union(met.select(*texts.columns, "_h.rule", "_h.kind", "_h.pattern"))
    return out


#: What the three lists of a rule are matched against: the texts, each file, the id.
_VALUES = {
    "keywords": lambda: F.array(*(F.coalesce(t, F.lit("")) for t in TEXTS)),
    "path": lambda: F.coalesce("files", F.array().cast("array<string>")),
    "commit": lambda: F.array("record_id"),
}


def _found(records: DataFrame, catalog: Catalog, *sides: str) -> DataFrame:
    """record_id, rule, kind, pattern, value, pord, vord: every pattern with every distinct value of a record that it matches; pord: a pattern's place in its rule and kind, vord: a value's in its record."""
    places: dict[tuple[str, str, str], int] = {}
    used = set(catalog.rules())
    for rule, kind, _, pattern in sorted(catalog.patterns, key=lambda p: p[2]):
        if kind.endswith(sides) and rule in used:
            places.setdefault((rule, kind, pattern), len(places))
    out = None
    for name, values in _VALUES.items():
        wanted = [k for k in places if k[1].startswith(f"{name}_")]
        if not wanted:
            continue
        # outer: an explode that skips empty arrays would compute each of them twice
        each = records.select("record_id", F.posexplode_outer(F.array_distinct(values())).alias("vord", "value")).where("value is not null")
        found = pattern_index(each, wanted, "value")
        out = found if out is None else out.unionByName(found)
    spark = records.sparkSession
    if out is None:
        return spark.createDataFrame([], "record_id string, rule string, kind string, pattern string, value string, pord int, vord int")
    ords = spark.createDataFrame([(*k, n) for k, n in places.items()], "rule string, kind string, pattern string, pord int")
    return out.join(ords, ["rule", "kind", "pattern"]).select("record_id", "rule", "kind", "pattern", "value", "pord", "vord")


def catalog_hits(records: DataFrame, catalog: Catalog, side: str = "whitelist") -> DataFrame:
    """record_id, rule, kind, pattern, value, ord: as score.pattern_hits has them, for catalogs of any size. Rows that repeat a record_id are one record with the values of all."""
    hits = _found(records, catalog, side).groupBy("record_id", "rule", "kind", "pattern", "value").agg(F.min("pord").alias("pord"), F.min("vord").alias("vord"))
    order = Window.partitionBy("record_id", "rule", "kind").orderBy("pord", "vord", "value")
    return hits.select("record_id", "rule", "kind", "pattern", "value", F.row_number().over(order).alias("ord"))


def catalog_scores(records: DataFrame, catalog: Catalog) -> DataFrame:
    """record_id, profile, blocked, raw_total, capped, multiplier, final_score: as score.profile_scores has them, for catalogs of any size.

    Only profiles that a record matches or that are blocked for it have a row; all others score 0. The plan does not grow with the catalog: rules and weights are
    tables. A record_id stands for one record.
    """
    spark = records.sparkSession
    weights = [(p, r, w) for p in catalog.names() for r, w in catalog.rules_of(p)]
    rules = spark.createDataFrame(weights, "profile string, rule string, weight int")
    profiles = spark.createDataFrame([(p, catalog.multiplier(p)) for p in catalog.names()], "profile string, multiplier double")
    denies = F.col("kind").endswith("blacklist")
    found = _found(records, catalog, "whitelist", "blacklist").select("record_id", "rule", denies.alias("denied")).distinct().join(rules, "rule")
    weighed = found.select("record_id", "profile", F.when(F.col("denied"), 0).otherwise(F.col("weight")).alias("weight"), "denied")
    by = weighed.groupBy("record_id", "profile").agg(F.sum("weight").cast("int").alias("raw_total"), F.bool_or("denied").alias("blocked")).join(profiles, "profile")
    capped = F.least("raw_total", F.lit(CAP))
    final = F.when(F.col("blocked"), F.lit(0)).otherwise((capped * F.col("multiplier")).cast("int"))
    return by.select("record_id", "profile", "blocked", "raw_total", capped.alias("capped"), "multiplier", final.alias("final_score"))
