"""Links between records and the product they are built into.

No join is a nested loop. A path lies under a directory when the directory is one of its ancestors, so every file's ancestors are
exploded (as many as it is deep) and joined by equality. What a string is the start of is found in sorted order (see
winnow.operators.ordered), and what it occurs within is a start of a suffix. Words within texts are looked up among
the texts' distinct tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.literals import TOKEN, tokens
from winnow.functions.scalars import ancestors, basename, dirname, is_build_file, stem
from winnow.operators.literal_index import key_tokens, links
from winnow.operators.ordered import at_or_after, prefixes, suffixes
from winnow.sources.product import bare
from winnow.sources.stages import cut


def with_touched(records: DataFrame, hints: DataFrame) -> DataFrame:
    """The records with touched: the prefixes of all hint keywords that the lower-cased subject holds, distinct and sorted.

    hints(keyword, prefix) is a list that people write; it is matched against the distinct subjects. Those that hold any are written, counted, and sent to the records up to FEW_SYMBOLS.
    """
    low = F.lower(F.coalesce("subject", F.lit("")))
    hit = records.select(low.alias("_low")).distinct().join(hints, F.col("_low").contains(F.lower("keyword"))).groupBy("_low").agg(F.array_sort(F.collect_set("prefix")).alias("touched"))
    hit = cut(hit, "subjects")
    keyed = records.withColumn("_low", low).join(F.broadcast(hit) if hit.count() <= FEW_SYMBOLS else hit, "_low", "left")
    return keyed.select(*records.columns, F.coalesce("touched", F.array().cast("array<string>")).alias("touched"))


def infer_paths(records: DataFrame, hints: DataFrame) -> DataFrame:
    """record_id, touched: see with_touched."""
    return with_touched(records.select("record_id", "subject"), hints).select("record_id", "touched")


def _files(records: DataFrame) -> DataFrame:
    return records.select("record_id", F.explode("files").alias("file"))


def _ask(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("at"))


def _at_root(path: Column) -> Column:
    """Whether a path has no directory."""
    return F.length(path) <= F.length(basename(path)) + 1


def _of_files() -> Column:
    """What a record's files ask the map for: each of their directories, and files at the root as themselves."""
    files = F.coalesce("files", F.array().cast("array<string>"))
    dirs = F.array_distinct(F.flatten(F.transform(files, ancestors)))
    return F.concat(F.transform(dirs, lambda d: _ask("under", d)), F.transform(F.filter(files, _at_root), lambda f: _ask("same", f)))


def _mapped(config_paths: DataFrame) -> DataFrame:
    """kind, at, tag: what _of_files asks for. A file that equals a mapped path lies beside it as well, so that paths answer by their directory; those at the root by themselves."""
    path = F.col("path")
    answer = F.when(dirname(path) != "", _ask("under", dirname(path))).otherwise(_ask("same", path))
    return config_paths.select(answer.alias("x"), F.concat(F.lit("config_map:"), "symbol").alias("tag")).select("x.kind", "x.at", "tag").where("at <> ''").distinct()


def _answered(records: DataFrame, asks: Column, answers: DataFrame) -> DataFrame:
    """record_id, kind, tags: what of answers(kind, at, tag) a record's asks meet. Answers are few beside the records: they are written, counted, and sent to them up to FEW_SYMBOLS tags."""
    known = cut(answers.groupBy("kind", "at").agg(F.collect_set("tag").alias("tags")), "answers")
    few = known.agg(F.coalesce(F.sum(F.size("tags") + 1), F.lit(0))).first()[0] <= FEW_SYMBOLS
    asked = records.select("record_id", F.explode(asks).alias("x")).select("record_id", "x.kind", "x.at")
    return asked.join(F.broadcast(known) if few else known, ["kind", "at"]).select("record_id", "kind", "tags")


def _all_tags() -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags"))))


def config_map(records: DataFrame, config_paths: DataFrame) -> DataFrame:
    """record_id, tag: one `config_map:SYMBOL` per symbol with a mapped path that a file equals or lies beside or below.

    Symbols count whether enabled or not.
    """
    found = _answered(records, _of_files(), _mapped(config_paths))
    # a row of a record is moved, and not one of each tag
    return found.groupBy("record_id").agg(_all_tags().alias("tags")).select("record_id", F.explode("tags").alias("tag"))


def _guesses(touched: DataFrame) -> DataFrame:
    return touched.select("record_id", F.explode("touched").alias("guess"))


def config_dir(touched: DataFrame, config_dirs: DataFrame) -> DataFrame:
    """record_id, tag: for each guessed prefix the first directory, in order, that it starts with or that starts with it."""
    guesses = _guesses(touched)
    distinct = guesses.select("guess").distinct()
    # the directories that a guess starts with are among its own prefixes
    bare_dirs = config_dirs.select(F.regexp_replace("dir", "/$", "").alias("start"), "dir")
    above = distinct.select("guess", F.explode(prefixes(F.col("guess"))).alias("start")).join(bare_dirs, "start").groupBy("guess").agg(F.min("dir").alias("dir"))
    # of those that start with it the first in order is the first that does not stand before it
    below = at_or_after(distinct.select("guess"), config_dirs.select("dir")).toDF("guess", "dir").where(F.col("dir").startswith(F.col("guess")))
    first = above.union(below).groupBy("guess").agg(F.min("dir").alias("dir"))
    return guesses.join(first, "guess").select("record_id", F.concat(F.lit("config_dir:"), "dir").alias("tag")).distinct()


def _base_in(touched: DataFrame, names: DataFrame, tag: str) -> DataFrame:
    """A base occurs within a name if it is the start of one of the name's suffixes."""
    guesses = _guesses(touched).select("record_id", basename(F.regexp_replace("guess", "/+$", "")).alias("base")).where("base <> ''")
    asked = guesses.select("base").distinct()
    # suffixes need not be longer than the longest base: one row
    most = asked.agg(F.max(F.length("base")).alias("most"))
    cut_short = names.select(F.col(names.columns[0]).alias("name")).distinct().crossJoin(F.broadcast(most)).select(F.explode(F.transform(suffixes(F.col("name")), lambda x: F.left(x, F.col("most")))).alias("suffix")).distinct()
    found = at_or_after(asked, cut_short).toDF("base", "suffix").where(F.col("suffix").startswith(F.col("base"))).select("base")
    return guesses.join(found, "base").select("record_id", F.concat(F.lit(f"{tag}:"), "base").alias("tag")).distinct()


def build_log(touched: DataFrame, log_objects: DataFrame) -> DataFrame:
    """record_id, tag: guessed prefixes whose last name occurs within an object of the log."""
    return _base_in(touched, log_objects.select("name"), "build_log")


def artifact(touched: DataFrame, artifacts: DataFrame) -> DataFrame:
    """record_id, tag: guessed prefixes whose last name occurs within an artifact's path."""
    return _base_in(touched, artifacts.select("path"), "artifact")


#: Pairs of a token and a symbol up to which they are sent to every task.
FEW_SYMBOLS = 200_000


def _low_text() -> Column:
    return F.lower(F.concat_ws("\n", F.coalesce("subject", F.lit("")), F.coalesce("body", F.lit(""))))


def _symbol_links(records: DataFrame, symbols: DataFrame, literal_suffix: bool = False) -> tuple[DataFrame, DataFrame]:
    """A written table of the tokens of all texts that hold a name (token, symbol, needle, sure), or its longest token where it is not sure; and one of the names that have none (symbol, needle). See config_text."""
    name = F.col("symbol") if literal_suffix else bare(F.col("symbol"))
    needles = symbols.select(name.alias("symbol")).distinct().withColumn("needle", F.lower(F.regexp_replace("symbol", "^CONFIG_", ""))).where("needle <> ''")
    part = F.try_element_at(F.array_sort(F.transform(F.regexp_extract_all("needle", F.lit(TOKEN), F.lit(0)), lambda t: F.struct(F.length(t).alias("n"), t.alias("t")))), F.lit(-1))["t"]
    known = needles.withColumn("part", part)
    key = F.array(F.struct(F.lit(False).alias("whole"), F.col("part").alias("key")))
    keyed = known.where(F.length("part") >= 3).select(F.col("symbol").alias("id"), key.alias("keys"), "needle", "part")
    vocabulary = cut(records.select(F.explode(tokens(_low_text())).alias("token")).distinct(), "vocabulary")
    found = links(key_tokens(vocabulary, keyed), keyed).join(keyed.select("id", "needle", "part"), "id").select("token", F.col("id").alias("symbol"), "needle", (F.col("needle") == F.col("part")).alias("sure"))
    return cut(found, "links"), cut(known.where(F.coalesce(F.length("part"), F.lit(0)) < 3).select("symbol", "needle"), "short")


def _by_links(records: DataFrame, found: DataFrame) -> DataFrame:
    """record_id, symbol of the links' names that texts hold."""
    few = found.limit(FEW_SYMBOLS + 1).count() <= FEW_SYMBOLS
    broken = records.select("record_id", _low_text().alias("low")).withColumn("token", F.explode(tokens(F.col("low"))))
    met = broken.join(F.broadcast(found) if few else found, "token")
    return met.where(F.col("sure") | F.col("low").contains(F.col("needle"))).select("record_id", "symbol")


def _by_short(records: DataFrame, short: DataFrame) -> DataFrame:
    """record_id, symbol of names of one or two characters, or without any of the alphabet of tokens: there are few such names, one row of them."""
    listed = short.agg(F.collect_list(F.struct("symbol", "needle")).alias("s"))
    texts = records.select("record_id", _low_text().alias("low"))
    return texts.crossJoin(F.broadcast(listed)).select("record_id", F.explode(F.filter("s", lambda x: F.contains(F.col("low"), x["needle"]))).alias("x")).select("record_id", "x.symbol")


def config_text(records: DataFrame, symbols: DataFrame, literal_suffix: bool = False) -> DataFrame:
    """record_id, tag: symbols whose lower-cased name, without CONFIG_, the lower-cased subject and body hold.

    literal_suffix keeps =y and =m as a part of the name. A name is looked up among the distinct tokens of all texts, and found in a
    text by the token that holds it: a row of a text per distinct token, and none per symbol. Names that are no token (short ones,
    or such with other characters) are tested for their longest token, in the texts that hold it.
    """
    found, short = _symbol_links(records, symbols, literal_suffix)
    hit = _by_links(records, found).union(_by_short(records, short))
    return hit.select("record_id", F.concat(F.lit("config_text:"), "symbol").alias("tag")).distinct()


def product_evidence(records: DataFrame, config_paths: DataFrame, dirs: DataFrame, log_objects: DataFrame, artifacts: DataFrame, symbols: DataFrame) -> DataFrame:
    """record_id, product_evidence: all tags of a record, sorted; none is an empty list.

    records have touched (see with_touched). Every link is looked up by what records ask for (directories, prefixes, tokens): the answers go to the records, and one row of each record is
    moved, with all its tags. Records and the map are read several times: give tables that are written (see stages.cut) where they come from joins. Rows that repeat a record_id have the tags of all.
    """
    # what is known of a prefix is the same in all records that touch it
    guess = records.select(F.explode("touched").alias("record_id")).distinct()
    each = cut(guess.select("record_id", F.array("record_id").alias("touched")), "prefixes")
    of_guess = config_dir(each, dirs).union(build_log(each, log_objects)).union(artifact(each, artifacts))
    found, short = _symbol_links(records, symbols)
    tag = F.concat(F.lit("config_text:"), "symbol")
    # every record asks for one row that is always there, so that none is lost
    always = records.sparkSession.range(1).select(F.lit("").alias("kind"), F.lit("").alias("at"), F.lit(None).cast("string").alias("tag"))
    answers = always.union(_mapped(config_paths)).union(of_guess.select(F.lit("guess"), "record_id", "tag")).union(found.where("sure").select(F.lit("token"), "token", tag))
    asks = F.concat(F.array(_ask("", F.lit(""))), _of_files(), F.transform(F.coalesce("touched", F.array().cast("array<string>")), lambda g: _ask("guess", g)), F.transform(tokens(_low_text()), lambda t: _ask("token", t)))
    tags = _answered(records, asks, answers)
    # names that are tested in the texts themselves
    unsure = found.where("not sure")
    for some, by in ((unsure, _by_links), (short, _by_short)):
        if not some.isEmpty():
            tags = tags.union(by(records, some).select("record_id", F.lit(None), F.array(tag)))
    one = tags.groupBy("record_id").agg(F.count_if(F.col("kind") == "").cast("int").alias("n"), _all_tags().alias("tags"))
    none = F.array().cast("array<string>")
    # as often as records have it; without an id rows are no record's
    rows = one.withColumn("_i", F.explode(F.array_repeat(F.lit(0), F.col("n"))))
    return rows.select("record_id", F.when(F.col("record_id").isNull(), none).otherwise(F.col("tags")).alias("product_evidence"))


def list_key(files: Column) -> Column:
    """128 bits that stand for a list of files."""
    return F.struct(F.xxhash64(files).alias("a"), F.xxhash64(F.lit(1), files).alias("b"))


#: Files with flags, by a digest at 18 bytes each, up to which they are sent to every task.
FEW_FILES = 1_000_000


def file_flags(records: DataFrame, sets: DataFrame) -> DataFrame:
    """key (see list_key), has_artifact, covered of every distinct list of files of which any has an artifact, or any is compiled, in a compiled directory or steers the build.

    sets(kind, value): see compiled_sets. Each distinct file is looked up once, for all its kinds in one join. Lists without
    any flag are left out. What is known of files is a written table by a 128-bit digest of the file, which is sent to the lists up to
    FEW_FILES rows, so that a list is summed up where it is; beyond that the single files of all lists are joined with it.
    """
    # lists stay where they are: digests and single files move, summed up before they do
    each = records.where(F.size("files") > 0).select(list_key(F.col("files")).alias("key"), F.explode("files").alias("file"))
    asks = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    asked = F.array(*(asks(k, v) for k, v in (("artifact", stem(F.col("file"))), ("log", stem(basename(F.col("file")))), ("file", F.col("file")), ("dir", dirname(F.col("file"))))))
    # what steers the build asks for a row that is always there: in a branch of its own all records would be read once more
    steers = F.array(asks("steers", F.lit("")))
    asked = F.when(is_build_file(F.col("file")), F.concat(asked, steers)).otherwise(asked)
    wanted = sets.select("kind", "value").union(sets.sparkSession.range(1).select(F.lit("steers"), F.lit("")))
    files = each.select("file").distinct()
    hits = files.select("file", F.explode(asked).alias("x")).select("file", "x.kind", "x.value").join(wanted, ["kind", "value"]).select("file", "kind")
    of = hits.groupBy("file").agg(F.bool_or(F.col("kind").isin("artifact", "log")).alias("has_artifact"), F.bool_or(F.col("kind").isin("file", "dir", "steers")).alias("covered"))
    known = cut(of.select(list_key(F.col("file")).alias("at"), "has_artifact", "covered").select("at.a", "at.b", "has_artifact", "covered"), "files")
    sent = F.broadcast(known) if known.count() <= FEW_FILES else known
    met = each.select("key", list_key(F.col("file")).alias("at")).select("key", "at.a", "at.b").join(sent, ["a", "b"])
    return met.groupBy("key").agg(F.bool_or("has_artifact").alias("has_artifact"), F.bool_or("covered").alias("covered"))


def with_artifact(records: DataFrame, sets: DataFrame) -> DataFrame:
    """record_id of records with a file whose path without extension is an artifact's."""
    wanted = sets.where("kind = 'artifact'").select("value")
    return _files(records).select("record_id", stem(F.col("file")).alias("value")).join(wanted, "value", "left_semi").select("record_id").distinct()


def in_log(records: DataFrame, sets: DataFrame) -> DataFrame:
    """record_id of records with a file whose name without extension is a log object's."""
    wanted = sets.where("kind = 'log'").select("value")
    return _files(records).select("record_id", stem(basename(F.col("file"))).alias("value")).join(wanted, "value", "left_semi").select("record_id").distinct()


def covered(records: DataFrame, sets: DataFrame) -> DataFrame:
    """record_id of records with a compiled file, a file in a compiled directory or one that steers the build."""
    files = _files(records)
    compiled = files.join(sets.where("kind = 'file'").select(F.col("value").alias("file")), "file", "left_semi").select("record_id")
    inside = files.select("record_id", dirname(F.col("file")).alias("value")).join(sets.where("kind = 'dir'").select("value"), "value", "left_semi").select("record_id")
    steering = files.where(is_build_file(F.col("file"))).select("record_id")
    return compiled.union(inside).union(steering).distinct()


def uncovered(records: DataFrame, sets: DataFrame) -> DataFrame:
    return records.select("record_id").join(covered(records, sets), "record_id", "left_anti")
