"""Product context: configurations, makefiles, build logs, artifacts, and what they say about paths."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.functions.scalars import basename, dirname, stem


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no, line of text files."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def enabled_symbols(lines: DataFrame, column: str = "value") -> DataFrame:
    """symbol: trimmed lines that start with CONFIG_ and hold =y or =m anywhere."""
    line = F.trim(F.col(column))
    return lines.select(line.alias("symbol")).where(F.col("symbol").startswith("CONFIG_") & (F.col("symbol").contains("=y") | F.col("symbol").contains("=m")))


def parse_config(lines: DataFrame) -> DataFrame:
    """symbol, value, enabled of lines(line_no, line): the last assignment of a symbol counts; `is not set` has no value."""
    line = F.trim("line")
    set_to, unset = r"^(CONFIG_\w+)=(.*)$", r"^# (CONFIG_\w+) is not set$"
    found = lines.select("line_no", F.when(line.rlike(set_to), F.struct(F.regexp_extract(line, set_to, 1).alias("symbol"), F.regexp_extract(line, set_to, 2).alias("value"))).when(line.rlike(unset), F.struct(F.regexp_extract(line, unset, 1).alias("symbol"), F.lit(None).cast("string").alias("value"))).alias("x"))
    given = found.where("x is not null").select("line_no", "x.symbol", "x.value")
    assigned = given.where("value is not null").groupBy("symbol").agg(F.max_by("value", "line_no").alias("value")).withColumn("enabled", F.lit(True))
    off = given.where("value is null").select("symbol", "value", F.lit(False).alias("enabled")).distinct()
    return assigned.union(off)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return parse_config(_lines(spark, path))


def normal_path(path: Column) -> Column:
    """The path without `.`, doubled slashes and steps back that can be taken, as a stack folded over its segments; an empty one is `.`."""
    absolute = path.startswith("/")
    parts = F.filter(F.split(path, "/"), lambda x: ~x.isin("", "."))

    def step(done: Column, x: Column) -> Column:
        back = (x == "..") & (F.size(done) > 0) & (F.coalesce(F.element_at(F.concat(F.array(F.lit("")), done), -1), F.lit("")) != "..")
        return F.when(back, F.slice(done, F.lit(1), F.size(done) - 1)).when((x == "..") & absolute, done).otherwise(F.concat(done, F.array(x)))

    joined = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    lead = F.when(path.startswith("//") & ~path.startswith("///"), "//").when(absolute, "/").otherwise("")
    whole = F.concat(lead, joined)
    return F.when(whole == "", ".").otherwise(whole)


def makefile_map(lines: DataFrame, directory: Column, column: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """symbol, path (and the columns of keep) from lines `obj-$(CONFIG_X) += a.o b.o`: each object's source, beside its makefile.

    The symbol is what follows the last `$(`; it must start with CONFIG_. Paths are normalised.
    """
    rule = r"^obj-(.*?)\s*(\+=|:=|=)\s*(.*)$"
    line = F.trim(F.col(column))
    found = lines.where(line.rlike(rule) & ~line.startswith("#")).select(*keep, directory.alias("dir"), F.regexp_extract(line, rule, 1).alias("target"), F.regexp_extract(line, rule, 3).alias("objects"))
    symbol = F.regexp_replace(F.substring_index("target", "$(", -1), r"\)+$", "")
    named = found.where(F.col("target").contains("$(")).select(*keep, "dir", symbol.alias("symbol"), F.explode(F.split("objects", r"\s+")).alias("object"))
    named = named.where(F.col("symbol").startswith("CONFIG_") & F.col("object").endswith(".o"))
    source = F.regexp_replace("object", r"\.o$", ".c")
    at = F.when(source.startswith("/"), source).otherwise(F.concat_ws("/", F.nullif("dir", F.lit("")), source))
    return named.select(*keep, "symbol", normal_path(at).alias("path")).distinct()


def read_makefiles(spark: SparkSession, root: str) -> DataFrame:
    """symbol, path of all files named Makefile or Kbuild under root, relative to it."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "{Makefile,Kbuild}").text(root, wholetext=True)
    at = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/*", "/")
    base = root.split(":", 1)[-1].rstrip("/")
    relative = F.expr(f"substring(at, {len('/' + base.lstrip('/')) + 2})")
    rows = files.select(at.alias("at"), F.explode(F.split("value", "\r?\n")).alias("line")).withColumn("dir", dirname(relative))
    return makefile_map(rows, F.col("dir"))


def kbuild_files(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "{Makefile,Kbuild}").text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path")).distinct()


def log_objects(lines: DataFrame, column: str = "value") -> DataFrame:
    """name: distinct basenames of the tokens that end with .o or .ko."""
    token = F.explode(F.split(F.coalesce(F.col(column), F.lit("")), r"\s+"))
    return lines.select(token.alias("token")).where(F.col("token").rlike(r"\.k?o\z")).select(basename(F.col("token")).alias("name")).distinct()


def read_build_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    return log_objects(spark.read.text(paths))


def artifact_paths(files: DataFrame, root: str) -> DataFrame:
    """path of the objects and modules among files(path) under root, relative to it."""
    at = F.regexp_replace("path", "^[a-z]+:/*", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    below = files.select(at.alias("path")).where(F.col("path").startswith(base) & F.col("path").rlike(r"\.k?o\z"))
    return below.select(F.expr(f"substring(path, {len(base) + 1})").alias("path"))


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """The artifacts below a folder, empty files included.

    No file is read: a scan would leave out the empty ones, so the names are those of its file index, which Spark keeps on the driver for any read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{o,ko}").load(root)
    return artifact_paths(spark.createDataFrame([(unquote(p),) for p in files.inputFiles()], "path string"), root)


def parse_hints(files: DataFrame) -> DataFrame:
    """keyword, prefix of JSON objects in files(value); a single prefix may stand without a list. Comment keys are left out."""
    entries = files.select(F.explode(F.from_json("value", "map<string,string>")).alias("keyword", "spec")).where(~F.col("keyword").startswith("//"))
    listed = F.when(F.col("spec").startswith("["), F.from_json("spec", "array<string>")).otherwise(F.array("spec"))
    return entries.select("keyword", F.explode(listed).alias("prefix"))


def read_hints(spark: SparkSession, path: str) -> DataFrame:
    return parse_hints(spark.read.text(path, wholetext=True))


def config_to_paths(config_paths: DataFrame) -> DataFrame:
    """symbol -> its distinct paths, sorted."""
    return config_paths.groupBy("symbol").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def config_dirs(config_paths: DataFrame) -> DataFrame:
    """dir: distinct directories of mapped paths, with a slash at the end; files at the root have none."""
    return config_paths.select(dirname(F.col("path")).alias("d")).where("d <> ''").select(F.concat("d", F.lit("/")).alias("dir")).distinct()


def sample_revisions(revisions: DataFrame, step: int, most: int | None = None, mode: str = "range") -> DataFrame:
    """seq, rev: the first, every step-th before the last, and the last; in other modes the two ends.

    revisions: seq (0-based), rev. At most `most` of these, in order, before repeats are dropped.
    """
    ends = revisions.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    # one row on that side
    near = revisions.crossJoin(F.broadcast(ends))
    picked = near.where((F.col("seq") == F.col("lo")) | (F.col("seq") == F.col("hi")) | (F.lit(mode == "range") & ((F.col("seq") - F.col("lo")) % step == 0)))
    picked = picked.select("seq", "rev")
    picked = picked.orderBy("seq").limit(most) if most else picked
    return picked.groupBy("rev").agg(F.min("seq").alias("seq")).select("seq", "rev")


def history_paths(blobs: DataFrame) -> DataFrame:
    """rev, symbol, path of makefile blobs(rev, path, text)."""
    lines = blobs.select("rev", dirname(F.col("path")).alias("at"), F.explode(F.split("text", "\r?\n")).alias("line"))
    return makefile_map(lines, F.col("at"), keep=("rev",))


def history_spans(blobs: DataFrame) -> DataFrame:
    """path, digest, first, last, end: the spans of revisions in which a makefile has one text, of blobs(seq, path, text).

    A blob stands from its revision until the next one of its path; a text that is told again, or a blob that repeats, ends no
    span. first and last: the revisions that tell it; end: the one that ends it, or null while it holds. A null text is a makefile that is gone. Of several
    texts of a path in one revision, the first in order of their digests counts.
    """
    told = blobs.select("seq", "path", F.sha2("text", 256).alias("digest"))
    one = told.groupBy("path", "seq").agg(F.min("digest").alias("digest"))
    of = Window.partitionBy("path").orderBy("seq")
    new = one.withColumn("new", F.coalesce((~F.col("digest").eqNullSafe(F.lag("digest").over(of))) | (F.row_number().over(of) == 1), F.lit(True)))
    span = new.withColumn("span", F.sum(F.col("new").cast("int")).over(of))
    spans = span.groupBy("path", "span").agg(F.first("digest").alias("digest"), F.min("seq").alias("first"), F.max("seq").alias("last"))
    ended = spans.withColumn("end", F.lead("first").over(Window.partitionBy("path").orderBy("span")))
    return ended.where("digest is not null").select("path", "digest", "first", "last", "end")


#: The end of a span that holds.
_NEVER = 2**62


def history_intervals(blobs: DataFrame) -> DataFrame:
    """symbol, path, first, end: from which revision until which one, or null, a makefile maps a symbol to a source, of blobs(seq, path, text).

    Each distinct text of a folder is parsed once, whatever the number of revisions that have it.
    """
    spans = history_spans(blobs).select(dirname(F.col("path")).alias("dir"), "digest", "first", "end")
    texts = blobs.select(F.sha2("text", 256).alias("digest"), "text").groupBy("digest").agg(F.any_value("text").alias("text"))
    wanted = spans.select("dir", "digest").distinct().join(texts, "digest")
    lines = wanted.select(F.col("dir").alias("at"), "digest", F.explode(F.split("text", "\r?\n")).alias("line"))
    parsed = makefile_map(lines, F.col("at"), keep=("at", "digest")).withColumnRenamed("at", "dir")
    each = spans.join(parsed, ["dir", "digest"]).select("symbol", "path", "first", F.coalesce("end", F.lit(_NEVER)).alias("end")).distinct()
    # spans that meet or overlap are one
    of = Window.partitionBy("symbol", "path").orderBy("first", "end")
    before = F.max("end").over(of.rowsBetween(Window.unboundedPreceding, -1))
    apart = each.withColumn("new", F.coalesce(F.col("first") > before, F.lit(True)).cast("int")).withColumn("nth", F.sum("new").over(of))
    whole = apart.groupBy("symbol", "path", "nth").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    return whole.select("symbol", "path", "first", F.when(F.col("end") < _NEVER, F.col("end")).alias("end"))


def map_at(intervals: DataFrame, seq: int) -> DataFrame:
    """symbol, path of the map at a revision."""
    return intervals.where((F.col("first") <= seq) & (F.col("end").isNull() | (F.col("end") > seq))).select("symbol", "path").distinct()


def history_merge(snapshots: DataFrame, base: DataFrame) -> DataFrame:
    """symbol, path over all snapshots(rev, symbol, path) and the map at hand."""
    return snapshots.select("symbol", "path").union(base.select("symbol", "path")).distinct()


def blob_key(rev: Column, path: Column) -> Column:
    return F.substring(F.sha2(F.concat(rev, F.lit(":"), path), 256), 1, 24)


def blob_misses(wanted: DataFrame, blobs: DataFrame) -> DataFrame:
    """key, rev, path of the wanted blobs that the table lacks."""
    return wanted.join(blobs.select("rev", "path"), ["rev", "path"], "left_anti").select(blob_key(F.col("rev"), F.col("path")).alias("key"), "rev", "path")


def bare(symbol: Column) -> Column:
    return F.regexp_replace(symbol, r"=[ym].*$", "")


def compiled_sets(config_paths: DataFrame, enabled: DataFrame, artifacts: DataFrame, objects: DataFrame) -> DataFrame:
    """kind, value of what is built: file, dir, artifact (stem), log (stem).

    Files are the mapped paths whose symbol is enabled. Where there is none, nothing counts as built,
    artifacts and log included.
    """
    on = enabled.select(bare(F.col("symbol")).alias("symbol")).distinct()
    files = config_paths.join(on, "symbol", "left_semi").select("path").distinct()
    kinds = (
        files.select(F.lit("file").alias("kind"), F.col("path").alias("value"))
        .union(files.select(F.lit("dir").alias("kind"), dirname(F.col("path")).alias("value")).where("value <> ''"))
        .union(artifacts.select(F.lit("artifact").alias("kind"), stem(F.col("path")).alias("value")))
        .union(objects.select(F.lit("log").alias("kind"), stem(F.col("name")).alias("value")))
        .distinct()
    )
    # one row: whether any file is left
    available = files.limit(1).agg((F.count("*") > 0).alias("available"))
    return kinds.crossJoin(F.broadcast(available)).where("available").drop("available")
