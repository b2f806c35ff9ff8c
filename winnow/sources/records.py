"""Records: what is triaged. Text logs and tables as one schema.

record_id, seq (the order that every tie follows), subject, body, files, author_name, author_email,
author_time, commit_time, parents, numstat.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.sources.stages import cut, discard

RECORD_MARK, TAIL_MARK = "\x1e", "\x1f"


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?m)^{name}=(.*)$", 1)


def _number(text: Column) -> Column:
    return F.coalesce(F.trim(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A text dump: records end with 0x1E, and 0x1F parts a record's key=value head from its file lines."""
    raw = spark.read.option("lineSep", RECORD_MARK).text(path).select("value", F.monotonically_increasing_id().alias("seq"))
    return parse_log(raw)


def parse_log(raw: DataFrame) -> DataFrame:
    """Records of raw(seq, value). body= takes the rest of the head, its lines joined with spaces; numbers default to 0."""
    kept = raw.where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    parts = F.split("value", TAIL_MARK, 2)
    split = kept.select("seq", F.regexp_replace(parts[0], "\r\n", "\n").alias("whole"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("tail"))
    body = F.regexp_extract("whole", r"(?s)(?:^|\n)body=(.*)$", 1)
    head = F.regexp_replace("whole", r"(?s)(^|\n)body=.*$", "")
    split = split.select("seq", head.alias("head"), F.trim(F.array_join(F.split(body, "\n"), " ")).alias("body"), "tail")
    h = F.col("head")
    # `12 TAB 3 TAB path`, a dash for binary files, or a path alone
    lines = F.filter(F.transform(F.split("tail", "\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    cells = F.transform(lines, lambda x: F.split(x, "\t"))
    counted = F.filter(cells, lambda c: (F.size(c) == 3) & F.get(c, F.lit(0)).rlike(r"^(\d+|-)$"))
    numstat = F.transform(counted, lambda c: F.struct(F.get(c, F.lit(0)).alias("added"), F.get(c, F.lit(1)).alias("deleted"), F.get(c, F.lit(2)).alias("path")))
    alone = F.transform(F.filter(cells, lambda c: F.size(c) == 1), lambda c: F.get(c, F.lit(0)))
    out = split.select(
        _field(h, "commit").alias("record_id"),
        "seq",
        _field(h, "subject").alias("subject"),
        "body",
        numstat.alias("numstat"),
        alone.alias("alone"),
        _field(h, "author_name").alias("author_name"),
        _field(h, "author_email").alias("author_email"),
        _number(_field(h, "author_time")).alias("author_time"),
        _number(_field(h, "commit_time")).alias("commit_time"),
        F.filter(F.split(_field(h, "parents"), r"\s+"), lambda p: p != "").alias("parents"),
    )
    files = F.array_sort(F.array_distinct(F.concat(F.transform("numstat", lambda n: n["path"]), "alone")))
    return out.withColumn("files", files).drop("alone")


def numstat_rollup(records: DataFrame) -> DataFrame:
    """Per record: files, and lines added and deleted where they are counted (binary files count as files alone)."""
    total = lambda name: F.aggregate("numstat", F.lit(0).cast("bigint"), lambda s, n: s + F.coalesce(n[name].try_cast("bigint"), F.lit(0)))
    binary = F.size(F.filter("numstat", lambda n: n["added"] == "-")).cast("bigint")
    return records.select("record_id", F.size("files").cast("bigint").alias("n_files"), total("added").alias("added"), total("deleted").alias("deleted"), binary.alias("binary"))


def without_merges(records: DataFrame) -> DataFrame:
    return records.where(F.size("parents") <= 1)


def first_parents(records: DataFrame, head: str | None = None) -> DataFrame:
    """The records that first parents lead to from head, itself included; without one, from the first in log order.

    Ways are doubled: each round adds what is as far again from the head as the farthest so far, and joins every way
    with the next one of its length. So a chain takes as many rounds as its length has binary digits. A record_id that is
    repeated has the parents of its first row, and all its rows stay; a parent that the log lacks ends the chain.
    """
    first = records.where("record_id is not null").groupBy("record_id").agg(F.min_by(F.get("parents", F.lit(0)), "seq").alias("up"))
    way = cut(first.where("up is not null"), "way")
    start = records.orderBy("seq").limit(1).select("record_id") if head is None else records.where(F.col("record_id") == head).select("record_id").distinct()
    reached = cut(start, "reached")
    found = reached.count()
    while found:
        n, before = found, reached
        reached = cut(before.union(before.join(way, "record_id").select("up")).distinct(), "reached")
        discard(before)
        found = reached.count()
        if found == n:
            break
        shorter, onward = way, way.select(F.col("record_id").alias("up"), F.col("up").alias("to"))
        way = cut(shorter.join(onward, "up").select("record_id", F.col("to").alias("up")), "way")
        discard(shorter)
    discard(way)
    return records.join(reached, "record_id", "left_semi").select(*records.columns)


def first_n(records: DataFrame, n: int) -> DataFrame:
    """The first n records in log order; 0: all."""
    return records.orderBy("seq").limit(n) if n else records


def stage_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A written stage table, or an empty one of the schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _id(key: str) -> Column:
    return F.sha2(F.col(key).cast("string"), 256)


def from_documents(docs: DataFrame) -> DataFrame:
    """Documents as records: the first line is the subject, the text the body, source and language the path."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        _id("doc_id").alias("record_id"),
        F.col("doc_id").alias("seq"),
        F.substring_index(text, "\n", 1).alias("subject"),
        text.alias("body"),
        F.array(F.concat_ws("/", "source", "lang", F.lit("doc.txt"))).alias("files"),
        F.col("source").alias("author_name"),
    )


def part_path(prefix: str = "") -> Column:
    number = F.regexp_extract("p_brand", r"(\d+)$", 1)
    return F.concat(F.lower("p_type"), F.lit("/brand_"), number, F.lit("/"), F.regexp_replace("p_name", " ", "_"), F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".c"))


def from_orders(orders: DataFrame, lineitem: DataFrame, part: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders as records, the paths of their parts as files; orders without lines have none."""
    paths = part.select(F.col("p_partkey").alias("l_partkey"), part_path().alias("path"))
    # a part that an order has twice is one in the set of its paths: the lines need no distinct() of their own, which would move all of them once more
    lines = lineitem.select("l_orderkey", "l_partkey").join(paths, "l_partkey")
    files = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("path")).alias("files"))
    named = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("author_name")), "o_custkey", "left")
    none = F.array().cast("array<string>")
    return named.join(files, named.o_orderkey == files.l_orderkey, "left").select(
        _id("o_orderkey").alias("record_id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("subject"),
        F.concat_ws(" ", F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority").alias("body"),
        F.coalesce("files", none).alias("files"),
        "author_name",
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("author_time"),
    )


def from_pages(pages: DataFrame) -> DataFrame:
    """Pages as records: host as author, the path of the address as file."""
    path = F.regexp_extract("url", r"^[a-z]+://[^/]*/?([^?#]*)", 1)
    host = F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1)
    return pages.select(_id("page_id").alias("record_id"), F.col("page_id").alias("seq"), F.col("url").alias("subject"), F.lit("").alias("body"), F.array(path).alias("files"), host.alias("author_name"))


def from_events(events: DataFrame) -> DataFrame:
    """Events as records."""
    return events.select(
        _id("event_id").alias("record_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("subject"),
        F.coalesce("props", F.lit("")).alias("body"),
        F.array(F.concat_ws("/", F.lit("user"), F.col("user_id").cast("string"), "event_type")).alias("files"),
        F.col("user_id").cast("string").alias("author_name"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("author_time"),
    )
