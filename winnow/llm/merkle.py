"""A Merkle manifest of a dataset: one root per language, one over all, and a proof for every document.

A leaf is the digest of a row's fields. The leaves of a language, in order of doc_id, stand in aligned blocks of BLOCK. A
block keeps each of its levels as one string of digests side by side: fixed-width substrings of two digests are
hashed into the next level, and the substring beside a node is its sibling. The last node of a level that has no sibling is hashed
alone. The roots of the blocks are the leaves of the next round of blocks, until one node is left: the language's subroot. Subroots,
in order of their languages, are the leaves of the tree that ends in the root.

A proof is the list of a leaf's siblings up to the root. Those within a block are read from its levels; those above are the same for
the whole block, and are joined with it and not with its rows. Everything is Spark SQL, without user functions.

Leaves are numbered without a window over a language: they are sorted into ranges, each row is counted from its range's
first, and the ranges' sizes, as many rows as there are ranges, are summed up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import cut, discard, partitions

#: Nodes of a block: two to the power of LEVELS. Characters of a digest.
LEVELS, WIDTH = 10, 64
BLOCK = 1 << LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<sibling:string,left:boolean>>"


def digest(*parts: Column) -> Column:
    """The lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field of a leaf: `-` where it is null, else its UTF-8 bytes after their number and a colon."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    """The digest of a row's FIELDS, of which some may be changed."""
    return digest(*(field(changed.get(f, F.col(f))) for f in FIELDS))


def _group(value: Column) -> Column:
    """A group's key that is never null and sorts like the value, null first."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def numbered(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows(g, ...) with pos, a row's place in its group by order, and t, the group's rows; and the written table that they are read from."""
    n = partitions(rows.sparkSession)
    by = ["g", *order]
    ranged = cut(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)), name)
    sizes = ranged.groupBy("g", "range").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    of = Window.partitionBy("g")
    before = F.sum("n").over(of.orderBy("range")) - F.col("n")
    sizes = sizes.select("g", "range", (before - F.col("first")).alias("shift"), F.sum("n").over(of).alias("t"))
    return ranged.join(sizes, ["g", "range"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "range", "shift"), ranged


def _largest(rows: DataFrame) -> int:
    """Rows of the largest group."""
    return rows.groupBy("g").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _next(level: Column) -> Column:
    """The level above: the digests of every two nodes, the last of which may stand alone."""
    pairs = F.ceil(F.octet_length(level) / (2 * WIDTH)).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.sha2(F.substring(level, i * (2 * WIDTH) + 1, F.lit(2 * WIDTH)), 256))
    return F.array_join(hashed, "").cast("binary")


def lifted(nodes: DataFrame, name: str) -> DataFrame:
    """A written table of the blocks of nodes(g, pos, t, node, ...): g, block, t, members (by pos), levels, root.

    A block of a group with more than BLOCK nodes rises LEVELS levels; the only block of a smaller one as many as leave one node.
    """
    rest = [c for c in nodes.columns if c not in ("g", "pos", "t")]
    blocks = nodes.groupBy("g", F.expr(f"pos div {BLOCK}").alias("block"), "t").agg(F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("members"))
    rises = F.when(F.col("t") <= 1, 0).otherwise(F.least(F.lit(LEVELS), F.length(F.bin(F.col("t") - 1))))
    lowest = F.array_join(F.transform("members", lambda m: m["node"]), "").cast("binary")
    steps = F.filter(F.sequence(F.lit(1), F.lit(LEVELS)), lambda j: j <= rises)
    levels = F.aggregate(steps, F.array(lowest), lambda done, _: F.concat(done, F.array(_next(F.element_at(done, -1)))))
    out = blocks.withColumn("levels", levels)
    return cut(out.withColumn("root", F.element_at("levels", -1).cast("string")).withColumn("levels", F.slice("levels", F.lit(1), F.size("levels") - 1)), name)


def _siblings(place: Column) -> Column:
    """The path of a block's node to the block's root: each level's sibling, empty where there is none, and whether it stands on the left."""

    def beside(level: Column, j: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(2), j)).cast("int")
        left = at % 2 == 1
        return F.struct(F.substring(level, F.when(left, at - 1).otherwise(at + 1) * WIDTH + 1, F.lit(WIDTH)).cast("string").alias("sibling"), left.alias("left"))

    return F.transform("levels", beside)


def risen(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The rounds of blocks from the nodes to one root of each group. most: the nodes of the largest group."""
    rounds = []
    while True:
        rounds.append(lifted(nodes, name))
        if most <= BLOCK:
            return rounds
        most = -(-most // BLOCK)
        nodes = rounds[-1].select("g", F.col("block").alias("pos"), F.expr(f"cast(ceil(t / {BLOCK}) as bigint)").alias("t"), F.col("root").alias("node"))


def paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """g, pos and the other columns of the nodes of the lowest round, path, and what tops has besides.

    tops(g, path, ...): the way on from each group's root.
    """
    carried = [c for c in tops.columns if c not in ("g", "path")]
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for k, blocks in reversed(list(enumerate(rounds))):
        joined = blocks.select("g", "block", "members", "levels").join(above, ["g", "block"])
        walked = F.transform("members", lambda m, i: F.struct(m.alias("m"), F.concat(_siblings(i), F.col("path")).alias("path")))
        # outer: an explode that skips empty arrays would compute each of them twice
        rows = joined.select("g", *carried, F.explode_outer(walked).alias("x"))
        above = rows.select("g", *carried, "x.m.*", "x.path") if not k else rows.select("g", *carried, F.col("x.m.pos").alias("block"), "x.path")
    return above


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def step(at: Column, s: Column) -> Column:
        return F.when(s["sibling"] == "", F.sha2(at, 256)).when(s["left"], digest(s["sibling"], at)).otherwise(digest(at, s["sibling"]))

    return F.aggregate(path, node, step)


def proofs(docs: DataFrame, claimed: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every row's place in the manifest: doc_id, lang, leaf, claimed, subroot, root, path (sibling, left; from the leaf to the root).

    claimed: from the leaf, the digest that is to be checked against the proof; null where it is the leaf. Rows of a language stand
    by doc_id, null first, and rows that repeat one by their leaves; equal rows are leaves of their own. Null fields have a form
    of their own; a null lang is a group, the first. An empty table gives no rows. Extra columns are ignored.
    """
    none = F.lit(None).cast("string")
    made = docs.select(_group(F.col("lang")).alias("g"), "doc_id", leaf().alias("node"), (claimed(leaf()) if claimed else none).alias("claimed"), F.monotonically_increasing_id().alias("nth"))
    made = cut(made, "leaves")
    # nth tells equal rows apart, so that a row that is repeated very often is dealt over ranges as well
    nodes, ordered = numbered(made, ["doc_id", "node", "nth"], "ordered")
    low = risen(nodes.drop("nth"), _largest(ordered), "blocks")
    subroots = low[-1].select("g", F.col("root").alias("node"))
    langs, listed = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), "node"), ["lang"], "subroots")
    high = risen(langs, _largest(listed), "tops")
    top = paths(high, high[-1].select("g", F.array().cast(_PATH).alias("path"), "root"))
    rows = paths(low, top.select(F.col("lang").alias("g"), "path", "root", F.col("node").alias("subroot")))
    lang = F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias("lang")
    out = cut(rows.select("doc_id", lang, F.col("node").alias("leaf"), F.coalesce("claimed", "node").alias("claimed"), "subroot", "root", "path"), "proofs")
    discard(made, ordered, listed, *low, *high)
    return out


def verified(proved: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (the digest of the siblings), folded_root (from the claimed digest), verified (whether that is the root)."""
    proof = F.sha2(F.array_join(F.transform("path", lambda s: s["sibling"]), ""), 256)
    out = proved.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded(F.col("claimed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(_: Column) -> Column:
    """The digest of a row to whose n_chars 1 was added, for rows whose doc_id has a checksum that 7 divides; null for others and where n_chars is null."""
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return F.when(hit, leaf(n_chars=F.col("n_chars") + 1))


def audit(docs: DataFrame) -> DataFrame:
    """The manifest of docs, and every row checked against its proof after some were tampered with; see proofs, verified and tampered."""
    return verified(proofs(docs, tampered))
