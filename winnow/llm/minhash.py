"""Near-duplicate documents by an LSH forest over MinHash signatures.

Every document has a signature of TREES x DEPTH minimum hashes of its shingle set. A tree
orders the documents by its own DEPTH hashes; documents with a common prefix are a region of that tree. How deep a
region is follows from what it holds: it begins with the first two hashes, and as long as more documents than a
block takes share them, the next ones split it (DEPTHS). Two documents with a similarity s share a first region of some tree with a
probability of 1 - (1 - s**2)**TREES, which is 0.99995 at 0.75.

1. In the tree's order each document is a candidate for its neighbour with the longest common
   prefix, and in regions that fit a block for the one whose whole signature agrees most. Candidates whose
   signatures agree enough are checked on their full sets, and those that are similar are
   linked into classes. So a region of copies costs a few links per document.
2. A region whose documents are all in one class is done. In the others, of every depth, all documents outside
   the class of the one with the most links are candidates for that one, which is what the
   copies of one original need that resemble it more than each other.
3. Where several classes still meet, all pairs across classes whose signatures agree enough are
   checked on their sets: at the least depth at which the documents outside a region's largest class fit a block.
   So nearly settled regions of any size are compared as a whole. Only links leave the task; pairs within one class, which no link would change, are left out.
4. Regions of the first level that are too large for that hold documents which resemble each other in great number without being similar, such as
   pages of one template. Their documents are compared exactly: two similar sets have a shingle in common among the rarest of each, how many of them follows from
   both sizes (a seventh for sets of one size, a quarter at most). So each rare shingle, for two bands of sizes, is a region that is compared like
   others, and no pair is missed for being in a large region. Shingles of the template come last in that order, and make regions only for
   documents that have little else.

Documents with the same set are collapsed into one before. No task gathers a region: large ones are dealt by ranges of the order in step 1, and over
blocks in step 3, where a document's set is sent once, and those of the block outside the largest class to each of them. Only a region that all DEPTH hashes leave
with several such blocks sends sets more often. Only documents that share a region with another are
read again for their full sets: sorted 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import components, cut, discard, partitions, runs, slices
from winnow.llm.shingles import mix, pieces, shingle_sets

#: Links are for a similarity of NUMERATOR/100 or more.
NUMERATOR = 75
TREES, DEPTH, DEPTHS = 12, 8, (2, 3, 4, 6, 8)
HASHES = TREES * DEPTH
#: Signatures that agree in fewer of their hashes are no candidates: 0.75 less four standard deviations.
AGREE = int(HASHES * 0.75 - 4 * (HASHES * 0.75 * 0.25) ** 0.5)
#: Documents of a region that are compared together.
BLOCK = 512
#: How much larger the sets of one band of sizes may be than others of it.
BAND = 1.05
_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """32-bit minimum hashes: a row for each set. Those of an empty set are all ones."""
    out = np.full((len(sizes), HASHES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        top = np.empty(len(hashes), np.uint64)
        for j in range(HASHES):
            np.multiply(hashes, _ODD[j], out=top)
            out[some, j] = np.minimum.reduceat(top, starts) >> np.uint64(32)
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (a 128-bit digest of the set), signature (32-bit numbers, tree by tree)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for s, e in pieces(texts):
                hashes, sizes = shingle_sets(texts[s:e])
                ends = np.cumsum(sizes)
                sums = [np.append(np.uint64(0), np.cumsum(mix(hashes ^ np.uint64(k)))) for k in (1, 2)]
                a, b = ((x[ends] - x[ends - sizes]).view(np.int64) for x in sums)
                sig = signatures(hashes, sizes)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(s, e - s),
                        "n_shingles": sizes,
                        "set_a": a,
                        "set_b": b,
                        "signature": pa.array([x.tobytes() for x in sig.astype("<u4")], pa.binary()),
                    }
                )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(step, "doc_id long, n_shingles long, set_a long, set_b long, signature binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, shingles."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for s, e in pieces(texts):
                hashes, sizes = shingle_sets(texts[s:e])
                ends = np.cumsum(sizes).tolist()
                raw = pa.array([hashes[y - n : y].astype("<u8").tobytes() for y, n in zip(ends, sizes.tolist(), strict=True)], pa.binary())
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(s, e - s), "n_shingles": sizes, "shingles": raw})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(step, "doc_id long, n_shingles long, shingles binary")


def similar(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    small, large = (p, q) if len(p) < len(q) else (q, p)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= NUMERATOR * (len(p) + len(q) - shared)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs(a, b) whose full sets are similar enough."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column("set_of_a").to_pylist(), batch.column("set_of_b").to_pylist(), strict=True):
                keep.append(similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    of = sets.select("doc_id", "n_shingles", "shingles")
    # sizes alone rule some pairs out, before any set moves
    near = pairs.join(of.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a")), "a").join(of.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b")), "b")
    near = near.where(100 * F.least("n_a", "n_b") >= NUMERATOR * F.greatest("n_a", "n_b")).select("a", "b")
    both = near.join(of.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_of_a")), "a").join(of.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_of_b")), "b")
    return both.mapInArrow(step, "a long, b long")


def _signatures(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    raw = b"".join(batch.column("signature").to_pylist())
    return np.frombuffer(raw, "<u4").reshape(-1, HASHES)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1, over blocks in the tree's order: neighbours with the longest common prefix, and the best of each block."""
    found: list[np.ndarray] = []
    for run in runs(batches, ["tree", "region", "block"]):
        if run.num_rows < 2:
            continue
        ids, sig = run.column("doc_id").to_numpy(), _signatures(run)
        own = run.column("tree")[0].as_py() * DEPTH
        same = np.cumprod(sig[1:, own : own + DEPTH] == sig[:-1, own : own + DEPTH], axis=1).sum(1)
        up, down = np.append(-1, same), np.append(same, -1)
        row = np.arange(len(ids))
        near = np.where(up >= down, row - 1, row + 1)
        best = near
        if len(ids) > 2:
            best = np.empty(len(ids), np.int64)
            by_id = np.argsort(ids, kind="stable")
            for a in range(0, len(ids), 64):
                agree = (sig[a : a + 64, None, :] == sig[None, by_id, :]).sum(2)
                agree[by_id[None, :] == row[a : a + 64, None]] = -1
                best[a : a + 64] = by_id[agree.argmax(1)]
        pair = np.unique(np.concatenate([np.column_stack([row, near]), np.column_stack([row, best])]), axis=0)
        pair = pair[(sig[pair[:, 0]] == sig[pair[:, 1]]).sum(1) >= AGREE]
        both = ids[pair]
        found.append(both[both[:, 0] != both[:, 1]])
        if len(found) >= 2000:
            yield _pairs(np.concatenate(found))
            found = []
    if found:
        yield _pairs(np.concatenate(found))


def _pairs(both: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"a": both.max(1), "b": both.min(1)})


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree enough."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
        yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array((x == y).sum(1) >= AGREE))


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, over blocks: links across classes, one for each two classes that are linked in a block."""
    found: list[tuple[int, int]] = []
    for run in runs(batches, ["tree", "region", "block", "against"]):
        ids, cls, sizes = (run.column(c).to_numpy() for c in ("doc_id", "class", "n_shingles"))
        sig, raw = _signatures(run), run.column("shingles")
        sets: dict[int, np.ndarray] = {}
        joined: dict[int, int] = {}

        def top(c: int) -> int:
            while (up := joined.get(c, c)) != c:
                c = up
            return c

        def set_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.frombuffer(raw[i].as_py(), "<u8")
            return sets[i]

        a, b = (np.flatnonzero(run.column(c).to_numpy(zero_copy_only=False)) for c in ("minor", "any"))
        for i in a.tolist():
            other = b[(cls[b] != cls[i]) & (100 * np.minimum(sizes[b], sizes[i]) >= NUMERATOR * np.maximum(sizes[b], sizes[i]))]
            agree = (sig[other] == sig[i]).sum(1)
            fit = agree >= AGREE
            for j in other[fit][np.argsort(-agree[fit], kind="stable")].tolist():
                x, y = top(int(cls[i])), top(int(cls[j]))
                if x != y and similar(set_of(i), set_of(j)):
                    joined[max(x, y)] = min(x, y)
                    found.append((max(int(ids[i]), int(ids[j])), min(int(ids[i]), int(ids[j]))))
    if found:
        yield _pairs(np.array(found, np.int64))


def regions(reps: DataFrame) -> DataFrame:
    """A written table of the regions with two documents at least: level, tree, region, n (its documents), doc_id, order (the document's hashes of the tree).

    What more than BLOCK documents share is split by the next of DEPTHS.
    """
    trees = reps.select(F.col("rep").alias("doc_id"), "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    order = F.substring("signature", F.col("tree") * (4 * DEPTH) + 1, F.lit(4 * DEPTH))
    left = trees.select("doc_id", "tree", order.alias("order"))
    levels = []
    for level, depth in enumerate(DEPTHS):
        keyed = left.withColumn("region", F.xxhash64(F.lit(depth), "tree", F.substring("order", 1, 4 * depth)))
        counted = keyed.groupBy("tree", "region").agg(F.count("*").alias("n")).where("n > 1")
        levels.append(cut(keyed.join(counted, ["tree", "region"]).withColumn("level", F.lit(level)), "regions"))
        large = levels[-1].where(F.col("n") > BLOCK)
        if large.isEmpty():
            break
        left = large.select("doc_id", "tree", "order")
    if len(levels) == 1:
        return levels[0]
    out = cut(reduce(DataFrame.unionByName, levels), "regions")
    discard(*levels)
    return out


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 in large regions: neighbours in the tree's order."""
    last = None
    for batch in batches:
        tree, region, ids, sig = batch.column("tree").to_numpy(), batch.column("region").to_numpy(), batch.column("doc_id").to_numpy(), _signatures(batch)
        if last is not None:
            tree, region, ids, sig = (np.concatenate([x, y]) for x, y in zip(last, (tree, region, ids, sig), strict=True))
        near = (tree[1:] == tree[:-1]) & (region[1:] == region[:-1]) & ((sig[1:] == sig[:-1]).sum(1) >= AGREE)
        yield _pairs(np.column_stack([ids[1:], ids[:-1]])[near])
        last = tree[-1:], region[-1:], ids[-1:], sig[-1:]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The class of every document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets have 100 * intersection >= 75 * union; component_id is
    the smallest doc_id that links reach, and kept marks it. A text that is null or without
    words has an empty set and is linked with nothing. Rows with one doc_id count as one
    document that has the links of all of them; a row without a doc_id is linked with nothing,
    and kept. Extra columns are ignored; an empty table gives no rows.
    """
    n = partitions(docs.sparkSession)
    whole = cut(features(docs), "features")
    known = whole.where("n_shingles > 0 and doc_id is not null")
    reps = cut(known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature")), "representatives")
    copies = cut(known.select("doc_id", "set_a", "set_b").join(reps, ["set_a", "set_b"]).select("doc_id", "rep").distinct(), "copies")

    shared = regions(reps)
    # the ids grow with the documents, so they are not broadcast at any size
    sets = cut(full_sets(docs.join(shared.where("level = 0").select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")), "sets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("doc_id", "tree"), blocks).cast("int")
    sig = reps.select(F.col("rep").alias("doc_id"), "signature")

    large, deepest = F.col("n") > BLOCK, F.col("level") == len(DEPTHS) - 1
    dealt = shared.where(~large | deepest).select("tree", "region", "doc_id", "order", block.alias("block")).join(sig, "doc_id")
    dealt = dealt.repartition(2 * n, "tree", "region", "block").sortWithinPartitions("tree", "region", "block", "order", "doc_id")
    first = dealt.mapInArrow(_candidates, "a long, b long")
    # a large region of the first level has all neighbours of its parts
    top = shared.where(large & (F.col("level") == 0)).select("tree", "region", "doc_id", "order")
    if not top.isEmpty():
        first = first.union(top.join(sig, "doc_id").repartitionByRange(2 * n, "tree", "order", "doc_id").sortWithinPartitions("tree", "order", "doc_id").mapInArrow(_in_order, "a long, b long"))
    first = cut(first.distinct(), "candidates")
    links = cut(confirmed(first, sets), "links")

    written, shared = shared, shared.drop("order")
    classed = cut(_classed(shared, components(links)), "classed")
    ends = links.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("links"))
    hubs = classed.join(ends, "doc_id").groupBy("tree", "region").agg(F.max(F.struct("links", "doc_id", "class")).alias("h"))
    hubs = hubs.select("tree", "region", F.col("h.doc_id").alias("hub"), F.col("h.class").alias("hub_class"))
    # a region of one class has no document outside its hub's
    to_hub = classed.join(hubs, ["tree", "region"]).where("class <> hub_class")
    to_hub = to_hub.select(F.greatest("doc_id", "hub").alias("a"), F.least("doc_id", "hub").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    to_hub = cut(to_hub.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").mapInArrow(_agreeing, "a long, b long"), "hubs")
    more = cut(links.union(confirmed(to_hub, sets)), "links")

    again = cut(_classed(shared, components(more)), "classed")
    # regions that are compared as a whole, and of those that a document is in the least deep one
    state = cut(_open(again).withColumn("fits", (F.least("n", F.col("n") - F.col("top_size")) <= BLOCK) | deepest), "open")
    opened = state.where("fits").select("tree", "region", "top", "top_size")
    rows = again.join(opened, ["tree", "region"]).withColumn("least", F.min("level").over(Window.partitionBy("doc_id", "tree"))).where("level = least")
    known_of = sig.join(sets.select("doc_id", "n_shingles", "shingles"), "doc_id")
    stand = {"as_minor": F.col("class") != F.col("top"), "as_any": F.lit(True), "n_minor": F.col("n") - F.col("top_size"), "n_any": F.col("n")}
    across = compared(rows.withColumns(stand), known_of, n)
    crowded = state.where((F.col("level") == 0) & ~F.col("fits")).select("tree", "region")
    if not crowded.isEmpty():
        among = again.join(crowded, ["tree", "region"]).groupBy("doc_id").agg(F.first("class").alias("class"))
        across = across.union(compared(rare_regions(among, sets), known_of, n))
    across = cut(across, "across")
    final = cut(components(more.union(across)), "classes")

    found = copies.join(final, copies.rep == final.id, "left").groupBy("doc_id").agg(F.min(F.coalesce("component_id", "rep")).alias("component_id"))
    out = whole.select("doc_id", "n_shingles").join(found, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = cut(out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")), "near")
    discard(whole, reps, copies, written, sets, first, links, classed, to_hub, more, again, state, across, final)
    return out


def compared(rows: DataFrame, known_of: DataFrame, n_tasks: int) -> DataFrame:
    """Links (a, b) across classes within the regions of rows(tree, region, doc_id, class, as_minor, as_any, n_minor, n_any), one at least for each two classes that are linked there.

    Documents that stand as minor ones are compared with those that stand as any; n_minor and n_any: how many of them a region has.
    """
    none = F.lit(0)
    blocks, sides = (F.greatest(F.ceil(F.col(c) / BLOCK).cast("int"), F.lit(1)) for c in ("n_any", "n_minor"))
    block, side = (F.pmod(F.xxhash64("doc_id", "tree"), x).cast("int") for x in (blocks, sides))

    def cell(minor: Column, every: Column, i: Column, j: Column) -> Column:
        return F.struct(minor.alias("minor"), every.alias("any"), i.alias("block"), j.alias("against"))

    yes, no = F.lit(True), F.lit(False)
    minor, every = F.col("as_minor"), F.col("as_any")
    empty = F.filter(F.array(cell(no, no, none, none)), lambda c: c["minor"])
    as_any = F.when(every, F.transform(F.sequence(none, sides - 1), lambda j: cell(no, yes, block, j))).otherwise(empty)
    as_minor = F.when(minor, F.transform(F.sequence(none, blocks - 1), lambda i: cell(yes, no, i, side))).otherwise(empty)
    cells = F.when((blocks == 1) & (sides == 1), F.array(cell(minor, every, none, none))).otherwise(F.concat(as_any, as_minor))
    met = rows.select("tree", "region", "doc_id", "class", F.explode(cells).alias("c")).select("tree", "region", "doc_id", "class", "c.*")
    met = met.join(known_of, "doc_id").repartition(2 * n_tasks, "tree", "region", "block", "against").sortWithinPartitions("tree", "region", "block", "against")
    return met.mapInArrow(_crossing, "a long, b long")


def rare_regions(among: DataFrame, sets: DataFrame) -> DataFrame:
    """Regions of the documents of among(doc_id, class), as compared() takes them: a shingle, and the bands of sizes of the documents that meet at it.

    Two sets of s and t shingles that are similar enough have o >= N * (s + t) / (100 + N) in common. Of these the rarest, in one order of all
    shingles, stands at place s - o + 1 of the one set at most, and at t - o + 1 of the other: at that shingle they meet.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            raw = [np.frombuffer(x, "<i8") for x in batch.column("shingles").to_pylist()]
            sizes = [len(x) for x in raw]
            rows = pa.array(np.repeat(np.arange(len(raw)), sizes))
            yield pa.record_batch({"doc_id": batch.column("doc_id").take(rows), "class": batch.column("class").take(rows), "size": np.repeat(np.array(sizes, np.int64), sizes), "shingle": np.concatenate(raw) if raw else np.empty(0, np.int64)})

    each = cut(sets.select("doc_id", "shingles").join(among, "doc_id").select("doc_id", "class", "shingles").mapInArrow(step, "doc_id long, class long, size long, shingle long"), "shingles")
    often = each.groupBy("shingle").agg(F.count("*").alias("often"), (F.min("class") < F.max("class")).alias("crosses"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("often", "shingle"))
    band = lambda x: F.floor(F.log(x.cast("double")) / math.log(BAND)).cast("int")
    least = F.expr(f"({NUMERATOR} * size + 99) div 100")
    most = F.least(F.expr(f"100 * size div {NUMERATOR}"), F.expr(f"({100 + NUMERATOR} * (size + 1 - place)) div {NUMERATOR} - size"))
    ranked = each.join(often, "shingle").withColumn("place", place).where("crosses").withColumns({"least": least, "most": most}).where("most >= least")
    bands = ranked.select("doc_id", "class", "shingle", band(F.col("size")).alias("own"), F.explode(F.sequence(band(F.col("least")), band(F.col("most")))).alias("other"))
    region = F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other"))
    rows = cut(bands.select(region.alias("region"), "doc_id", "class", F.signum(F.col("own") - F.col("other")).cast("int").alias("role")), "rare")
    by_class = rows.groupBy("region", "class").agg(F.count("*").alias("size"), F.count_if(F.col("role") < 0).alias("low"), F.count_if(F.col("role") > 0).alias("high"))
    found = by_class.groupBy("region").agg(F.sum("size").alias("n"), F.count("*").alias("classes"), F.max(F.struct("size", "class")).alias("top"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    found = found.where("classes > 1 and (low > 0) = (high > 0)").withColumn("same", F.col("low") == 0)
    out = rows.join(found, "region")
    same = F.col("same")
    return out.select(
        F.lit(-1).alias("tree"),
        "region",
        "doc_id",
        "class",
        F.when(same, F.col("class") != F.col("top.class")).otherwise(F.col("role") < 0).alias("as_minor"),
        F.when(same, F.lit(True)).otherwise(F.col("role") > 0).alias("as_any"),
        F.when(same, F.col("n") - F.col("top.size")).otherwise(F.col("low")).alias("n_minor"),
        F.when(same, F.col("n")).otherwise(F.col("high")).alias("n_any"),
    )


def _classed(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Each document of each region with its class so far."""
    joined = shared.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return joined.withColumn("class", F.coalesce("component_id", "doc_id")).drop("component_id")


def _open(classed: DataFrame) -> DataFrame:
    """tree, region, level, n, top (its largest class), top_size of the regions that hold several classes."""
    sizes = classed.groupBy("level", "tree", "region", "n", "class").agg(F.count("*").alias("size"))
    found = sizes.groupBy("level", "tree", "region", "n").agg(F.count("*").alias("classes"), F.max(F.struct("size", "class")).alias("top")).where("classes > 1")
    return found.select("tree", "region", "level", "n", F.col("top.class").alias("top"), F.col("top.size").alias("top_size"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of kept documents, with the columns they have, whatever their names.

    Rows that repeat a doc_id go with it or stay with it: of those with one text one stays, the one whose columns have the smallest hash, and rows with
    different texts all stay, as nothing tells that they are copies. All rows without a doc_id stay. An empty table gives no rows.
    """
    near = near_duplicates(docs)
    dropped = near.where("not kept").select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    if near.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    some = F.col("doc_id").isNotNull()
    row = F.struct(*docs.columns)
    packed = left.where(some).groupBy(F.col("doc_id").alias("k"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("t")).agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("r"))
    return packed.select("r.*").union(left.where(~some))
