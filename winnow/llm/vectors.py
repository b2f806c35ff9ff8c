"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A model is fitted on a bounded sample: the vectors' mean, their principal directions, and
rotations of these, each alternated with the signs it gives until signs and projections agree
best (iterative quantisation, from several random starts). A vector's binary code is the signs
of its projections. The code is cut into tables of `width` bits; vectors of one label that share
a table's bits are candidates. They are compared by the cosine of the original vectors, in
double precision.

The angle of two vectors, seen from the mean, is about pi times the share of bits in which their codes differ,
so a pair at the least cosine shares a table's bits with a probability p of about
(1 - angle / pi) ** width, and there are as many tables as make 1 - (1 - p) ** tables at least
the asked recall. That angle is wider the nearer the vectors are to the mean, as where all share a common
component; it is taken for the near ones of the sample. The width grows with the logarithm of the number of vectors of a label, so that a bucket
keeps its size (of the largest label: smaller ones have smaller buckets), but no further than MOST_TABLES allow; with width 0 all vectors of a label meet. A pair that shares several tables counts in the first of them alone, which both
codes tell.

Buckets are compared as a whole; those larger than a block are dealt over pairs of blocks, for which a vector is sent once for each block
of its bucket. No pair leaves the task that finds it: a
task returns, for each of its vectors, how many links it has there and the smallest vector they
reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import components, cut, discard, partitions, runs, slices

LEAST_COSINE = 0.98
#: The rotations are fitted on at most so many vectors, those with the smallest hash of vec_id.
FIT_ROWS = 20_000
ITERATIONS = 40
RECALL = 0.999
#: The share of sampled vectors that may be nearer to the mean than the tables are meant for.
NEARER = 0.01
#: A number of dimensions with fewer vectors in the sample is coded without their mean.
LEAST_FIT = 256
MOST_TABLES = 64
#: Distinct vectors that a bucket is meant to hold, and those of a bucket that are compared together at most.
BUCKET, BLOCK = 24, 2048
#: Vectors of a block that meet all others at a time.
ROWS = 64


@dataclass
class Model:
    """For each number of dimensions: the mean and the projections (dimensions x bits)."""

    width: int
    tables: int
    parts: dict[int, tuple[np.ndarray, np.ndarray]]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The bits of each table as a number: a row for each unit vector."""
        mean, project = self.parts.get(x.shape[1]) or (np.zeros(x.shape[1]), directions(x.shape[1], self.width * self.tables))
        bits = ((x - mean) @ project > 0).reshape(len(x), self.tables, self.width)
        return bits @ (1 << np.arange(self.width, dtype=np.int64))


def directions(dims: int, bits: int) -> np.ndarray:
    """Random directions, for vectors whose number of dimensions the sample lacks."""
    return np.random.default_rng(dims).normal(size=(dims, bits))


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Iterative quantisation: the rotation of x's columns that brings its rows closest to their signs."""
    c = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(c, c)))[0]
    for _ in range(ITERATIONS):
        u, _, v = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
        r = (u @ v).T
    return r


def fit_part(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mean = x.mean(0) if len(x) >= LEAST_FIT else np.zeros(x.shape[1])
    values, axes = np.linalg.eigh(np.cov((x - mean).T).reshape(x.shape[1], x.shape[1]) if len(x) > 1 else np.eye(x.shape[1]))
    axes = axes[:, np.argsort(-values)]
    out, seed = [], 0
    while sum(p.shape[1] for p in out) < bits:
        out.append(axes @ rotated((x - mean) @ axes, seed))
        seed += 1
    return mean, np.concatenate([np.zeros((x.shape[1], 0)), *out], axis=1)[:, :bits]


def angle(x: np.ndarray, mean: np.ndarray, cosine: float) -> float:
    """Of pairs of unit vectors at that cosine, as seen from the mean: for those among x that are near it."""
    radius = np.quantile(np.linalg.norm(x - mean, axis=1), NEARER)
    return math.acos(max(-1.0, 1 - (1 - cosine) / max(radius, 1e-9) ** 2)) if cosine < 1 else 0.0


def tables_for(angle: float, width: int) -> tuple[int, int]:
    """(width, tables): of that width, or less, where the asked recall takes too many tables."""
    while width:
        p = (1 - angle / math.pi) ** width
        tables = 1 if p >= RECALL else math.ceil(math.log(1 - RECALL) / math.log1p(-p)) if p > 1e-9 else MOST_TABLES + 1
        if tables <= MOST_TABLES:
            return width, tables
        width -= 1
    return 0, 1


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(usable: DataFrame, n: int, cosine: float, rows: int) -> Model:
    """A model from a sample of usable(vec_id, embedding), for labels of at most n vectors."""
    width = max(8, round(math.log2(max(2, n / BUCKET))) + 1)
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("embedding").collect()
    by: dict[int, list] = {}
    for r in sample:
        by.setdefault(len(r["embedding"]), []).append(r["embedding"])
    units = {d: unit(v) for d, v in by.items()}
    centred = [angle(x, x.mean(0), cosine) for x in units.values() if len(x) >= LEAST_FIT]
    width, tables = tables_for(max([math.acos(cosine), *centred]), width)
    return Model(width, tables, {d: fit_part(x, width * tables) for d, x in units.items()})


def _spread(minimum: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest value that each row reaches over links i-j."""
    while True:
        low = np.minimum(minimum[i], minimum[j])
        new = minimum.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == minimum).all():
            return new
        minimum = new


def near_vectors(vectors: DataFrame, cosine: float = LEAST_COSINE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows are linked when their labels are equal and not null and the cosine of their embeddings
    is at least `cosine`. An embedding that is null, empty, all zero or has null or non-finite
    components links with nothing, and neither do embeddings of different lengths. n_links counts rows: a
    repeated row is one more. Rows that repeat a vec_id share the id's component. A row without
    a vec_id has links and no component of its own, and is kept when it has no links. Extra columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    n = partitions(spark)
    e = F.col("embedding")
    finite = e.isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(finite & F.col("label").isNotNull(), F.lit(False)).alias("usable"))
    usable = rows.where("usable")
    # rows with the same vector are one: their count goes with it
    distinct = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    distinct = cut(distinct.withColumn("node", F.monotonically_increasing_id()).select("node", "rep", "label", "embedding", "copies"), "vectors")
    largest = distinct.groupBy("label").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    model = fit(distinct.select(F.col("rep").alias("vec_id"), "embedding"), largest, cosine, fit_rows)
    # components go to the tasks as they are given, and are normalised there
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            lists = batch.column("embedding").to_pylist()
            length = np.array([len(v) for v in lists])
            for d in np.unique(length):
                at = np.flatnonzero(length == d)
                x = unit([lists[i] for i in at])
                part = batch.take(pa.array(at))
                yield pa.record_batch(
                    {
                        "node": part.column("node"),
                        "label": part.column("label"),
                        "copies": part.column("copies"),
                        "dims": pa.array(np.full(len(at), d), pa.int32()),
                        "codes": pa.array(list(model.codes(x)), pa.list_(pa.int64())),
                        "raw": pa.array([np.array(lists[i], kind).tobytes() for i in at], pa.binary()),
                    }
                )

    coded = distinct.mapInArrow(code, f"node long, label {dict(distinct.dtypes)['label']}, copies long, dims int, codes array<long>, raw binary")
    coded = cut(coded, "codes")
    key = ["label", "dims", "table", "bucket"]
    entries = coded.select("node", "label", "dims", F.posexplode("codes").alias("table", "bucket"))
    counted = entries.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    met = entries.join(counted, key).withColumn("own", block)
    # a block meets itself and every other one: block x stands in the pairs (x, y) for all y
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("node", *key, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    met = met.join(coded.select("node", "copies", "codes", "raw"), "node")
    met = met.repartition(2 * n, *key, "low", "high").sortWithinPartitions(*key, "low", "high", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for run in runs(batches, [*key, "low", "high"]):
            ids, copies, own = (run.column(k).to_numpy() for k in ("node", "copies", "own"))
            x = np.frombuffer(b"".join(run.column("raw").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            codes = np.stack(run.column("codes").to_pylist()).astype(np.int64)
            t = run.column("table")[0].as_py()
            split = run.column("low")[0].as_py() != run.column("high")[0].as_py()
            links, group = np.zeros(len(ids), np.int64), np.arange(len(ids))
            for at in range(0, len(ids), ROWS):
                near = x[at : at + ROWS] @ x[at:].T >= cosine - 1e-9
                if split:
                    near &= own[at : at + ROWS, None] != own[None, at:]
                i, j = np.nonzero(np.triu(near, 1))
                i, j = i + at, j + at
                first = ~(codes[i, :t] == codes[j, :t]).any(1)
                i, j = i[first], j[first]
                exact = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
                i, j = i[exact], j[exact]
                links += np.bincount(i, copies[j], len(ids)).astype(np.int64) + np.bincount(j, copies[i], len(ids)).astype(np.int64)
                ends = np.column_stack([group[i], group[j]])
                ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
                if len(ends):
                    group = _spread(np.arange(len(ids)), ends[:, 0], ends[:, 1])[group]
            some = np.flatnonzero(links)
            if len(some):
                # rows are in order of node: the first of a group is its smallest
                out.append((ids[some], links[some], ids[group[some]]))
                held += len(some)
            if held > 20_000:
                yield pa.record_batch(dict(zip(("node", "links", "low"), map(np.concatenate, zip(*out, strict=True)), strict=True)))
                out, held = [], 0
        if out:
            yield pa.record_batch(dict(zip(("node", "links", "low"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    found = cut(met.mapInArrow(compare, "node long, links long, low long"), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = cut(components(found.select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()), "classes")
    # nodes back to ids: the smallest id in the class
    named = distinct.select("node", "label", "embedding", "rep", "copies").join(classes.withColumnRenamed("id", "node"), "node", "left")
    named = named.withColumn("cls", F.coalesce("component_id", "node")).join(links, "node", "left")
    named = cut(named.select("node", "label", "embedding", "rep", "cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    least = named.groupBy("cls").agg(F.min("rep").alias("least"))
    known = named.join(least, "cls").select("label", "embedding", "n_links", "least")
    out = rows.join(known.withColumnRenamed("n_links", "found"), ["label", "embedding"], "left")
    out = out.select("vec_id", F.coalesce("found", F.lit(0)).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    # rows that repeat an id are one vector to the components
    out = cut(_merged(out), "near")
    discard(distinct, coded, found, classes, named)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0).alias("kept"))


def _merged(rows: DataFrame) -> DataFrame:
    """Where one vec_id stands in several components, these become one."""
    rows = cut(rows, "rows")
    split = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min("component_id").alias("low"), F.max("component_id").alias("high")).where("low <> high")
    if split.isEmpty():
        return rows
    pairs = rows.where("component_id is not null").select(F.col("vec_id").alias("a"), F.col("component_id").alias("b")).where("a is not null")
    joined = components(pairs).withColumnRenamed("component_id", "merged")
    return rows.join(joined, rows.component_id == joined.id, "left").select("vec_id", "n_links", F.coalesce("merged", "component_id").alias("component_id"))
