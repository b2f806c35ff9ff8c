"""Quality by compression: dictionaries of good and of bad text, and which of them fits a text better.

A zstandard dictionary is trained on texts labelled good, another on texts labelled bad. A
text is compressed, piece by piece, with each and without any; the difference of the compressed sizes, divided
by the text's size, tells which kind it resembles. A logistic curve, fitted on labelled texts
that went into neither dictionary, turns the difference into a probability; where the curve stands depends on how far the
text compresses without a dictionary, as both dictionaries fit mere repetition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import cut, discard, partitions, slices

#: The classifier is fitted on at most so many labelled texts of each class, which are whole, of any length.
FIT_ROWS = 4000
#: One in so many of them goes into the dictionaries, the others fit the curve.
DICTIONARY_SHARE = 4
#: Bytes of a dictionary, and pieces of texts of a class that it is trained on at most.
DICTIONARY_BYTES, TRAIN_PIECES = 400_000, 4096
#: The window holds a dictionary and what follows of a text; left to itself, it would depend on the sizes of both.
LEVEL, WINDOW_LOG = 6, 20
#: Bytes of a text that are compressed together, at most: of a longer text all pieces, which are of one size, meet the dictionaries.
PIECE = 2048
#: The size, in bytes, by which short texts are held to the middle.
SOFTEN = 8.0


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that labels may be learned from: crc32 of the doc_id as text is not 1 modulo 3."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        settings = {"window_log": WINDOW_LOG, "write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}
        out = [zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, **settings))]
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(raw), **settings)
            d.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        return out

    def score(self, sizes: np.ndarray) -> np.ndarray:
        x = (features(sizes) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(x)), x]) @ self.weights, -30, 30)))


def pieces(text: str) -> list[bytes]:
    """A text in pieces of one size, of at most PIECE bytes."""
    raw = text.encode()
    n = max(1, -(-len(raw) // PIECE))
    ends = [len(raw) * i // n for i in range(n + 1)]
    return [raw[i:j] for i, j in zip(ends, ends[1:], strict=False)]


def measured(texts: list[str], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes of each text: raw, compressed without a dictionary, with the good one, with the bad one; the average of its pieces."""
    out = []
    for parts in map(pieces, texts):
        sizes = [sum(map(len, parts)), *(sum(len(c.compress(p)) for p in parts) for c in compressors)]
        out.append([x / len(parts) for x in sizes])
    return np.array(out, float).reshape(-1, 1 + len(compressors))


def features(sizes: np.ndarray) -> np.ndarray:
    """By how much the good dictionary is the better one, and what is left of the text without either, both for each byte."""
    n, plain, good, bad = sizes.T
    return np.column_stack([(bad - good) / (n + SOFTEN), plain / (n + SOFTEN)])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression with an intercept, by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    hold = ridge * np.diag([0.0, *[1.0] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * np.maximum(p * (1 - p), 1e-6)[:, None]) + hold + 1e-9 * np.eye(len(w)), a.T @ (y - p) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples; their own bytes, where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(samples)[-DICTIONARY_BYTES:] or b" " * 64


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from at most `rows` labelled texts of each class, those with the smallest hash of doc_id.

    One in DICTIONARY_SHARE of them makes the dictionaries, the others the curve. Of a doc_id with several labels or texts the smallest
    counts; rows without a text, a doc_id or a label are left out. With fewer than two texts for each dictionary in either
    class the score is that class's share, or one half without labels.
    """
    marked = learnable(labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")).groupBy("doc_id").agg((F.min("quality") == 1).cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    texts = learnable(docs.select("doc_id", "text").where("text is not null"))
    hashed = F.xxhash64("doc_id")
    # somewhat more ids than needed, as not every labelled row is in docs
    ids = [marked.where(F.col("quality") == q).where(F.pmod(hashed, F.lit(max(1, counts.get(q, 0)))) < 2 * rows).limit(3 * rows) for q in (0, 1)]
    # at most so many ids: small enough to broadcast, whatever the table's size
    found = texts.join(F.broadcast(ids[0].union(ids[1])), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("quality").orderBy(hashed, "doc_id")) - 1
    sample = cut(found.withColumn("nth", nth).where(F.col("nth") < rows), "labelled")
    mine = F.col("nth") % DICTIONARY_SHARE == 0

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            parts = [pieces(t) for t in part.column("text").to_pylist()]
            yield pa.record_batch({"quality": np.repeat(part.column("quality").to_numpy(), [len(p) for p in parts]), "piece": pa.array([x for p in parts for x in p], pa.binary())})

    cuts = sample.where(mine).select("quality", "text").mapInArrow(cut_up, "quality int, piece binary")
    first = lambda q: [r["piece"] for r in cuts.where(F.col("quality") == q).orderBy(F.xxhash64("piece"), "piece").limit(TRAIN_PIECES).collect()]
    model = Model(dictionary(first(1)), dictionary(first(0)), np.zeros(2), np.ones(2), np.zeros(3))
    taken = {r["quality"]: r["n"] for r in sample.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if min(taken.get(0, 0), taken.get(1, 0)) < 2 * DICTIONARY_SHARE:
        total = counts.get(0, 0) + counts.get(1, 0)
        share = counts.get(1, 0) / total if total else 0.5
        model.weights[0] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        discard(sample)
        return model

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for part in slices(batches, 64):
            sizes = measured(part.column("text").to_pylist(), compressors)
            yield pa.record_batch({"quality": part.column("quality"), "nth": part.column("nth"), "sizes": pa.array(list(sizes), pa.list_(pa.float64()))})

    # a few numbers for each of at most 2 * rows texts
    rest = sample.where(~mine).select("quality", "nth", "text").repartition(partitions(docs.sparkSession), "nth")
    seen = rest.mapInArrow(measure, "quality int, nth int, sizes array<double>").orderBy("quality", "nth").collect()
    x, y = features(np.array([r["sizes"] for r in seen])), np.array([float(r["quality"]) for r in seen])
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = logistic((x - model.mean) / model.scale, y)
    # the classes were taken in equal numbers: the intercept gets the labels' own odds back
    model.weights[0] += np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    discard(sample)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its whole text alone.

    A null text counts as empty, and empty texts get the score of no bytes. Repeated rows and a
    null doc_id (not held out) are rows like others; extra columns are ignored; an empty table
    gives no rows.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for part in slices(batches):
            p = model.score(measured(part.column("text").to_pylist(), compressors))
            yield pa.record_batch({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": p, "predicted": pa.array((p >= 0.5).astype(np.int32))})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(step, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text is predicted good, with the columns they have. A null text counts as empty; an empty table gives no rows."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for part in slices(batches):
            p = model.score(measured([t or "" for t in part.column("text").to_pylist()], compressors))
            yield part.filter(pa.array(p >= 0.5))

    return docs.mapInArrow(step, docs.schema)
