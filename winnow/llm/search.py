"""Ranked lexical search over bit-sliced Bloom signatures.

Index. Every document has a Bloom signature of its terms. A term that occurs tf times is put into it once for each of STEPS
that tf reaches, so that a signature also bounds how often a term occurs. Documents with signatures of one width form a block, and a block is
stored by slices: a bitmap over its documents for every bit of the signature. Blocks are made where the documents are read, without a
shuffle; they also keep each document's length and highest tf. The same pass counts, in how many documents each term occurs.

Search. The slices of a term's bits, combined, are a bitmap of the documents that may hold it: all that do, and a few more. What the
term can add to a document's score follows from its step, the document's length and the term's weight; summed over an item's terms this is
an upper bound of the score. The documents with the highest bounds are scored exactly, which gives a score that the last of
the best must have. All documents whose bound reaches it are then scored exactly, from their whole texts; the others are proven
to be lower. So the result is that of scoring all.

Items are taken in blocks of ITEMS, as rows of a table that may grow; what goes to the tasks or to the driver is one block of items.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import cut, discard, slices
from winnow.llm.shingles import mix, powers

#: The terms of lower-cased bytes: letters and digits of ASCII, and everything beyond it.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: How often a term occurs, in steps: a term is in the signature once for each that it reaches.
STEPS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128], np.int64)
#: Bits of a signature for each of its entries at least, bits that an entry sets, the narrowest signature.
BITS, SET, NARROW = 8, 3, 9
#: Documents of a block at most, and bits of a block where signatures are wide; terms whose bounds are held together.
BLOCK, BLOCK_BITS, TERMS = 2048, 1 << 23, 1024
#: Items that are searched together, and documents of each that are scored first, in multiples of the result.
ITEMS, FIRST = 256, 3
#: Distinct terms that a task counts before it hands them on, and terms of a row of counts.
COUNTED, ROW = 500_000, 8192
#: Parts into which documents are told apart before their texts are moved.
PARTS = 1 << 16
_TERM = np.zeros(256, bool)
_TERM[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True
_C = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = "width int, doc_ids array<long>, keys array<long>, lengths array<long>, highest array<long>, slices binary, terms array<long>, counts array<long>, n_docs long, n_terms long"


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() is for A-Z alone


def term_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of lower-cased texts in a row, and how many each text has."""
    buf = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    inside = _TERM[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.append(0, edge)
    start, end = edge[::2], edge[1::2]  # the buffer ends with a space
    pw, inverse = powers(len(buf) + 1)
    total = np.append(np.uint64(0), np.cumsum(buf.astype(np.uint64) * pw[: len(buf)]))
    found = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _C)
    ends = np.cumsum([len(r) + 1 for r in raws])
    return found, np.diff(np.append(0, np.searchsorted(start, ends)))


def bits_of(term: np.ndarray, step: np.ndarray | int, width: int) -> np.ndarray:
    """The bits that terms set at a step, in signatures of 2**width bits: a row for each."""
    h = mix(term + np.asarray(step).astype(np.uint64) * _C)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(j) * high) & np.uint64((1 << width) - 1) for j in range(SET)], 1).astype(np.int64)


def room(width: int) -> int:
    """Documents of a block whose signatures have 2**width bits."""
    return max(8, min(BLOCK, BLOCK_BITS >> width))


class _Open:
    """A block that is being filled: documents, and the entries of their signatures."""

    def __init__(self) -> None:
        self.rows: list[tuple[int | None, int, int, int]] = []
        self.entries: list[tuple[np.ndarray, np.ndarray]] = []


def _steps(tf: np.ndarray) -> np.ndarray:
    return np.searchsorted(STEPS, tf, side="right")


def _row(**columns) -> pa.RecordBatch:
    kinds = {"width": pa.int32(), "slices": pa.binary(), "n_docs": pa.int64(), "n_terms": pa.int64()}
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.record_batch({k: pa.array([columns.get(k)], kinds.get(k, pa.list_(pa.int64()))) for k in names})


def _sliced(block: _Open, width: int) -> pa.RecordBatch:
    n = len(block.rows)
    planes = np.zeros((1 << width, -(-n // 8)), np.uint8)
    for d, (term, tf) in enumerate(block.entries):
        s = _steps(tf)
        step = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        at = bits_of(np.repeat(term, s), step, width).ravel()
        planes[at, d >> 3] |= np.uint8(128 >> (d & 7))  # one document, so repeats set the same bit
    ids, keys, lengths, highest = (list(c) for c in zip(*block.rows, strict=True))
    return _row(width=width, doc_ids=ids, keys=keys, lengths=lengths, highest=highest, slices=planes.tobytes(), n_docs=sum(x > 0 for x in lengths), n_terms=sum(lengths))


def _counted(seen: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    terms, at = np.unique(np.concatenate(seen), return_inverse=True)
    return terms, np.bincount(at, weights=np.concatenate(sums), minlength=len(terms)).astype(np.int64)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, _Open] = {}
    seen: list[np.ndarray] = []
    sums: list[np.ndarray] = []
    held = 0

    def counts(terms: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(terms), ROW):
            yield _row(terms=terms[at : at + ROW].view(np.int64), counts=n[at : at + ROW])

    for batch in slices(batches):
        raws = [lowered(t) for t in batch.column("text").to_pylist()]
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
        found, sizes = term_hashes(raws)
        ends = np.cumsum(sizes).tolist()
        for i, (end, n) in enumerate(zip(ends, sizes.tolist(), strict=True)):
            term, tf = np.unique(found[end - n : end], return_counts=True)
            need = max(1, int(_steps(tf).sum()) * BITS)
            width = max(NARROW, (need - 1).bit_length())
            block = blocks.setdefault(width, _Open())
            block.rows.append((ids[i], keys[i], n, int(tf.max()) if n else 0))
            block.entries.append((term, tf))
            if len(block.rows) == room(width):
                yield _sliced(blocks.pop(width), width)
            seen.append(term)
            sums.append(np.ones(len(term)))
            held += len(term)
        if held > COUNTED:
            terms, n = _counted(seen, sums)
            seen, sums, held = [terms], [n], len(terms)
            if held > COUNTED:
                yield from counts(terms, n)
                seen, sums, held = [], [], 0
    for width, block in blocks.items():
        yield _sliced(block, width)
    if seen:
        yield from counts(*_counted(seen, sums))


def index(docs: DataFrame) -> DataFrame:
    """A written table of blocks (width, doc_ids, keys, lengths, highest, slices, n_docs, n_terms) and of counted terms (terms, counts).

    A key is a hash of a text, which tells rows that repeat a doc_id apart. The pass has no shuffle, and a task holds one open block of each width.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.xxhash64("text").alias("key"), "text")
    return cut(rows.mapInArrow(_indexed, _BLOCK), "signatures")


class Items:
    """A block of items: their terms with repeats, and what follows from the index's counts."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        self.terms = [Counter(TERM.findall(lowered(t))) for _, t in items]
        self.vocabulary = sorted(set().union(*self.terms))
        self.hashes = term_hashes([b" ".join(self.vocabulary)])[0] if self.vocabulary else np.empty(0, np.uint64)
        self.place = {t: i for i, t in enumerate(self.vocabulary)}

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        """n_docs: documents with a term; n_terms: their terms; df: by hash, the documents that hold a term."""
        self.n_docs, self.n_terms = n_docs, n_terms
        w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(h, 0) + 1))) for h in self.hashes.view(np.int64).tolist()]
        self.weights = np.array(w, np.int64)
        self.of = [(np.array([self.place[t] for t in c], np.int64), np.array([w[self.place[t]] * k for t, k in c.items()], np.int64)) for c in self.terms]

    def norm(self, n: int) -> int:
        """A document's m for its length."""
        return 100 - 25 + (25 * n * self.n_docs) // self.n_terms

    def batches(self) -> Iterator[list[int]]:
        """Numbers of items that together have about TERMS distinct terms at most."""
        some: list[int] = []
        have: set[int] = set()
        for i, (place, _) in enumerate(self.of):
            more = have | set(place.tolist())
            if some and len(more) > TERMS:
                yield some
                some, more = [], set(place.tolist())
            some.append(i)
            have = more
        if some:
            yield some

    def bounds(self, width: int, lengths: np.ndarray, highest: np.ndarray, planes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, the upper bounds of all documents of a block)."""
        n = len(lengths)
        m = np.array([self.norm(x) for x in lengths.tolist()], np.int64)
        # what a term adds at each step, for each weight: it occurs less often than the next step, and than the document's most frequent term
        most = np.minimum(np.append(STEPS[1:] - 1, np.iinfo(np.int32).max)[:, None], highest[None, :])
        adds = np.concatenate([np.zeros((1, n), np.int64), (1_000_000_000 * most) // np.maximum(1000 * most + 12 * m[None, :], 1)])
        for some in self.batches():
            used = np.unique(np.concatenate([self.of[i][0] for i in some]))
            step = np.zeros((len(used), n), np.int8)
            live, inside = np.arange(len(used)), None
            for s in range(len(STEPS)):
                at = bits_of(self.hashes[used[live]], s, width)
                hit = planes[at[:, 0]]
                for j in range(1, SET):
                    hit &= planes[at[:, j]]
                if inside is not None:
                    hit &= inside
                some_left = hit.any(1)
                live, inside = live[some_left], hit[some_left]
                if not len(live):
                    break
                step[live] += np.unpackbits(inside, axis=1, count=n).astype(np.int8)
            each = np.take_along_axis(adds, step.astype(np.int64), axis=0)
            for i in some:
                place, w = self.of[i]
                yield i, w @ each[np.searchsorted(used, place)] if len(place) else np.zeros(n, np.int64)

    def score(self, raw: bytes, wanted: list[int]) -> list[int]:
        """The exact scores of a lower-cased text for some items."""
        found = TERM.findall(raw)
        tf, m = Counter(found), self.norm(len(found))
        out = []
        for i in wanted:
            total = 0
            for t, k in self.terms[i].items():
                if n := tf.get(t, 0):
                    total += k * int(self.weights[self.place[t]]) * ((1_000_000_000 * n) // (1000 * n + 12 * m))
            out.append(total)
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """width, doc_ids, keys, lengths, highest and slices of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            width = batch.column("width")[k].as_py()
            ids, keys, lengths, highest = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) if c != "doc_ids" else batch.column(c)[k].values for c in ("doc_ids", "keys", "lengths", "highest"))
            planes = np.frombuffer(batch.column("slices")[k].as_buffer(), np.uint8).reshape(1 << width, -1)
            yield width, ids, keys, lengths, highest, planes


_PAIRS = "item int, doc_id long, key long, bound long"


def _pairs(item: np.ndarray, ids: pa.Array, keys: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"item": pa.array(item, pa.int32()), "doc_id": ids, "key": pa.array(keys, pa.int64()), "bound": pa.array(bound, pa.int64())})


def highest(found: DataFrame, items: Items, count: int) -> DataFrame:
    """item, doc_id, key, bound of the documents with the highest bounds: count of each item and task at least."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, pa.Array, np.ndarray]] = {}
        for width, ids, keys, lengths, most, planes in _blocks(batches):
            for i, bound in items.bounds(width, lengths, most, planes):
                top = np.argpartition(-bound, count - 1)[:count] if len(bound) > count else np.arange(len(bound))
                top = top[bound[top] > 0]
                if not len(top):
                    continue
                b, d, k = bound[top], ids.take(pa.array(top)), keys[top]
                if i in best:
                    b, d, k = np.append(best[i][0], b), pa.concat_arrays([best[i][1], d]), np.append(best[i][2], k)
                    if len(b) > 4 * count:
                        at = np.argpartition(-b, count - 1)[:count]
                        b, d, k = b[at], d.take(pa.array(at)), k[at]
                best[i] = b, d, k
        for i, (b, d, k) in best.items():
            yield _pairs(np.full(len(b), i), d, k, b)

    return found.mapInArrow(step, _PAIRS)


def reaching(found: DataFrame, items: Items, least: dict[int, int]) -> DataFrame:
    """item, doc_id, key, bound of all documents whose bound is least[item] or more."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, ids, keys, lengths, most, planes in _blocks(batches):
            for i, bound in items.bounds(width, lengths, most, planes):
                at = np.flatnonzero(bound >= least.get(i, 1))
                if len(at):
                    yield _pairs(np.full(len(at), i), ids.take(pa.array(at)), keys[at], bound[at])

    return found.mapInArrow(step, _PAIRS)


def rescored(docs: DataFrame, pairs: DataFrame, items: Items, few: bool = False) -> DataFrame:
    """item, doc_id, score of the rows of docs that pairs(item, doc_id, key) names, from their whole texts.

    Few pairs, as many as a block of items has first documents, go to the texts. Else only the texts of the named documents' parts are
    moved, and the list of parts has PARTS rows at most.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            item, at, score = [], [], []
            for k, (text, wanted) in enumerate(zip(batch.column("text").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                item += wanted
                at += [k] * len(wanted)
                score += items.score(lowered(text), wanted)
            yield pa.record_batch({"item": pa.array(item, pa.int32()), "doc_id": batch.column("doc_id").take(pa.array(at, pa.int64())), "score": pa.array(score, pa.int64())})

    part = F.pmod(F.xxhash64("doc_id", "key"), F.lit(PARTS)).cast("int")
    asked = pairs.groupBy("doc_id", "key").agg(F.collect_set("item").alias("items")).select(F.col("doc_id").alias("asked"), F.col("key").alias("asked_key"), "items", part.alias("asked_part"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", F.xxhash64("text").alias("key")).withColumn("part", part)
    near = rows if few else rows.join(F.broadcast(asked.select(F.col("asked_part").alias("part")).distinct()), "part", "left_semi")
    asked = F.broadcast(asked) if few else asked
    same = F.col("doc_id").eqNullSafe(F.col("asked")) & (F.col("key") == F.col("asked_key")) & (F.col("part") == F.col("asked_part"))
    return near.join(asked, same).select("doc_id", "text", "items").mapInArrow(step, "item int, doc_id long, score long")


def _best(scored: DataFrame, by: str, count: int, *more: str) -> DataFrame:
    """The count rows of each item with the highest `by`; ties by doc_id, null first. rank: from 1."""
    order = Window.partitionBy("item").orderBy(F.desc(by), "doc_id", *more)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def search(docs: DataFrame, queries: DataFrame, count: int = 20, found: DataFrame | None = None) -> DataFrame:
    """The best documents of each of queries(item_id, text): item_id, rank (from 1), doc_id, score.

    count documents at most, with a score above 0, highest first; equal scores stand by doc_id, null first. A null text has no terms.
    Rows that repeat a doc_id are documents of their own, and so are equal rows; items that repeat an item_id are
    answered each. Extra columns are ignored; without documents or items there are no rows. found: the index of docs, where there is one.
    """
    spark = docs.sparkSession
    own = found is None
    found = index(docs) if own else found
    blocks = found.where("width is not null").select("width", "doc_ids", "keys", "lengths", "highest", "slices", "n_docs", "n_terms")
    terms = found.where("terms is not null").select("terms", "counts")
    total = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t")).first()
    df = terms.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("h"), F.col("x.counts").alias("n"))
    rows = cut(queries.select("item_id", "text"), "items")
    done = []
    some: list[tuple[int | None, str | None]] = []

    def answer() -> DataFrame:
        items = Items(some)
        wanted = spark.createDataFrame(pa.table({"h": pa.array(items.hashes.view(np.int64))}))
        # one block's terms
        counted = df.join(F.broadcast(wanted), "h").groupBy("h").agg(F.sum("n").alias("n")).collect()
        items.weigh(total["n"] or 0, max(total["t"] or 0, 1), {r["h"]: r["n"] for r in counted})
        first = cut(_best(highest(blocks, items, FIRST * count), "bound", FIRST * count, "key").drop("rank"), "first")
        known = _best(rescored(docs, first, items, few=True).where("score > 0"), "score", count).where(F.col("rank") == count)
        least = {r["item"]: r["score"] for r in known.select("item", "score").collect()}
        pairs = cut(reaching(blocks, items, least), "candidates")
        best = _best(rescored(docs, pairs, items).where("score > 0"), "score", count)
        names = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
        out = cut(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "best")
        discard(first, pairs)
        return out

    for r in rows.toLocalIterator():
        some.append((r["item_id"], r["text"]))
        if len(some) == ITEMS:
            done.append(answer())
            some = []
    if some:
        done.append(answer())
    discard(rows, *([found] if own else []))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for d in done:
        out = out.union(d)
    return out
