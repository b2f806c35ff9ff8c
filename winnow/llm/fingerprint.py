"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraphs, each a 64-bit digest. Every digest is put into three cells of
a small table; a cell keeps how many digests it got, their sum and the sum of their checks.
Two versions' tables subtract cell by cell: what both hold cancels out, and peeling cells that
hold one digest recovers those that only one has. Where the difference is too large for the
table, peeling gets stuck, and both texts are sketched again with a table four times as large, or as many
times four as the spread of the counts asks for, and other cells, until it succeeds.

A fingerprint is the smallest table as text, with the number of paragraphs: the first attempt reads both tables
back from the fingerprints.

Paragraphs are lines, cut by content alone wherever the last three code points have a hash that ends a piece, which about one place in
MEAN does in any language and at any length of the line or text; between two
cuts there are at most PIECE code points. The second, third, ... occurrence of a paragraph counts as another one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import partitions

#: Cells of a third of the first table; those of the next are four times as many.
FIRST_CELLS = 8
#: Code points of a piece at most, and on average: a power of two.
PIECE, MEAN = 256, 8
#: Digests for each cell up to which tables mostly peel.
FILLED = 0.7
#: Texts that are sketched together.
BATCH = 128
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * C1
    x = (x ^ (x >> np.uint64(29))) * C2
    return x ^ (x >> np.uint64(32))


def paragraphs(text: str) -> list[str]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    line = points == 10
    cut = line.copy()
    if len(points) > 2:
        last = mix(points[2:] * C1 + points[1:-1] * C2 + points[:-2])
        cut[2:] |= (last & np.uint64(MEAN - 1)) == 0
    ends = np.append(np.flatnonzero(cut) + 1, len(points)).tolist()
    out, start = [], 0
    for end in ends:
        while end - start > PIECE:
            out.append(text[start : start + PIECE])
            start += PIECE
        if end > start:
            out.append(text[start:end])
        start = end
    return [x for x in out if x != "\n"]


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, text number) of every paragraph; occurrences of one paragraph in a text get keys of their own."""
    parts = [paragraphs(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    key = np.fromiter((xxhash.xxh3_64_intdigest(x) for p in parts for x in p), np.uint64, len(owner))
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    nth = (np.arange(len(key)) - start).astype(np.uint64)
    return np.where(nth > 0, mix(key ^ nth, 77), key), owner


def cells_of(key: np.ndarray, size: int) -> np.ndarray:
    """The three cells of each key, one in each third of the table. Tables of another size have other cells."""
    return np.stack([mix(key, 3 * size + j) % np.uint64(size) + np.uint64(j * size) for j in range(3)]).astype(np.int64)


def sketches(key: np.ndarray, owner: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums of keys and sums of checks: a row for each of n texts."""
    width = 3 * size
    count, total, check = np.zeros(n * width, np.int64), np.zeros(n * width, np.uint64), np.zeros(n * width, np.uint64)
    at = cells_of(key, size) + owner * width
    checks = mix(key, 5)
    for j in range(3):
        count += np.bincount(at[j], minlength=n * width)
        np.add.at(total, at[j], key)
        np.add.at(check, at[j], checks)
    return count.reshape(n, width), total.reshape(n, width), check.reshape(n, width)


def peel(count: np.ndarray, total: np.ndarray, check: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The digests that come out of rows of subtracted tables: (row, digest, 1 for those of the first or -1 for those of the second, whether all of a row came out)."""
    n, width = count.shape
    count, total, check = count.ravel().copy(), total.ravel().copy(), check.ravel().copy()
    rows, keys, signs = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    live = np.flatnonzero(np.abs(count) == 1)
    while len(live):
        sign = count[live]
        key = np.where(sign > 0, total[live], np.uint64(0) - total[live])
        want = np.where(sign > 0, check[live], np.uint64(0) - check[live])
        row = live // width
        pure = (mix(key, 5) == want) & (cells_of(key, size) == live - row * width).any(0)
        row, key, sign = row[pure], key[pure], sign[pure]
        if not len(row):
            break
        order = np.lexsort((key, row))
        row, key, sign = row[order], key[order], sign[order]
        new = np.ones(len(row), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        row, key, sign = row[new], key[new], sign[new]
        rows.append(row)
        keys.append(key)
        signs.append(sign)
        at = cells_of(key, size) + row * width
        by = np.where(sign > 0, key, np.uint64(0) - key)
        checks = mix(key, 5)
        checks = np.where(sign > 0, checks, np.uint64(0) - checks)
        for j in range(3):
            np.subtract.at(count, at[j], sign)
            np.subtract.at(total, at[j], by)
            np.subtract.at(check, at[j], checks)
        touched = at.ravel()  # with repeats, which meet again above
        live = touched[np.abs(count[touched]) == 1]
    left = (count != 0) | (total != 0) | (check != 0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(signs), ~left.reshape(n, width).any(1)


def difference(a: str, b: str) -> tuple[set[int], set[int]]:
    """The digests of paragraphs that only the text a and only the text b has, recovered from their subtracted sketches."""
    s = Sketched([a, b])
    [(x, y)] = s.differences(np.array([0]), np.array([1]))
    return set(x.tolist()), set(y.tolist())


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Shared paragraphs out of all that either text has, for pairs of texts: what subtracting and peeling their sketches gives."""
    return Sketched(a + b).likeness(np.arange(len(a)), np.arange(len(b)) + len(a))


class Sketched:
    """Texts with their digests; sketches of any size on demand."""

    def __init__(self, texts: list[str]):
        self.key, self.owner = digests(texts)
        self.n = np.bincount(self.owner, minlength=len(texts))
        self.start = np.append(0, np.cumsum(self.n))

    def some(self, which: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = self.n[which]
        owner = np.repeat(np.arange(len(which)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[which], n)
        return sketches(self.key[at], owner, len(which), size)

    def fingerprints(self) -> list[str]:
        """The smallest sketches, with the number of paragraphs, as text."""
        count, total, check = self.some(np.arange(len(self.n)), FIRST_CELLS)
        raw = np.concatenate([self.n[:, None].astype("<u4").view("u1"), count.astype("<u4").view("u1"), total.astype("<u8").view("u1"), check.astype("<u8").view("u1")], axis=1)
        return [base64.b64encode(r.tobytes()).decode() for r in raw]

    def likeness(self, a: np.ndarray, b: np.ndarray, prints: list[str] | None = None) -> np.ndarray:
        """Of the texts a to the texts b: from how many digests each of them has by itself. The smallest sketches are read from the fingerprints, where they are given."""
        out = np.ones(len(a))
        for k, (only_a, only_b) in enumerate(self.differences(a, b, prints)):
            union = self.n[a[k]] + len(only_b)
            if union:
                out[k] = (self.n[a[k]] - len(only_a)) / union
        return out

    def differences(self, a: np.ndarray, b: np.ndarray, prints: list[str] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """The digests that only a text of a, and only the text of b beside it has, peeled out of their subtracted sketches."""
        none = np.empty(0, np.uint64)
        out = [(none, none)] * len(a)
        known = read(prints) if prints else None
        sizes = np.full(len(a), FIRST_CELLS)
        todo = np.arange(len(a))
        while len(todo):
            size = int(sizes[todo].min())
            now = todo[sizes[todo] == size]
            stuck = [todo[sizes[todo] > size]]
            rows = max(1, 400_000 // (3 * size))
            for at in range(0, len(now), rows):
                some = now[at : at + rows]
                x, y = ([k[w[some]] for k in known[1:]] if known and size == FIRST_CELLS else self.some(w[some], size) for w in (a, b))
                count = x[0] - y[0]
                row, key, sign, done = peel(count, x[1] - y[1], x[2] - y[2], size)
                order = np.lexsort((-sign, row))
                row, key, sign = row[order], key[order], sign[order]
                # of each row first what the first text has
                start = np.searchsorted(2 * row + (sign < 0), np.arange(2 * len(some) + 1))
                for k in np.flatnonzero(done).tolist():
                    out[some[k]] = key[start[2 * k] : start[2 * k + 1]], key[start[2 * k + 1] : start[2 * k + 2]]
                left = some[~done]
                sizes[left] = next_size(count[~done], size)
                stuck.append(left)
            todo = np.concatenate(stuck)
        return out


def next_size(count: np.ndarray, size: int) -> np.ndarray:
    """The sizes to try after subtracted counts that did not peel: four times as large, or as many times four as their spread says is needed.

    A cell's count is spread by the digests in it, whichever text they are from, and is off zero by how many more one text has.
    """
    spread = (count.astype(float) ** 2).mean(1) - count.mean(1) ** 2
    needed = np.maximum(spread * size / (3 * FILLED), 1.0)
    steps = np.maximum(1, np.ceil(np.log(needed / size) / np.log(4)))
    return (size * 4.0**steps).astype(np.int64)


def read(prints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of paragraphs, counts, sums of keys and sums of checks of fingerprints."""
    width = 3 * FIRST_CELLS
    raw = np.frombuffer(b"".join(map(base64.b64decode, prints)), np.uint8).reshape(len(prints), 4 + width * 20)
    part = lambda a, b, kind: np.ascontiguousarray(raw[:, a:b]).view(kind)
    at = 4 + 4 * width
    return part(0, 4, "<u4").ravel().astype(np.int64), part(4, at, "<u4").astype(np.int64), part(at, at + 8 * width, "<u8"), part(at + 8 * width, at + 16 * width, "<u8")


def edited(text: str, following: str) -> str:
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def fingerprint_edits(docs: DataFrame, buckets_per_partition: int = 4) -> DataFrame:
    """The fingerprints of every text and of its edited version, and their likeness.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The next document is that with the next larger doc_id; after the last comes
    the first; of a single document it is itself. Rows with one doc_id stand in order of
    their texts; a null doc_id comes first. A null text is empty; two texts without paragraphs are alike
    (1.0). Extra columns are ignored; an empty table gives no rows.

    The rows are dealt over ranges of doc_id, more than there are tasks, found from
    approximate quantiles of doc_id; each range also gets the first row of the next. One
    shuffle carries the texts, and each task reads its ranges in order, holding BATCH texts.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = partitions(spark)
    probs = [i / (n * buckets_per_partition) for i in range(1, n * buckets_per_partition)]
    ids = rows.select("doc_id")
    bounds = np.array(sorted(set(ids.approxQuantile("doc_id", probs, 0.25 / len(probs)))), np.int64)

    @F.pandas_udf("int")
    def bucket_of(doc_id: pd.Series) -> pd.Series:
        null = doc_id.isna().to_numpy()
        at = np.searchsorted(bounds, doc_id.fillna(-(2**63)).to_numpy().astype(np.int64), side="right")
        return pd.Series(np.where(null, 0, at).astype(np.int32))

    # one row for each bucket, and there are as many buckets as asked for: a proven bound
    firsts = ids.select(bucket_of("doc_id").alias("bucket"), "doc_id").groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id")).alias("m")).orderBy("bucket").collect()
    buckets = [r["bucket"] for r in firsts]
    heads = [(r["bucket"], r["m"]["doc_id"], buckets[i - 1]) for i, r in enumerate(firsts)]
    head = spark.createDataFrame(heads, "head_bucket int, head_id long, before int")
    placed = rows.withColumn("bucket", bucket_of("doc_id"))
    here = placed.select("bucket", F.lit(0).alias("tail"), "doc_id", "text")
    tails = rows.join(F.broadcast(head), F.col("doc_id").eqNullSafe(F.col("head_id"))).select(F.col("before").alias("bucket"), F.lit(1).alias("tail"), "doc_id", "text")
    dealt = here.union(tails).repartition(n, "bucket").sortWithinPartitions("bucket", "tail", "doc_id", "text")

    def compare(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Of all but the last text, which only follows."""
        m = len(ids)
        changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        s = Sketched(texts + changed)
        prints = s.fingerprints()
        at = np.arange(m)
        return pa.record_batch(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                "fingerprint": pa.array(prints[:m]),
                "edited_fingerprint": pa.array(prints[m + 1 :]),
                "near_edited": s.likeness(at, at + m + 1, prints),
                "near_next": s.likeness(at, at + 1, prints),
            }
        )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        bucket, ended, held = None, False, 0
        for batch in batches:
            for b, tail, i, t in zip(*(batch.column(k).to_pylist() for k in ("bucket", "tail", "doc_id", "text")), strict=True):
                if b != bucket:
                    bucket, ended, ids, texts, held = b, False, [], [], 0
                if ended:
                    continue
                ids.append(i)
                texts.append(t)
                held += len(t)
                ended = tail == 1
                if ended or len(ids) > BATCH or held > 4_000_000 and len(ids) > 1:
                    yield compare(ids[:-1], texts)
                    ids, texts, held = ids[-1:], texts[-1:], len(t)

    return dealt.mapInArrow(step, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
