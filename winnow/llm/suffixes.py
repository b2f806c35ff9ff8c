"""Repeated strings across documents by induced sorting of sampled suffixes.

A byte goes when a string of LENGTH bytes that covers it also starts in a document with a
smaller doc_id. The strings are judged by the order of their suffixes:

1. Sampling. In every string of LENGTH bytes one position is sampled by content alone: that of
   its smallest hashed gram of GRAM bytes. Equal strings are sampled at the same place. A
   sampled suffix stands for the run of strings that chose it: those that start `low` to `high`
   bytes before it. Grams that only one text has are set aside: no string with such a sample
   occurs elsewhere.
2. Sorting. The sampled suffixes of a gram, with their right context, are sorted by Spark's
   external sort in shards far larger than memory; equal tuples are merged before, each keeping
   its smallest doc_id. Reading them in order gives the common prefix of neighbours.
3. Induction. The order of the suffixes that start one byte further left follows from the order
   at hand: a stable distribution by the preceding byte. Common prefixes come along: within one
   preceding byte, 1 and the least of those in between. After each step, neighbours with a common
   prefix of LENGTH or more are one string, whose smallest doc_id is noted. As strings have LENGTH bytes,
   LENGTH - GRAM steps end the recursion; each batch of tuples is a queue that these steps empty.
   A gram with more tuples than a queue may hold is split: the first and the second half of its steps each go by a
   longer string that all their strings have in common, and are sorted and induced like grams; and so on by halves, until a part has
   one string.
4. What was noted goes back to all occurrences of the tuples, and the spans to the texts.

Texts with the same bytes are one: all copies but the smallest doc_id go as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import cut, discard, free_names, partitions, runs, slices
from winnow.llm.shingles import mix, pieces

LENGTH, GRAM = 50, 16
SPAN = LENGTH - GRAM
#: Sampled suffixes a shard of the first shuffle is meant to hold.
SHARD = 1_000_000
#: Tuples that are induced together, and those of one gram at most: more common grams are split.
QUEUE, HEAVY = 50_000, 300_000
#: Bytes of texts whose samples are looked for together.
CHUNK = 1 << 20


class Samples:
    """The sampled positions of texts: which text, where in it, and the strings that chose each."""

    def __init__(self, raw: list[bytes]):
        lengths = np.array([len(r) for r in raw], np.int64)
        base = np.cumsum(lengths) - lengths
        padded = b"".join(raw) + bytes(LENGTH + 24)
        total = int(lengths.sum())
        parts = [self._smallest(padded, a, min(total, a + CHUNK)) for a in range(0, total, CHUNK)]
        best, hashes = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))
        # best[i] belongs to the string that starts at i; those that cross texts do not count
        windows = np.repeat(base, np.maximum(lengths - LENGTH + 1, 0)) + _ranges(np.maximum(lengths - LENGTH + 1, 0))
        chosen = best[windows] if len(windows) else windows
        new = np.ones(len(chosen), bool)
        owner = np.repeat(np.arange(len(raw)), np.maximum(lengths - LENGTH + 1, 0))
        new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(chosen)) - 1 if len(first) else first
        self.text = owner[first]
        self.hash = hashes[windows[first]].view(np.uint64) if len(first) else np.empty(0, np.uint64)
        self.pos = chosen[first] - base[self.text]
        self.high = chosen[first] - windows[first]
        self.low = chosen[first] - windows[last] if len(first) else first
        counts = np.bincount(self.text, minlength=len(raw))
        self.start = np.cumsum(counts) - counts
        self.nth = _ranges(counts)

    @staticmethod
    def _smallest(padded: bytes, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """For the strings that start at a..b-1: where their leftmost smallest gram is, and its hash."""
        n = b - a + SPAN
        words = np.empty(n + 8, np.uint64)
        for s in range(8):
            size = min((len(padded) - a - s) // 8, len(words[s::8]))
            words[s::8][:size] = np.frombuffer(padded, "<u8", size, a + s)
        values = mix(words[:n] * np.uint64(0x9E3779B97F4A7C15) ^ mix(words[8 : n + 8]))
        best, width = np.arange(a, a + n), 1
        while width * 2 <= SPAN + 1:
            take = values[width:] < values[:-width]
            best, values = np.where(take, best[width:], best[:-width]), np.where(take, values[width:], values[:-width])
            width *= 2
        if rest := SPAN + 1 - width:
            take = values[rest:] < values[:-rest]
            best, values = np.where(take, best[rest:], best[:-rest]), np.where(take, values[rest:], values[:-rest])
        return best[: b - a], values[: b - a].view(np.int64)


def _ranges(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ..."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _columns(x: np.ndarray, width: int) -> bytes:
    """The first bytes of little-endian numbers, byte columns side by side, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize)[:, :width].T).tobytes()


def _numbers(raw: bytes, width: int, kind: str) -> np.ndarray:
    cols = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((cols.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = cols.T
    return out.view(kind).ravel()


def sampled(docs: DataFrame, shards: int) -> DataFrame:
    """Sampled grams by shard: shard, ids, texts (of the texts in the row), hashes, owners, nths.

    A gram that several texts of one batch share is known as shared there and then: its
    occurrences go on at once (done), and the shard hears of it a single time. So a passage
    that very many documents hold does not flood its shard.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, owns, texts = batch.column("doc_id").to_numpy(), batch.column("own").to_numpy(), batch.column("text").to_pylist()
            for s, e in pieces(texts, CHUNK):
                raw, own = [t.encode() for t in texts[s:e]], owns[s:e]
                x = Samples(raw)
                order = np.argsort(x.hash)
                h, t, k = x.hash[order] >> np.uint64(16), x.text[order], x.nth[order]
                group = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1 if len(h) else h.astype(int)
                starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else []
                if len(h):
                    lo, hi = np.minimum.reduceat(own[t], starts), np.maximum.reduceat(own[t], starts)
                    many = (lo != hi)[group]
                    first = np.zeros(len(h), bool)
                    first[starts] = True
                    shard = (mix(h) % np.uint64(shards)).astype(np.int64)
                    yield _sample_row(-1 - int(own[0] % shards), ids[s:e], own, h[many], t[many], k[many])
                    # owner 2^32-1: shared already, nobody waits for the answer
                    told = many & first
                    send = ~many | told
                    h, t, k, shard = h[send], np.where(told, 0xFFFFFFFF, t)[send], k[send], shard[send]
                    by = np.argsort(shard, kind="stable")
                    h, t, k, shard = h[by], t[by], k[by], shard[by]
                    cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)) if len(shard) else np.array([0])
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        yield _sample_row(int(shard[a]), ids[s:e], own, h[a:b], t[a:b], k[a:b])

    return docs.select("doc_id", "own", "text").mapInArrow(step, "shard int, ids binary, own binary, hashes binary, owners binary, nths binary")


def _sample_row(shard: int, ids: np.ndarray, own: np.ndarray, h: np.ndarray, t: np.ndarray, k: np.ndarray) -> pa.RecordBatch:
    used = np.unique(t[t != 0xFFFFFFFF])
    owners = np.where(t == 0xFFFFFFFF, 0xFFFFFFFF, np.searchsorted(used, t)).astype("<u4")
    some = {"shard": pa.array([shard], pa.int32())}
    packed = {"ids": ids[used].astype("<i8").tobytes(), "own": own[used].astype("<i8").tobytes(), "hashes": _columns(h.astype("<u8"), 6), "owners": _columns(owners, 4), "nths": _columns(k.astype("<u4"), 4)}
    return pa.record_batch(some | {c: pa.array([v], pa.binary()) for c, v in packed.items()})


def shared_samples(rows: DataFrame) -> DataFrame:
    """doc_id, own, nths: those sampled positions of a text whose gram another text has, too; a row a text.

    A shard answers with a row per bucket of texts, and the answers are put together by bucket.
    """
    n = partitions(rows.sparkSession)

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, ids, own, k = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(h):
            return
        order = np.argsort(h, kind="stable")
        h, ids, own, k = h[order], ids[order], own[order], k[order]
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        many = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
        sizes = np.diff(np.append(starts, len(h)))
        keep = np.repeat(many, sizes) & (k >= 0)
        yield from answer(ids[keep], own[keep], k[keep])

    def answer(ids: np.ndarray, own: np.ndarray, k: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = (mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int64)
        order = np.lexsort((own, ids, bucket))
        ids, own, k, bucket = ids[order], own[order], k[order].astype("<u4"), bucket[order]
        for part in np.split(np.arange(len(ids)), np.flatnonzero(bucket[1:] != bucket[:-1]) + 1):
            if len(part):
                first, counts = _texts(ids[part], own[part])
                packed = {"ids": ids[part][first].astype("<i8"), "own": own[part][first].astype("<i8"), "counts": counts.astype("<u4"), "nths": k[part]}
                yield pa.record_batch({"bucket": pa.array([bucket[part[0]]], pa.int32())} | {c: pa.array([v.tobytes()], pa.binary()) for c, v in packed.items()})

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in slices(batches):
            for r in batch.to_pylist():
                ids, own = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["own"], "<i8")
                h, t, k = _numbers(r["hashes"], 6, "<u8"), _numbers(r["owners"], 4, "<u4").astype(np.int64), _numbers(r["nths"], 4, "<u4").astype(np.int64)
                if r["shard"] < 0:
                    yield from answer(ids[t], own[t], k)
                    continue
                if r["shard"] != shard and parts:
                    yield from flush(parts)
                    parts = []
                shard = r["shard"]
                told = t == 0xFFFFFFFF
                # one that nobody waits for counts as two texts, so that every other learns of it
                none = np.zeros(1, np.int64)
                at = np.where(told, 0, t)
                ids_of = ids[at] if len(ids) else np.repeat(none, len(t))
                own_of = own[at] if len(own) else np.repeat(none, len(t))
                own_of = np.where(told, np.int64(-(2**63)), own_of)
                parts.append((h, ids_of, own_of, np.where(told, -1, k)))
                if told.any():
                    m = int(told.sum())
                    parts.append((h[told], np.zeros(m, np.int64), np.full(m, 2**63 - 1, np.int64), np.full(m, -1)))
        if parts:
            yield from flush(parts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["bucket"]):
            ids, own, counts, k = (np.frombuffer(b"".join(run.column(c).to_pylist()), kind) for c, kind in (("ids", "<i8"), ("own", "<i8"), ("counts", "<u4"), ("nths", "<u4")))
            ids, own = np.repeat(ids, counts), np.repeat(own, counts)
            order = np.lexsort((own, ids))
            ids, own, k = ids[order], own[order], k[order]
            first, counts = _texts(ids, own)
            for a in range(0, len(first), 2000):
                some = slice(a, a + 2000)
                parts = [k[b : b + c].tobytes() for b, c in zip(first[some].tolist(), counts[some].tolist(), strict=True)]
                yield pa.record_batch({"doc_id": ids[first[some]], "own": own[first[some]], "nths": pa.array(parts, pa.binary())})

    answers = rows.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(step, "bucket int, ids binary, own binary, counts binary, nths binary")
    return answers.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(gather, "doc_id long, own long, nths binary")


def _texts(ids: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts in sorted (id, own) pairs, and how many it has."""
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (own[1:] != own[:-1]))) if len(ids) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(ids)))


def tuples(texts: DataFrame) -> DataFrame:
    """From texts with nths, the numbers of their shared samples: doc_id, own, pos, gram, low, high, context.

    context: from `high` bytes before the sample to LENGTH - low behind its start.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, owns, found = batch.column("doc_id").to_numpy(), batch.column("own").to_numpy(), batch.column("nths").to_pylist()
            texts = batch.column("text").to_pylist()
            for s, e in pieces(texts, CHUNK):
                raw = [t.encode() for t in texts[s:e]]
                x = Samples(raw)
                nths = [np.unique(np.frombuffer(f, "<u4")) for f in found[s:e]]
                at = np.concatenate([x.start[i] + k for i, k in enumerate(nths)]).astype(np.int64)
                t, pos, low, high = x.text[at], x.pos[at], x.low[at], x.high[at]
                context = [raw[i][a:b] for i, a, b in zip(t.tolist(), (pos - high).tolist(), (pos - low + LENGTH).tolist(), strict=True)]
                for a in range(0, len(at), 20_000):
                    c = slice(a, a + 20_000)
                    yield pa.record_batch(
                        {
                            "doc_id": ids[s:e][t[c]],
                            "own": owns[s:e][t[c]],
                            "pos": pos[c].astype(np.int32),
                            "gram": x.hash[at[c]].view(np.int64),
                            "low": low[c].astype(np.int8),
                            "high": high[c].astype(np.int8),
                            "context": pa.array(context[c], pa.binary()),
                        }
                    )

    return texts.mapInArrow(step, "doc_id long, own long, pos int, gram long, low tinyint, high tinyint, context binary")


def induce(gram: np.ndarray, low: np.ndarray, high: np.ndarray, context: list[bytes], least: np.ndarray) -> np.ndarray:
    """For tuples sorted by gram and right context: per tuple and step (strings that start 0..SPAN bytes
    before the sample) the smallest doc_id of that string. Steps that a tuple does not stand for keep the largest number."""
    n = len(gram)
    out = np.full((n, SPAN + 1), np.iinfo(np.int64).max)
    size = np.array([len(c) for c in context])
    # left bytes count back from the sample, right bytes on from it
    flat = np.frombuffer(b"".join(context) + bytes(LENGTH + SPAN), np.uint8)
    sample = np.cumsum(size) - size + high
    ahead = size - high
    right = flat[sample[:, None] + np.arange(LENGTH)]
    same = right[1:] == right[:-1]
    common = np.where(same.all(1), LENGTH, np.argmin(same, axis=1)) if n > 1 else np.empty(0, int)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = np.minimum(common, np.minimum(ahead[1:], ahead[:-1]))
    new = np.append(True, gram[1:] != gram[:-1])
    lcp[new] = -LENGTH * 2  # never one string, whatever is added
    number = np.cumsum(new)
    order = np.arange(n)
    for back in range(SPAN + 1):
        if back:
            stay = high[order] >= back
            key = number[order] * 256 + flat[np.maximum(sample[order] - back, 0)]
            at = np.flatnonzero(stay)
            at = at[np.argsort(key[at], kind="stable")]
            if not len(at):
                break
            key = key[at]
            step = np.full(len(at), -LENGTH * 2, np.int64)
            alike = np.flatnonzero(key[1:] == key[:-1]) + 1
            if len(alike):
                bounds = np.column_stack([at[alike - 1] + 1, at[alike] + 1]).ravel()
                step[alike] = 1 + np.minimum.reduceat(np.append(lcp, 0), bounds)[::2]
            order, lcp = order[at], step
        starts = np.flatnonzero(lcp < LENGTH)
        use = (low[order] <= back) & (back <= high[order])
        value = np.where(use, least[order], np.iinfo(np.int64).max)
        smallest = np.minimum.reduceat(value, starts)
        smallest = np.repeat(smallest, np.diff(np.append(starts, len(order))))
        out[order[use], back] = smallest[use]
    return out


def noted(distinct: DataFrame) -> DataFrame:
    """For merged tuples: gram, tuple_id, marks. marks: (first step, last step, smallest doc_id) triples.

    A gram with more than HEAVY tuples gets one row without marks instead: see halved.
    """

    def emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        gram, ids = rows.column("gram").to_numpy(), rows.column("tuple_id").to_numpy()
        low, high = rows.column("low").to_numpy().astype(np.int64), rows.column("high").to_numpy().astype(np.int64)
        least, most = rows.column("least").to_numpy(), rows.column("most").to_numpy()
        best = induce(gram, low, high, rows.column("context").to_pylist(), least)
        far = np.iinfo(np.int64).max
        use = (np.where(best == far, far, best) < most[:, None]).any(1)
        at = np.flatnonzero(use)
        best, first = best[at], np.ones((len(at), SPAN + 1), bool)
        first[:, 1:] = best[:, 1:] != best[:, :-1]
        first &= best != far
        row, start = np.nonzero(first)
        value = best[row, start]
        # a mark ends before the next one of its row, or with the tuple's last string
        end = np.append(np.where(row[1:] == row[:-1], start[1:] - 1, high[at][row[:-1]]), high[at][row[-1:]]) if len(row) else start
        cuts = np.append(0, np.cumsum(np.bincount(row, minlength=len(at)))).tolist()
        marks = np.column_stack([start, end, value]).astype("<i8")
        yield pa.record_batch({"gram": gram[at], "tuple_id": ids[at], "marks": pa.array([marks[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, heavy = 0, None
        for batch in batches:
            if heavy is not None:
                batch = batch.slice(int(np.searchsorted(batch.column("gram").to_numpy(), heavy, side="right")))
                if not batch.num_rows:
                    continue
                heavy = None
            held.append(batch)
            count += batch.num_rows
            if count >= QUEUE:
                rows = pa.Table.from_batches(held)
                gram = rows.column("gram").to_numpy()
                end = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
                if end:
                    yield from emit(rows.slice(0, end))
                    held = rows.slice(end).to_batches()
                    count = len(gram) - end
                if count > HEAVY:
                    heavy, held, count = gram[-1], [], 0
                    yield pa.record_batch({"gram": gram[-1:], "tuple_id": np.zeros(1, np.int64), "marks": pa.array([None], pa.binary())})
        if held and count:
            yield from emit(pa.Table.from_batches(held))

    n = partitions(distinct.sparkSession)
    after = F.expr("substring(context, high + 1, 1000)")
    ordered = distinct.repartition(2 * n, "gram").sortWithinPartitions("gram", after)
    return ordered.mapInArrow(step, "gram long, tuple_id long, marks binary")


def halved(occurrences: DataFrame, heavy: DataFrame) -> DataFrame:
    """The occurrences of the heavy grams, once for each half of the steps that they stand for, as occurrences of longer grams.

    The strings that start first to last bytes before a sample all hold the bytes from `first` before it to
    LENGTH - last behind its start: tuples that differ there have no string in common, and these bytes take the gram's place.
    A half has the context of its own strings alone, so that tuples which differ elsewhere become one.
    """
    middle = F.expr("cast(floor((first + last) / 2) as int)")
    halves = F.array(F.struct(F.col("first").alias("f"), middle.alias("l")), F.struct((middle + 1).alias("f"), F.col("last").alias("l")))
    rows = occurrences.join(heavy, "gram", "left_semi").select("*", F.explode(halves).alias("half")).where("low <= half.l and high >= half.f")
    rows = rows.withColumns({"l": F.expr("greatest(cast(low as int), half.f)"), "h": F.expr("least(cast(high as int), half.l)")})
    shared = F.expr(f"substring(context, high - half.f + 1, half.f + {LENGTH} - half.l)")
    own = F.expr(f"substring(context, high - h + 1, h + {LENGTH} - l)")
    return rows.select("doc_id", "own", "pos", F.xxhash64("gram", "half.f", shared).alias("gram"), F.col("l").cast("tinyint").alias("low"), F.col("h").cast("tinyint").alias("high"), own.alias("context"), F.col("half.f").alias("first"), F.col("half.l").alias("last"))


def spans(hits: DataFrame) -> DataFrame:
    """doc_id, own, starts, ends of the removed strings, merged per tuple, from occurrences with marks."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("marks").to_pylist()
            marks = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 3)
            row = np.repeat(np.arange(len(raw)), [len(r) // 24 for r in raw])
            doc, pos = batch.column("doc_id").to_numpy()[row], batch.column("pos").to_numpy()[row].astype(np.int64)
            gone = marks[:, 2] < doc
            doc, own, first, last = doc[gone], batch.column("own").to_numpy()[row][gone], (pos - marks[:, 1])[gone], (pos - marks[:, 0] + LENGTH)[gone]
            # those of one text in a batch that meet are one
            order = np.lexsort((first, own, doc))
            doc, own, first, last = doc[order], own[order], first[order], last[order]
            new = np.append(True, (doc[1:] != doc[:-1]) | (own[1:] != own[:-1])) if len(doc) else np.empty(0, bool)
            text = np.cumsum(new)
            far = np.maximum.accumulate(last + text * (1 << 40)) - text * (1 << 40)
            new[1:] |= first[1:] > far[:-1]
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(doc)) - 1 if len(start) else start
            yield pa.record_batch({"doc_id": doc[start], "own": own[start], "first": first[start], "last": far[end]})

    return hits.mapInArrow(step, "doc_id long, own long, first long, last long")


def merged(ranges: np.ndarray) -> np.ndarray:
    """Maximal runs of sorted half-open ranges."""
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    end = np.maximum.accumulate(ranges[:, 1])
    new = np.append(True, ranges[1:, 0] > end[:-1])
    starts = np.flatnonzero(new)
    return np.column_stack([ranges[starts, 0], np.append(end[starts[1:] - 1], end[-1])])


def remaining(raw: bytes, runs: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in runs.tolist():
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def removed_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, spans), both written tables.

    base: doc_id, own (a hash of the text), n_bytes, sha256, copy (a smaller doc_id has the same
    text of LENGTH bytes or more) of every row. spans: doc_id, own, ranges (first, last) of the
    strings to remove, half open and not merged, of the rows that are no copies and have some.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    every = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("own", F.xxhash64("text"))
    base = every.select("doc_id", "own", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))
    base = cut(base, "texts")
    first = base.groupBy("sha256").agg(F.min("doc_id").alias("least"))
    marked = base.join(first, "sha256").withColumn("copy", F.coalesce((F.col("n_bytes") >= LENGTH) & (F.col("doc_id") > F.col("least")), F.lit(False))).drop("least")
    marked = cut(marked, "marked")
    rows = every.where("doc_id is not null").where(F.octet_length("text") >= LENGTH)
    total = base.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    shards = max(n, -(-total // (18 * SHARD)))
    found = cut(shared_samples(sampled(rows, shards)), "samples")
    # copies of a text add nothing to its smallest doc_id
    originals = marked.where("not copy and doc_id is not null").select("doc_id", "own").distinct()
    mine = found.join(originals, ["doc_id", "own"], "left_semi")
    table = cut(tuples(rows.join(mine, ["doc_id", "own"])), "tuples")
    occurrences, tables, strings = table.withColumns({"first": F.lit(0), "last": F.lit(SPAN)}), [base, found, table], None
    while True:
        occurrences = occurrences.withColumn("tuple_id", F.xxhash64("context", "low", "high"))
        distinct = occurrences.groupBy("gram", "tuple_id", "low", "high", "context").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        marks = cut(noted(distinct), "marks")
        tables.append(marks)
        hits = occurrences.select("doc_id", "own", "pos", "gram", "tuple_id").join(marks.where("marks is not null"), ["gram", "tuple_id"])
        strings = spans(hits) if strings is None else strings.union(spans(hits))
        heavy = marks.where("marks is null").select("gram").distinct()
        if heavy.isEmpty():
            break
        occurrences = cut(halved(occurrences, heavy), "halves")
        tables.append(occurrences)
    gone = cut(strings.groupBy("doc_id", "own").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "spans")
    discard(*tables)
    return marked, gone


def _runs(ranges: list[dict]) -> np.ndarray:
    return merged(np.array([(r["first"], r["last"]) for r in ranges], np.int64))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Texts are their UTF-8 bytes, null texts empty. Nothing is removed from texts of fewer than
    LENGTH bytes, nor from rows without a doc_id, which also remove nothing from others. Rows that
    repeat a doc_id remove nothing from each other. Extra columns are ignored; an empty table
    gives no rows.
    """
    base, gone = removed_spans(docs)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            runs = [_runs(r) for r in batch.column("ranges").to_pylist()]
            shas = [hashlib.sha256(remaining(t.encode(), r)).hexdigest() for t, r in zip(batch.column("text").to_pylist(), runs, strict=True)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "own": batch.column("own"),
                    "n_removed": pa.array([int((r[:, 1] - r[:, 0]).sum()) for r in runs], pa.int64()),
                    "n_spans": pa.array([len(r) for r in runs], pa.int64()),
                    "kept_sha256": pa.array(shas, pa.string()),
                }
            )

    rows = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("own"))
    changed = rows.join(gone, ["doc_id", "own"]).mapInArrow(step, "doc_id long, own long, n_removed long, n_spans long, kept_sha256 string")
    changed = changed.dropDuplicates(["doc_id", "own"])
    out = base.join(changed, ["doc_id", "own"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The rows with what repeats removed from their texts, and n_chars as it is then; copies have an empty text.

    Of a character that is removed in part, no byte stays. Columns may have any names. Rows without a doc_id or that repeat one are rows by themselves; an empty table gives no rows.
    """
    base, gone = removed_spans(docs)
    whole = base.where("copy").select("doc_id", "own", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("last"))).alias("ranges")).distinct()
    columns = docs.columns
    own, ranges = free_names(docs, "own", "ranges")
    known = gone.union(whole).toDF("doc_id", own, ranges)
    joined = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit("")))).join(known, ["doc_id", own], "left").select(*columns, ranges)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t if not r else remaining(t.encode(), _runs(r)).decode(errors="ignore") for t, r in zip(batch.column("text").to_pylist(), batch.column(ranges).to_pylist(), strict=True)]
            new = {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                new["n_chars"] = pa.array([None if t is None else len(t) for t in texts], batch.column("n_chars").type)
            yield pa.record_batch({c: new.get(c, batch.column(c)) for c in columns})

    return joined.mapInArrow(step, docs.schema)
