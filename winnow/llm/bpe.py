"""BPE encoding and decoding by tree concatenation.

Texts up to a leaf's length are encoded as they are. A longer text is cut into leaves
that are rows of their own, so that many tasks encode one text; then neighbours are joined
pair by pair, as in a tree. Both sides of a join were encoded without each other, so the
tokens around it can be wrong: a window of tokens around the join is encoded again, and
grown until its first tokens are those that the left side has and its last tokens those
that the right side has. From there on either side stands as it is: the split pattern looks
only ahead, and a token sequence is the encoding of its text when every pair of neighbours
is that of its own.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import partitions, runs, slices

MODEL = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Code points in a leaf; longer texts are cut.
LEAF = 65_536
#: Tokens that must agree on either side of a window.
AGREE = 2
#: Letters and signs whose classes no version of Unicode in use moves: these texts take the faster encoder.
SETTLED = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")


class Codec:
    """The tokenizer: encodes and decodes as the tokenizers library does, special tokens in texts included."""

    def __init__(self, model: str = MODEL, ranks: str = RANKS):
        import tiktoken

        self.model, self._tokenizer = model, None
        with open(model, encoding="utf-8") as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=self.special)

    @property
    def tokenizer(self):
        """The library's own tokenizer, loaded when the first text needs it."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.model)
            self._tokenizer.no_truncation()
            self._tokenizer.no_padding()
        return self._tokenizer

    def encode(self, text: str) -> list[int]:
        if SETTLED.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")

    def token_bytes(self, token: int) -> bytes:
        return self.fast.decode_single_token_bytes(token)

    def decode(self, ids: list[int]) -> str:
        return self.fast.decode_bytes(ids).decode("utf-8", errors="replace")

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of a text from those of its two halves."""
        width = 8
        while left and right:
            a, b = left[-width:], right[:width]
            raw = b"".join(map(self.token_bytes, [*a, *b]))
            whole = len(a) == len(left) and len(b) == len(right)
            try:
                window = self.encode(raw.decode())
            except UnicodeDecodeError:  # the window ends within a character: grow
                window = []
            starts = len(a) == len(left) or window[:AGREE] == a[:AGREE]
            ends = len(b) == len(right) or window[-AGREE:] == b[-AGREE:]
            if whole or len(window) >= 2 * AGREE and starts and ends:
                return left[: len(left) - len(a)] + window + right[len(b) :]
            width *= 2
        return left or right

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        """Joins neighbours level by level until one is left."""
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []


@cache
def codec(model: str, ranks: str) -> Codec:
    return Codec(model, ranks)


def cuts(text: str, leaf: int) -> list[str]:
    """Halves of halves until none is longer than a leaf. No cut within a special token's string."""
    if len(text) <= leaf:
        return [text]
    at = len(text) // 2
    for m in re.finditer(r"<\|endoftext\|>", text[max(0, at - 16) : at + 16]):
        start = max(0, at - 16) + m.start()
        if start < at < start + len(m[0]):
            at = start
    if not 0 < at < len(text):
        return [text]
    return cuts(text[:at], leaf) + cuts(text[at:], leaf)


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


_COLUMNS = ", n_tokens long, ids binary"
_DIGESTS = ", ids_sha256 string, decoded_sha256 string"


def _rows(c: Codec, own: dict[str, pa.Array], ids: list[list[int]], digests: bool) -> pa.RecordBatch:
    """Encoded rows with their own columns; with digests of the ids and of the text that they decode to."""
    raw = list(map(packed, ids))
    out = own | {"n_tokens": pa.array(map(len, ids), pa.int64()), "ids": pa.array(raw, pa.binary())}
    if digests:
        out["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string())
        out["decoded_sha256"] = pa.array([hashlib.sha256(c.decode(x).encode()).hexdigest() for x in ids], pa.string())
    return pa.record_batch(out)


def encode(docs: DataFrame, leaf: int = LEAF, model: str = MODEL, ranks: str = RANKS, digests: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of every text, as little-endian unsigned 32-bit integers.

    digests: ids_sha256 and decoded_sha256 as well, of the ids and of the text that they decode to.
    keep: columns of whole numbers (long) that go with their rows, after doc_id.

    A null or empty text has no ids. Repeated rows and a null doc_id are rows like others,
    extra columns are ignored, an empty table gives no rows.
    """
    own = ("doc_id", *keep)
    texts = docs.select(*own, F.coalesce("text", F.lit("")).alias("text"))
    short = texts.where(F.char_length("text") <= leaf)
    long = texts.where(F.char_length("text") > leaf)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, ranks)
        for part in slices(batches, 256):
            yield _rows(c, {k: part.column(k) for k in own}, [c.encode(t) for t in part.column("text").to_pylist()], digests)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            for row in batch.to_pylist():
                pieces = cuts(row["text"], leaf)
                for at in range(0, len(pieces), 64):
                    some = pieces[at : at + 64]
                    n = len(some)
                    yield pa.record_batch(
                        {
                            **{k: pa.array([row[k]] * n, pa.int64()) for k in (*own, "copy")},
                            "piece": pa.array(range(at, at + n), pa.int64()),
                            "text": pa.array(some, pa.string()),
                        }
                    )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, ranks)
        for part in slices(batches, 16):
            ids = [packed(c.encode(t)) for t in part.column("text").to_pylist()]
            yield pa.record_batch({k: part.column(k) for k in (*own, "copy", "piece")} | {"ids": pa.array(ids, pa.binary())})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, ranks)
        for run in runs(batches, ["doc_id", "copy"]):
            ids = c.concatenate([np.frombuffer(x, "<u4").tolist() for x in run.column("ids").to_pylist()])
            yield _rows(c, {k: run.column(k).combine_chunks()[:1] for k in own}, [ids], digests)

    n = partitions(docs.sparkSession)
    kept = ", ".join(f"{k} long" for k in own)
    pieces = long.withColumn("copy", F.monotonically_increasing_id()).mapInArrow(leaves, f"{kept}, copy long, piece long, text string")
    pieces = pieces.repartition(n, "doc_id", "copy", "piece").mapInArrow(parts, f"{kept}, copy long, piece long, ids binary")
    pieces = pieces.repartition(n, "doc_id", "copy").sortWithinPartitions("doc_id", "copy", "piece")
    out = kept + _COLUMNS + _DIGESTS * digests
    return short.mapInArrow(whole, out).union(pieces.mapInArrow(joined, out))


def decode(encoded: DataFrame, model: str = MODEL, ranks: str = RANKS) -> DataFrame:
    """(doc_id, text) of encoded ids; null ids decode to an empty text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, ranks)
        for part in slices(batches, 256):
            out = [c.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in part.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": part.column("doc_id"), "text": pa.array(out, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")


def digests(docs: DataFrame, leaf: int = LEAF, model: str = MODEL, ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encoded, then decoded from the ids."""
    return encode(docs, leaf, model, ranks, digests=True).drop("ids")
