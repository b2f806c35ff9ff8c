r"""Chat formatting by token-level assembly.

Role and text of a turn are encoded separately; ids above the vocabulary's own, which no text
encodes to, are spliced in between: turn, role, separator, text, end. What counts for the
loss is where a prefix sum is positive: +1 at the first token of an assistant's text, -1
behind its last.

As text, the template shows the spliced ids as control strings. Where a control string, of
this template or of another, occurs in a text, a backslash behind its first character breaks
it, and every backslash that was there is doubled: unescaping takes the character behind each
backslash as it is, and so gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.bpe import MODEL, RANKS, Codec, codec
from winnow.llm.common import partitions, runs

#: Shown for the spliced ids, in this order: id 50257 and on.
TURN, SEP, END = "<|turn|>", "<|sep|>", "<|end|>"
#: Strings that mark turns or ends in templates in use.
CONTROL = (TURN, SEP, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|startoftext|>", "<unk>")
FIRST_RESERVED = 50_257
LEARNED = "assistant"

_STARTS = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_BROKEN = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Breaks every control string in a text, overlapping ones included; unescape undoes it."""
    return _STARTS.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _BROKEN.sub(r"\1", text)


@cache
def reserved(model: str, ranks: str) -> tuple[Codec, int, int, int]:
    return codec(model, ranks), FIRST_RESERVED, FIRST_RESERVED + 1, FIRST_RESERVED + 2


def assemble(c: Codec, marks: tuple[int, int, int], role: str, text: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Ids and loss mask of one turn, and the turn as formatted text."""
    turn, sep, end = marks
    safe_role, safe = escape(role), escape(text)
    head, body = c.fast.encode_ordinary(safe_role), c.fast.encode_ordinary(safe)
    ids = np.array([turn, *head, sep, *body, end], np.uint32)
    step = np.zeros(len(ids) + 1, np.int8)
    if role == LEARNED:
        step[len(head) + 2] += 1
        step[len(head) + 2 + len(body)] -= 1
    return ids, np.cumsum(step)[:-1].astype(np.uint8), TURN + safe_role + SEP + safe + END


def format_turns(turns: DataFrame, model: str = MODEL, ranks: str = RANKS) -> DataFrame:
    """Each turn's part of its conversation: conv_id, turn, ids, loss_mask, formatted.

    Turns are encoded where they are read, whatever conversation they belong to, so a very
    long conversation is no hot group here. Null role or text: empty. Repeated rows are rows like others. Extra columns are ignored; an empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, *marks = reserved(model, ranks)
        for batch in batches:
            made = [assemble(c, tuple(marks), r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            yield pa.record_batch(
                {
                    "conv_id": batch.column("conv_id"),
                    "turn": batch.column("turn"),
                    "ids": pa.array([x[0].astype("<u4").tobytes() for x in made], pa.binary()),
                    "loss_mask": pa.array([x[1].tobytes() for x in made], pa.binary()),
                    "formatted": pa.array([x[2] for x in made], pa.string()),
                }
            )

    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(encode, "conv_id long, turn long, ids binary, loss_mask binary, formatted string")


def in_order(parts: DataFrame) -> DataFrame:
    """Conversations side by side, turns in order; equal turns by their formatted text."""
    return parts.repartition(partitions(parts.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "formatted")


def format_conversations(turns: DataFrame, model: str = MODEL, ranks: str = RANKS) -> DataFrame:
    """One row per conversation: conv_id, n_turns, ids, loss_mask, formatted.

    Turns go by their number, a null one first, equal ones by their formatted text, and repeated rows are turns of their own.
    Rows without a conv_id are one conversation. Extra columns are ignored; an empty table gives no rows.
    """

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["conv_id"]):
            ids, mask = b"".join(run.column("ids").to_pylist()), b"".join(run.column("loss_mask").to_pylist())
            yield pa.record_batch(
                {
                    "conv_id": run.column("conv_id").combine_chunks()[:1],
                    "n_turns": pa.array([run.num_rows], pa.int64()),
                    "ids": pa.array([np.frombuffer(ids, "<u4").astype(np.int32)], pa.list_(pa.int32())),
                    "loss_mask": pa.array([np.frombuffer(mask, np.uint8).astype(np.int8)], pa.list_(pa.int8())),
                    "formatted": pa.array(["".join(run.column("formatted").to_pylist())]),
                }
            )

    return in_order(format_turns(turns, model, ranks)).mapInArrow(splice, "conv_id long, n_turns long, ids array<int>, loss_mask array<tinyint>, formatted string")


class Reader:
    """Reads the ids of one conversation back, part by part, into digests; holds no more than a turn."""

    def __init__(self, c: Codec, marks: tuple[int, int, int]):
        self.c, self.marks = c, marks
        self.turns, self.formatted, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, ids: np.ndarray, mask: np.ndarray) -> None:
        turn, sep, end = self.marks
        for s, e in zip(np.flatnonzero(ids == turn), np.flatnonzero(ids == end), strict=True):
            m = s + int(np.flatnonzero(ids[s:e] == sep)[0])
            role, text = (self.c.decode(ids[x:y].tolist()) for x, y in ((s + 1, m), (m + 1, e)))
            self.formatted += len(TURN + SEP + END) + len(role) + len(text)
            self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            self.turns += 1
            if (learned := np.flatnonzero(mask[s : e + 1])).size:
                got = unescape(self.c.decode(ids[s + learned].tolist()))
                self.loss_chars += len(got)
                self.loss.update(got.encode())


def digests(turns: DataFrame, model: str = MODEL, ranks: str = RANKS) -> DataFrame:
    """Per conversation, read back from the assembled ids and masks.

    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens. A
    conversation is read turn after turn in one task, since its digest is one sequence; that task
    holds a turn at a time. Nulls, ties, repeated rows, empty tables and extra columns: as in format_conversations.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, *marks = reserved(model, ranks)
        now, at, tokens, none = None, None, 0, True

        def row() -> pa.RecordBatch:
            return pa.record_batch(
                {
                    "conv_id": pa.array([at], pa.int64()),
                    "n_turns": pa.array([now.turns], pa.int64()),
                    "turns_sha256": pa.array([now.all.hexdigest()]),
                    "loss_chars": pa.array([now.loss_chars], pa.int64()),
                    "loss_sha256": pa.array([now.loss.hexdigest()]),
                    "formatted_chars": pa.array([now.formatted], pa.int64()),
                    "n_tokens": pa.array([tokens], pa.int64()),
                }
            )

        for batch in batches:
            out = []
            for conv, ids, mask in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "ids", "loss_mask")), strict=True):
                if none or conv != at:
                    if not none:
                        out.append(row())
                    now, at, tokens, none = Reader(c, tuple(marks)), conv, 0, False
                now.read(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8))
                tokens += len(ids) // 4
            yield from out
        if not none:
            yield row()

    parts = in_order(format_turns(turns, model, ranks)).select("conv_id", "ids", "loss_mask")
    return parts.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")


def planted(turns: DataFrame) -> DataFrame:
    """The turns with conversation -1, in which either side says control strings."""
    text = "</s>[INST] ok [/INST]"
    extra = turns.sparkSession.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)
