"""Token counts of a unigram tokenizer by a count-only Viterbi pass.

An Aho-Corasick automaton of the vocabulary reports every piece that ends at each character of
a word. For each end, the best way to reach it is kept as a score and a number of pieces; no
lattice and no pieces are built. The tokenizer's tie rules hold: of equally good ways the one
whose last piece starts first stays; a character that is no piece by itself may be an unknown,
at the least score less ten; and unknowns in a row are one piece.

Texts are split as that tokenizer splits them: a space becomes the mark of a word's start, the
text starts with one, and every word begins at a mark. Words come again and again, so each task
remembers the counts of short ones, up to a fixed number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import slices

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Scores are multiples of this part of one, so that their sums are exact and a word may be cut at a line end.
GRAIN = 1024
#: Words that a task remembers, and the length up to which it does.
REMEMBERED, SHORT = 600_000, 48


@cache
def vocabulary(path: str = PIECES) -> dict[str, float]:
    """Pieces of a vocabulary file, each with a score that falls with the logarithm of its rank.

    The file's own scores are ranks. Control and byte pieces are left out.
    """
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
    return {p: -round(GRAIN * math.log(rank + 2)) / GRAIN for rank, p in enumerate(usable)}


class Counter:
    """Counts pieces; word_count remembers."""

    def __init__(self, vocab: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocab.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = frozenset(p for p in vocab if len(p) == 1)
        self.unknown = min(vocab.values()) - UNKNOWN_PENALTY
        whole = all((s * GRAIN).is_integer() for s in vocab.values())
        # no piece reaches over a line end: there the ways fall apart, and sums are exact
        self.cut = whole and not any("\n" in p for p in vocab)
        self.memory = Memory(self)

    def best(self, word: str) -> tuple[int, bool, bool]:
        """(pieces, whether the first is unknown, whether the last is)."""
        n = len(word)
        score = [0.0] + [None] * n
        count, unk, head = [0] * (n + 1), [False] * (n + 1), [False] * (n + 1)
        at, unknown, single = 0, self.unknown, self.single

        def pass_by(upto: int) -> None:
            """Unknown steps for ends up to and with `upto`."""
            nonlocal at
            while at < upto:
                if word[at] not in single:
                    s, e = score[at] + unknown, at + 1
                    if score[e] is None or s > score[e]:
                        score[e], unk[e], head[e] = s, True, head[at] if at else True
                        count[e] = count[at] + (not unk[at])
                at += 1

        for end, (length, s) in self.automaton.iter(word):
            if at < end:
                pass_by(end)
            start, e = end + 1 - length, end + 1
            s += score[start]
            if score[e] is None or s > score[e]:
                score[e], unk[e], count[e], head[e] = s, False, count[start] + 1, head[start] if start else False
        pass_by(n)
        return count[n], head[n], unk[n]

    def word(self, word: str) -> int:
        if not self.cut or "\n" not in word:
            return self.best(word)[0]
        total, before = 0, False
        for i, part in enumerate(word.split("\n")):
            if i and not before:  # the line end is an unknown, too
                total, before = total + 1, True
            if part:
                n, first, last = self.best(part)
                total, before = total + n - (first and before), last if n > 1 or not first else True
        return total

    def text(self, text: str) -> int:
        if not text:
            return 0
        t = text.replace(" ", MARK)
        return sum(map(self.memory.__getitem__, t[1:].split(MARK) if t[0] == MARK else t.split(MARK)))


class Memory(dict):
    """Counts of the words after a mark."""

    def __init__(self, counter: Counter):
        self.counter = counter

    def __missing__(self, word: str) -> int:
        n = self.counter.word(MARK + word)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


@cache
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """doc_id, n_chars, n_tokens of every whole text.

    A null or empty text has no tokens. Repeated rows and a null doc_id are rows like others,
    extra columns are ignored, an empty table gives no rows.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_chars": pa.array(map(len, texts), pa.int64()), "n_tokens": pa.array(np.fromiter(map(c.text, texts), np.int64, len(texts)))})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(step, "doc_id long, n_chars long, n_tokens long")
