"""Word shingles of whole texts as 64-bit hashes, for many texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64))) for b in (_BASE, inverse)]
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and how many each text has.

    Words are maximal runs of bytes other than space and \\t..\\r, with A-Z lower-cased.
    """
    raw = [t.encode().lower() for t in texts]  # bytes.lower() is for A-Z alone
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buf) and not space[0]:
        edge = np.append(0, edge)
    start, end = edge[::2], edge[1::2]  # the buffer ends with a space
    pw, inverse = powers(len(buf) + 1)
    total = np.append(np.uint64(0), np.cumsum(buf.astype(np.uint64) * pw[: len(buf)]))
    words = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _C1)
    ends = np.cumsum([len(r) + 1 for r in raw])
    return words, np.diff(np.append(0, np.searchsorted(start, ends)))


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): each text's set, sorted, one after the other.

    A text with fewer words than a shingle has its whole sequence as one; without words its set is empty.
    """
    words, counts = word_hashes(texts)
    first = np.append(0, np.cumsum(counts))
    fold = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        fold = fold * _C2 + words[j : j + len(fold)]
    fold = mix(fold)
    sets = []
    for s, n in zip(first[:-1].tolist(), counts.tolist(), strict=True):
        if n >= WORDS:
            x = np.sort(fold[s : s + n - WORDS + 1])
            keep = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            sets.append(x[keep])
        elif n:
            h = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[s : s + n]:
                    h = h * _C1 + w
            sets.append(mix(np.array([h], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.array([len(x) for x in sets], np.int64)


def pieces(texts: list[str], most: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of texts that together have at most about so many code points."""
    out, start, held = [], 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            out.append((start, i))
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        out.append((start, len(texts)))
    return out
