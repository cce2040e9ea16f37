"""Words of whole texts as arrays, for operators that work on word sequences.

A word is a maximal run of ASCII digits and letters and of non-ASCII characters, with A-Z lowered
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``). Every byte of a non-ASCII character is at least 0x80, so
runs of UTF-8 bytes are the same words. Texts are worked on in blocks of about ``BLOCK`` bytes, which
bounds the memory of the arrays; a longer text is cut between words, never inside one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .memory import forgotten_after_tasks

BLOCK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_IN_WORD = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _IN_WORD[_low:_high] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


@forgotten_after_tasks
def _forget_powers() -> None:
    global _powers
    _powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK + BLOCK // 8)  # a block and what stands between its texts
        grown = []
        for factor in (_BASE, _INVERSE):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            grown.append(np.multiply.accumulate(steps))
        _powers = grown[0], grown[1]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold(data: bytes) -> np.ndarray:
    """The bytes with A-Z lowered."""
    return _FOLD[np.frombuffer(data, dtype=np.uint8)]


def spans(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    inside = np.zeros(len(folded) + 2, dtype=bool)
    inside[1:-1] = _IN_WORD[folded]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def span_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: differences of prefix sums of a polynomial, moved to the origin."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _grown(len(folded) + 1)
    sums = np.zeros(len(folded) + 1, dtype=np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * power[: len(folded)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


@dataclass
class Words:
    """The words of a list of texts, in order."""

    data: np.ndarray  # all texts, lowered, one zero byte after each
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray  # number of the text that a word belongs to
    first: np.ndarray  # first word of each text, and the number of words at the end


def words_of(texts: list[bytes]) -> Words:
    joined = b"\0".join(texts) + b"\0"
    data = fold(joined)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    parts = []
    at = 0
    while at < len(data):
        stop = min(at + 4 * BLOCK, len(data))
        if stop < len(data):  # cut behind the last byte outside words
            outside = np.flatnonzero(~_IN_WORD[data[at:stop]])
            if len(outside):
                stop = at + int(outside[-1]) + 1
            else:
                rest = joined[stop:]
                stop += next((i for i, b in enumerate(rest) if not _IN_WORD[b]), len(rest))
        s, e = spans(data[at:stop])
        parts.append((s + at, e + at, span_hashes(data[at:stop], s, e)))
        at = stop
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts))
    text = np.searchsorted(begins, starts, side="right") - 1
    return Words(data, starts, ends, hashes, text, np.searchsorted(text, np.arange(len(texts) + 1)))


def blocks(sizes: list[int], limit: int = BLOCK) -> Iterator[slice]:
    """Slices of a list of texts of at most ``limit`` bytes together; a longer text is alone."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    return [b"" if t is None else t for t in column.cast("binary").to_pylist()]


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles and the first of each text (and the count at the end).

    A text of fewer words, but not none, is one shingle."""
    counts = np.diff(words.first)
    shingles = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    text = np.repeat(np.arange(len(counts)), shingles)
    begin = words.first[text] + np.arange(first[-1]) - first[text]
    out = np.zeros(len(text), dtype=np.uint64)
    if len(text):
        length = np.minimum(counts[text], k)
        for i in range(k):
            there = i < length
            at = np.where(there, begin + i, 0)
            out = mix(out + np.where(there, words.hashes[at], np.uint64(0)) + np.uint64(i + 1))
    return out, first
