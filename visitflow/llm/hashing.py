"""Vectorised 64-bit hashes of words and word shingles over Arrow text columns, for use inside tasks.

A word is a run of bytes other than space and \\t to \\r. Texts are hashed in byte windows of
WINDOW, cut where a word ends, so that memory does not grow with the length of a text (8 bytes a word
are kept). Two different words share a hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

WINDOW = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_A, _B, _C = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTES = np.arange(256, dtype=np.uint8)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_PLAIN = mix(np.arange(1, 257, dtype=np.uint64) * _A)
_LOWER = _PLAIN[np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after another, and where each text begins (one more at the end).

    Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (raw[at[0] : at[-1]], at - at[0]) if len(at) else (raw[:0], np.zeros(1, np.int64))


def squeezed(column: pa.Array) -> pa.Array:
    """Texts as they travel to a join: about half as large as Spark's own compression leaves them."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    raw, at = bytes_of(column)
    texts = [squeeze(raw[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return pa.array(texts, pa.binary(), mask=column.is_null().to_numpy(zero_copy_only=False))


def restored(column: pa.Array) -> pa.Array:
    """The texts again, as bytes; null stays null."""
    restore = zstandard.ZstdDecompressor().decompress
    return pa.array([None if x is None else restore(x) for x in column.to_pylist()], pa.binary())


class Words:
    """Where the words of texts lie (byte positions), their hashes, and each text's first word."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, lower: bool = False) -> None:
        starts, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for p, q in _windows(raw, at):
            s, e, h = _hashed(raw[p:q], at[np.searchsorted(at, p, "right") : np.searchsorted(at, q)] - p, lower)
            starts.append(s + p)
            ends.append(e + p)
            hashes.append(h)
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.hashes = np.concatenate(hashes)
        self.first = np.searchsorted(self.starts, at)


def _windows(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about WINDOW that end where a word or a text ends."""
    p, n = 0, len(raw)
    while p < n:
        q = min(n, p + WINDOW)
        if q < n:
            before = np.flatnonzero(_SPACE[raw[p:q]])
            if len(before):
                q = p + int(before[-1]) + 1
            else:
                text_end = int(at[np.searchsorted(at, q)])
                while q < text_end and not _SPACE[raw[q]]:
                    q += 1
        yield p, q
        p = q


def _hashed(raw: np.ndarray, breaks: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(raw)
    space = _SPACE[raw]
    begins, closes = ~space, ~space
    begins[1:] &= space[:-1]
    closes[:-1] &= space[1:]
    inner = breaks[(breaks > 0) & (breaks < n)]
    begins[inner] = ~space[inner]
    closes[inner - 1] = ~space[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    powers, inverses = _powers(n)
    values = (_LOWER if lower else _PLAIN)[raw] * powers
    sums = np.cumsum(values)
    hashes = (sums[ends - 1] - sums[starts] + values[starts]) * inverses[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64) * _B)


_known: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_known[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, WINDOW), base, np.uint64)
            steps[0] = 1
            _known[k] = np.cumprod(steps)
    return _known[0][:n], _known[1][:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges that follow one another, so many at a time that they span about WINDOW bytes."""
    out, lo = [], 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + WINDOW, "right")))
        base, top = int(starts[lo]), int(ends[hi - 1])
        powers, inverses = _powers(top - base)
        values = _PLAIN[raw[base:top]] * powers
        sums = np.cumsum(values)
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out.append(mix((sums[e - 1] - sums[s] + values[s]) * inverses[s] + (e - s).astype(np.uint64) * _B))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of `width` neighbouring values."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:n] * _C + np.uint64(width))
    for i in range(1, width):
        out = mix(out * _B + hashes[i : n + i])
    return out


def text_groups(at: np.ndarray, size: int = 4 * WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts that hold about `size` bytes; a longer text is a range of its own."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class ShingleSets:
    """The distinct shingle hashes of each text, sorted, one text after another.

    A text with fewer words than `width` is one shingle as a whole, one without words has none.
    """

    def __init__(self, words: Words, width: int) -> None:
        first = words.first
        counts = np.diff(first)
        out, sizes = [], np.zeros(len(counts), np.int64)
        every = runs(words.hashes, width)
        for k in range(len(counts)):
            c = int(counts[k])
            if c == 0:
                continue
            s = int(first[k])
            own = every[s : s + c - width + 1].copy() if c >= width else runs(words.hashes[s : s + c], c)
            own.sort()
            if len(own) > 1:
                fresh = np.empty(len(own), bool)
                fresh[0] = True
                np.not_equal(own[1:], own[:-1], out=fresh[1:])
                own = own[fresh]
            sizes[k] = len(own)
            out.append(own)
        self.values = np.concatenate(out) if out else np.zeros(0, np.uint64)
        self.sizes = sizes
        self.ends = np.cumsum(sizes)
