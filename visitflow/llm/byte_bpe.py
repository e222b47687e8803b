"""Byte-level BPE over padded numpy matrices, and decoding by table lookup.

A text is split by the tokenizer's pattern, and each match is encoded by itself. Matches that a worker has
not met are grouped by byte length, a group of LONG_ROW bytes at most being one matrix of token numbers
with a row for each match. Every round, each row merges its leftmost pair of minimum rank; pair ranks come
from a hash table with open addressing, and only the two pairs beside a merge are looked up again. Rows are
compacted by a shift, and rows with nothing left to merge leave the matrix.

Rounds grow with a match's length, and so does a row. A single match of more than LONG_ROW bytes (a stretch
without any split point) keeps the same rule with a heap over linked pairs, which is as exact.

Defined cases: a null or empty text has no ids, an empty string of ids, and decodes to no bytes. Rows without
doc_id and repeated rows are encoded like others.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.hashing import bytes_of, text_groups

#: Matches that a worker remembers in each of two generations (about 250 bytes each), and the longest of them.
CACHE_WORDS = 300_000
LONGEST = 64
LONG_ROW = 4096
#: Cells of one matrix.
CELLS = 1 << 20
_NONE = np.int32(1 << 30)

_codecs: dict[bytes, Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """The worker's codec for a rank file; later tasks of the worker find its matches again."""
    key = hashlib.md5(content + pattern.encode(), usedforsecurity=False).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content, pattern)
    return _codecs[key]


class Spelling:
    """Byte strings by number, laid end to end, so that many are joined by one lookup."""

    def __init__(self, strings: list[bytes]) -> None:
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def __call__(self, numbers: np.ndarray) -> bytes:
        out = []
        for lo in range(0, len(numbers), 1 << 18):
            some = numbers[lo : lo + (1 << 18)]
            sizes = self.sizes[some]
            ends = np.cumsum(sizes)
            at = np.repeat(self.begins[some] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
            out.append(self.data[at].tobytes())
        return b"".join(out)


class Codec:
    def __init__(self, content: bytes, pattern: str) -> None:
        import regex

        self._split = regex.compile(pattern).findall
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}
        top = max(ranks.values()) + 1
        by_id = [b""] * top
        for token, rank in ranks.items():
            by_id[rank] = token
        self.bytes = Spelling(by_id)
        self.decimals = Spelling([b"%d," % k for k in range(top)])
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {
            (ranks[t[:k]] << 32) | ranks[t[k:]]: r
            for t, r in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        }
        self._table(np.array(list(pairs), np.uint64), np.array(list(pairs.values()), np.int32))
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Linear probing in a table four times as large as its content."""
        self._bits = np.uint64(64 - max(4, int(4 * len(keys) - 1).bit_length()))
        size = 1 << (64 - int(self._bits))
        self._mask = size - 1
        self._keys, self._values = np.full(size, np.uint64((1 << 64) - 1)), np.full(size, _NONE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            empty = left[self._keys[slot[left]] == np.uint64((1 << 64) - 1)]
            spots, first = np.unique(slot[empty], return_index=True)
            self._keys[spots], self._values[spots] = keys[empty[first]], values[empty[first]]
            left = np.setdiff1d(left, empty[first], assume_unique=True)
            slot[left] = (slot[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self._bits).astype(np.int64)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token, which is also the rank, that each pair merges to; _NONE where it merges to none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._values[slot], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64((1 << 64) - 1)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self._mask
            found = self._keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[slot[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64((1 << 64) - 1))]
        return out

    def _rows(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of one length, from a matrix that loses a column every round."""
        width = len(words[0])
        token = self._byte[np.frombuffer(b"".join(words), np.uint8)].reshape(-1, width)
        rank = self._merged(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(-1, width - 1)
        out: list = [None] * len(words)
        row = np.arange(len(words))
        while True:
            at = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)  # the leftmost of the least
            each = np.arange(len(row))
            best = rank[each, at] if rank.shape[1] else np.full(len(row), _NONE)
            done = best == _NONE
            if done.any():
                ids = token[done].astype("<u4")
                for k, r in enumerate(row[done].tolist()):
                    out[r] = ids[k]
                live = ~done
                token, rank, row, at, best = token[live], rank[live], row[live], at[live], best[live]
                each = np.arange(len(row))
            if not len(row):
                return out
            columns = np.arange(token.shape[1] - 1)[None, :]
            token[each, at] = best
            token = np.where(columns <= at[:, None], token[:, :-1], token[:, 1:])  # drop the pair's right part
            rank = np.where(columns[:, :-1] < at[:, None], rank[:, :-1], rank[:, 1:])
            after = np.flatnonzero(at < token.shape[1] - 1)
            if len(after):
                rank[after, at[after]] = self._merged(token[after, at[after]], token[after, at[after] + 1])
            before = np.flatnonzero(at > 0)
            if len(before):
                rank[before, at[before] - 1] = self._merged(token[before, at[before] - 1], token[before, at[before]])

    def _long(self, word: bytes) -> np.ndarray:
        token = self._byte[np.frombuffer(word, np.uint8)].astype(np.int64)
        rank = self._merged(token[:-1], token[1:])
        heap = [(r, k) for k, r in enumerate(rank.tolist()) if r != _NONE]
        heapq.heapify(heap)
        ids, after, before = token.tolist(), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        last = len(word)

        def pair(k: int) -> int:
            return int(self._merged(np.array([ids[k]]), np.array([ids[after[k]]]))[0])

        while heap:
            r, k = heapq.heappop(heap)
            if ids[k] < 0 or after[k] >= last or pair(k) != r:
                continue
            gone = after[k]
            ids[k], ids[gone], after[k] = r, -1, after[gone]
            if after[k] < last:
                before[after[k]] = k
                if (new := pair(k)) != _NONE:
                    heapq.heappush(heap, (new, k))
            if before[k] >= 0 and (new := pair(before[k])) != _NONE:
                heapq.heappush(heap, (new, before[k]))
        return np.array([x for x in ids if x >= 0], "<u4")

    def _encoded(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        groups: dict[int, list[str]] = {}
        raw = {w: w.encode() for w in words}
        for w, b in raw.items():
            groups.setdefault(len(b), []).append(w)
        for size, group in sorted(groups.items()):
            if size > LONG_ROW:
                yield from ((w, self._long(raw[w]).tobytes()) for w in group)
                continue
            if size == 1:
                yield from ((w, self._byte[raw[w][0]].astype("<u4").tobytes()) for w in group)
                continue
            step = max(1, CELLS // size)
            for lo in range(0, len(group), step):
                some = group[lo : lo + step]
                for w, ids in zip(some, self._rows([raw[w] for w in some]), strict=True):
                    yield w, ids.tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts."""
        split = [self._split(t) for t in texts]
        if len(self._known) > CACHE_WORDS:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        new = set().union(*split).difference(known)
        known.update([(w, older[w]) for w in new if w in older])
        long: dict[str, bytes] = {}
        for w, ids in self._encoded(list(new.difference(known))):
            (known if len(w) <= LONGEST else long)[w] = ids
        ids = known | long if long else known
        return [np.frombuffer(b"".join(map(ids.__getitem__, words)), "<u4") for words in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes(ids)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids, n_tokens, ids_text, decoded): each whole text encoded, and its ids decoded again.

    ids are little-endian unsigned 32-bit integers, ids_text the same in decimal with commas.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())  # one vocabulary
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        bpe = codec(content.value, pattern)
        for batch in batches:
            raw, at = bytes_of(batch.column("text"))
            for i, j in text_groups(at):
                every = bpe.encode([raw[at[k] : at[k + 1]].tobytes().decode("utf-8", "replace") for k in range(i, j)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(i, j - i),
                        "ids": pa.array([x.tobytes() for x in every], pa.binary()),
                        "n_tokens": pa.array([len(x) for x in every], pa.int64()),
                        "ids_text": pa.array([bpe.decimals(x)[:-1] for x in every], pa.binary()),
                        "decoded": pa.array([bpe.decode(x) for x in every], pa.binary()),
                    }
                )

    return texts.mapInArrow(run, "doc_id long, ids binary, n_tokens long, ids_text binary, decoded binary")
