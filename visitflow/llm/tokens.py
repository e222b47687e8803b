"""Encoding of texts with a tokenizers-library file, inside tasks.

All ids come from the library; what repeats is looked up. With a file whose normaliser and splitter are
the known ones (KNOWN), neither looks beyond white space, so a text's ids are the ids of its words (runs of
bytes other than space and \\t to \\r) one after another, and a plain word, of ASCII without apostrophes, is split between letters,
single digits and other marks. Words and such pieces are encoded once and remembered. Words that hold an
added token's string go to the library whole, as it finds such strings before it splits. Texts for any
other file, or one whose added tokens hold white space, are encoded whole. Tests compare whole texts with
the library's own result.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from visitflow.llm.hashing import _windows as windows
from visitflow.llm.hashing import span_hashes

#: Pieces that a worker remembers (about 40 bytes each), and those of them that are kept apart, to be sorted in later.
REMEMBERED, RECENT = 1_000_000, 50_000
#: A control character that stands between words that are encoded together; it is one token.
MARK = "\x01"

#: The normaliser and splitter of the tokenizer file for which words may be encoded apart.
KNOWN = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Kinds of bytes: white space, letters, digits, other marks, and what makes a word not plain.
_LETTER, _DIGIT, _ODD = 1, 2, 4
_KINDS = np.full(256, 4, np.uint8)
_KINDS[[32, *range(9, 14)]] = 0
_KINDS[[c for c in range(33, 127) if c != 39]] = 3
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[48:58] = _DIGIT
#: Second bytes, after 0xC3, of the small letters from U+00DF to U+00FF: their own lower case, and composed already.
_SMALL = np.zeros(256, bool)
_SMALL[[c for c in range(0x9F, 0xC0) if c != 0xB7]] = True
#: The character by which a byte-level model knows each byte: itself if printable, else one from U+0100 on.
_SHOWN = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
_CHARACTERS = {c: 256 + k for k, c in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_encoders: dict[bytes, Encoder] = {}


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's content for all tasks; its size is that of one vocabulary."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def encoder(content: bytes) -> Encoder:
    """The worker's encoder for a tokenizer file; later tasks of the worker find its words again."""
    key = hashlib.md5(content, usedforsecurity=False).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(content)
    return _encoders[key]


class Encoder:
    def __init__(self, content: bytes) -> None:
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(content.decode())
        self.size = self._library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        stated = json.loads(content)
        added = [t["content"] for t in stated.get("added_tokens") or []]
        self._apart = all(stated.get(k) == v for k, v in KNOWN.items()) and not any(re.search(r"\s", t) for t in added)
        self._added = [t.lower().encode() for t in added]
        self._mark = self._library.encode(MARK, add_special_tokens=False).ids
        self.forget()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _encoded(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of words that may hold anything, from library calls over many with a mark between them."""
        out, mark = [], MARK.encode()
        for lo in range(0, len(words), 2000):
            some = [w.decode("utf-8", "replace") for w in words[lo : lo + 2000]]
            (ids,) = self._ids([f" {MARK} ".join(some)])
            ends = np.flatnonzero(ids == self._mark[0])
            if len(ends) != len(some) - 1 or any(mark in w for w in words[lo : lo + 2000]):
                out += self._ids(some)
            else:
                parts = np.split(ids, ends)
                out += [parts[0], *[x[1:] for x in parts[1:]]]
        return out

    def _learn(self, new: list[bytes], plain: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces not met before, one after another, and how many each has. Plain pieces need no
        normalising, so the library's model encodes them at once."""
        encode = self._library.model.tokenize
        whole = iter(self._encoded([w for w, p in zip(new, plain, strict=True) if not p]))
        found = [[t.id for t in encode(w.decode("latin-1").translate(_CHARACTERS))] if p else next(whole).tolist() for w, p in zip(new, plain, strict=True)]
        sizes = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), self.kind, int(sizes.sum())), sizes

    def forget(self) -> None:
        """Give back the memory of remembered pieces."""
        self._tables = [_Table(self.kind), _Table(self.kind)]

    def __call__(self, text: bytes) -> np.ndarray:
        """The ids of a whole text, as unsigned integers of self.kind."""
        return self.many([text])[0]

    def many(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of whole texts."""
        if not self._apart or len(self._mark) != 1:
            return self._ids([t.decode("utf-8", "replace") for t in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        at = np.cumsum([0] + [len(t) for t in texts])
        ids, sizes, starts = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p, q in windows(raw, at):
            begins, ends, plain, lower = self._pieces(raw[p:q], at[np.searchsorted(at, p, "right") : np.searchsorted(at, q)] - p)
            some, n = self._looked_up(lower, begins, ends, plain)
            ids.append(some)
            sizes.append(n)
            starts.append(begins + p)
        before = np.append(0, np.cumsum(np.concatenate(sizes)))
        cuts = before[np.searchsorted(np.concatenate(starts), at)].tolist()
        every = np.concatenate(ids)
        return [every[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]

    def _pieces(self, raw: np.ndarray, breaks: np.ndarray):
        """Where pieces begin and end, which are plain, and the bytes with plain words lower-cased.

        A piece is a run of letters, a digit, or a run of other marks in a plain word, or a whole other word.
        """
        kinds = _KINDS[raw]
        lead = np.flatnonzero((raw[:-1] == 0xC3) & _SMALL[raw[1:]])
        kinds[lead], kinds[lead + 1] = _LETTER, _LETTER
        inside = kinds > 0
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        begins[breaks], closes[breaks - 1] = inside[breaks], inside[breaks - 1]
        word = np.cumsum(begins) - 1
        plain = np.ones(max(1, int(begins.sum())), bool)
        plain[word[kinds == _ODD]] = False
        lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        small = lower.tobytes() if self._added else b""
        for token in self._added:
            k = small.find(token)
            while k >= 0:
                plain[word[k]] = False
                k = small.find(token, k + 1)
        cut = inside & plain[word]  # within plain words, where the kind changes, and at each digit
        cut[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        starts = np.flatnonzero(begins | cut)
        of = word[starts]
        ends = np.append(starts[1:], 0)
        last = np.append(of[1:] != of[:-1], True)[: len(of)]
        ends = np.where(last, (np.flatnonzero(closes) + 1)[of], ends[: len(of)])
        odd = np.flatnonzero(~plain)
        if len(odd):
            held = inside & ~plain[word]
            lower[held] = raw[held]
        return starts, ends, plain[of], lower

    def _looked_up(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, plain: np.ndarray):
        """The ids of pieces one after another, and how many each has."""
        names, first, place = np.unique(span_hashes(raw, begins, ends), return_index=True, return_inverse=True)
        old, recent = self._tables
        at, sizes = np.zeros(len(names), np.int64), np.full(len(names), -1)
        for table, beyond in ((old, 0), (recent, len(old.ids))):
            hit, row = table.rows(names)
            at[hit], sizes[hit] = table.starts[row] + beyond, table.sizes[row]
        new = np.flatnonzero(sizes < 0)
        spots = first[new].tolist()
        ids, n = self._learn([raw[begins[k] : ends[k]].tobytes() for k in spots], plain[first[new]].tolist())
        at[new], sizes[new] = len(old.ids) + len(recent.ids) + np.cumsum(n) - n, n
        flat = np.concatenate([old.ids, recent.ids, ids])
        sizes, at = sizes[place], at[place]
        total = np.cumsum(sizes)
        out = flat[np.repeat(at - total + sizes, sizes) + np.arange(int(total[-1]) if len(total) else 0)]
        recent.add(names[new], ids, n)
        if len(recent.names) > RECENT:
            old.add(recent.names, recent.ids[recent.order()], recent.sizes)
            self._tables[1] = _Table(self.kind)
            if len(old.names) > REMEMBERED:
                old.keep_used()
        return out, sizes


class _Table:
    """Ids by the hash of a piece; names are sorted."""

    def __init__(self, kind: np.dtype) -> None:
        self.names, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(0, kind), np.zeros(0, bool)

    def rows(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the names are here, and in which rows."""
        if not len(self.names):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        hit = np.flatnonzero(self.names[row] == names)
        self.used[row[hit]] = True
        return hit, row[hit]

    def add(self, names: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        every = np.concatenate([self.names, names])
        order = np.argsort(every, kind="stable")
        self.names = every[order]
        self.starts, self.sizes = np.concatenate([self.starts, starts])[order], np.concatenate([self.sizes, sizes])[order]
        self.used = np.concatenate([self.used, np.ones(len(names), bool)])[order]
        self.ids = np.concatenate([self.ids, ids])

    def order(self) -> np.ndarray:
        """Places of the ids in the order of the names."""
        total = np.cumsum(self.sizes)
        return np.repeat(self.starts - total + self.sizes, self.sizes) + np.arange(int(total[-1]) if len(total) else 0)

    def keep_used(self) -> None:
        """Forget what was not asked for since the last time."""
        ids = self.ids[self.order()][np.repeat(self.used, self.sizes)]
        self.names, self.sizes = self.names[self.used], self.sizes[self.used]
        self.starts, self.ids = np.cumsum(self.sizes) - self.sizes, ids
        self.used = np.zeros(len(self.names), bool)
