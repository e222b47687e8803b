"""Lempel-Ziv phrase fingerprints of texts, and their likeness.

A text's UTF-8 bytes are parsed from left to right into phrases: each phrase is the longest one already in
the text's own dictionary and one byte more, and joins the dictionary. The set of phrases is what a
dictionary compressor would learn, so two texts whose sets overlap compress each other. Phrases are hashed
to 64 bits; the hashes fall into BINS bins by their top bits, and the signature keeps the smallest of each bin,
as 16 bits (one-permutation minimum hashing). The fingerprint is the signature in hexadecimal, FFFF for a
bin without phrases. Likeness is the share of equal bins among those that either text fills: an estimate of
the Jaccard likeness of the phrase sets with a standard error of at most 0.045.

Parsing is sequential, so what two texts share from their beginning is parsed once (`Parse.fork`).

Defined cases: null and empty texts have no phrases; two such texts have likeness 1, one of them and another
text 0. Documents are in order of doc_id, then text; one without doc_id comes first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared
from visitflow.llm.hashing import mix, span_hashes

BINS = 128
_EMPTY = np.uint64((1 << 64) - 1)


class Parse:
    """A text parsed so far; add() goes on with more bytes."""

    def __init__(self) -> None:
        self._next: dict[int, int] = {}
        self._node = 0
        self._open = b""
        self.least = np.full(BINS, _EMPTY)

    def fork(self) -> Parse:
        other = Parse()
        other._next, other._node, other._open = self._next.copy(), self._node, self._open
        other.least = self.least.copy()
        return other

    def add(self, data: bytes) -> Parse:
        following, node, size = self._next, self._node, len(self._next)
        get, ends, ahead = following.get, [], len(self._open)
        end = ends.append
        for i, byte in enumerate(data, ahead + 1):
            step = node | byte
            node = get(step)
            if node is None:
                size += 1
                following[step] = size << 8
                end(i)
                node = 0
        self._node = node
        data = self._open + data
        last = ends[-1] if ends else 0
        self._open = data[last:]
        if ends:
            ends = np.array(ends, np.int64)
            hashes = span_hashes(np.frombuffer(data, np.uint8), np.append(0, ends[:-1]), ends)
            hashes.sort()
            bins, first = np.unique(hashes >> np.uint64(57), return_index=True)
            bins = bins.astype(np.int64)
            self.least[bins] = np.minimum(self.least[bins], hashes[first])
        return self

    def codes(self) -> np.ndarray:
        return np.where(self.least == _EMPTY, 0xFFFF, mix(self.least) % np.uint64(0xFFFF)).astype(np.uint16)


def fingerprint(text: str) -> str:
    return as_text(Parse().add(text.encode()).codes())


def as_text(codes: np.ndarray) -> str:
    return codes.astype(">u2").tobytes().hex()


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    used = (left != 0xFFFF) | (right != 0xFFFF)
    return float((left == right)[used].mean()) if used.any() else 1.0


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the next.

    The edited text has the last quarter of the characters replaced by the first as many, or all, of the next
    document, in ascending doc_id; the first follows the last. Texts are dealt once, into ranges of doc_id,
    and the first document of each range also goes to the range before.
    """
    least = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = 4 * shared.parts(docs.sparkSession)
    bounds = np.array(shared.range_bounds(rows, "doc_id", n), np.int64)

    def first_ids(batches):
        for batch in batches:
            ids = np.unique(batch.column("doc_id").fill_null(least).to_numpy())
            part, at = np.unique(np.searchsorted(bounds, ids, "right"), return_index=True)
            yield pa.RecordBatch.from_pydict({"part": pa.array(part.astype(np.int32)), "id": pa.array(ids[at])})

    found = rows.select("doc_id").mapInArrow(first_ids, "part int, id long").groupBy("part").agg(F.min("id").alias("id"))
    firsts = sorted((r.part, r.id) for r in found.collect())  # one row for each range
    before = {own[1]: firsts[k - 1][0] for k, own in enumerate(firsts)}

    def dealt(batches):
        for batch in batches:
            ids = batch.column("doc_id").fill_null(least).to_numpy()
            part = np.searchsorted(bounds, ids, "right").astype(np.int32)
            guest = np.array([k for k, x in enumerate(ids.tolist()) if x in before], np.int64)
            rows = pa.array(np.concatenate([np.arange(len(ids)), guest]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([part, np.array([before[x] for x in ids[guest].tolist()], np.int32)])),
                    pa.array(np.repeat([False, True], [len(ids), len(guest)])),
                    batch.column("doc_id").take(rows), batch.column("text").take(rows),
                ],
                ["part", "guest", "doc_id", "text"],
            )

    sorted_rows = (
        rows.mapInArrow(dealt, "part int, guest boolean, doc_id long, text string")
        .repartitionById(n, "part")  # a range is a task
        .sortWithinPartitions("part", "guest", F.asc_nulls_first("doc_id"), "text")
    )
    return sorted_rows.mapInArrow(_compared, OUT)


class _Document:
    def __init__(self, name, text: str) -> None:
        self.name, self.text = name, text
        self.quarter = len(text) // 4
        self.kept = text[: len(text) - self.quarter].encode()
        self.start = Parse().add(self.kept)
        self.codes = self.start.fork().add(text[len(text) - self.quarter :].encode()).codes()

    def row(self, following: _Document) -> tuple:
        more = following.text[: self.quarter].encode()
        edited = self.start.add(more).codes()
        return (
            self.name, len(self.text), hashlib.sha256(self.kept + more).hexdigest(), as_text(self.codes),
            as_text(edited), likeness(self.codes, edited), likeness(self.codes, following.codes),
        )


def _compared(batches):
    part, waiting = None, None
    for batch in batches:
        out = []
        parts, guests = batch.column("part").to_pylist(), batch.column("guest").to_pylist()
        names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        for k, (p, guest) in enumerate(zip(parts, guests, strict=True)):
            if p != part:
                part, waiting = p, None
            if guest and waiting is None:
                continue  # only the first guest is the next document
            here = _Document(names[k], texts[k].as_py())
            if waiting is not None:
                out.append(waiting.row(here))
            waiting = None if guest else here
        names = [field.split()[0] for field in OUT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names=names
        )
