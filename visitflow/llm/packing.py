"""Cost-balanced packing of token ids into sequences of bounded length.

Each task packs the documents it reads, TOGETHER tokens at a time, without a shuffle. A document longer
than a sequence gives whole sequences; its rest, and each shorter document, is one item. The cost of an
item is linear plus quadratic in its tokens, as attention within a document is. Items go in descending
order of cost to the sequence of the lowest cost that has room for the whole item; where none has, the
item is cut and the part that fits goes to the lowest-cost sequence with room left. The sequences of a group
are as many full ones as its tokens fill, and the few tokens beyond get sequences of the powers of two
that sum up to them, so nothing is padded.

Defined cases: a null or empty text is the end id alone. Rows without doc_id and repeated rows are packed
like others. Every id lies in one piece. sequence_id is unique, not gapless: the task's number times 2**32
plus a count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared, tokens
from visitflow.llm.hashing import bytes_of, text_groups

#: Tokens packed together, at most, but for one document more. Bounds a task's memory.
TOGETHER = 1 << 22
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long"
)


def packed(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 1024
) -> DataFrame:
    """Rows of pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens)."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    vocabulary = tokens.vocabulary(docs.sparkSession, path)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        encode = tokens.encoder(vocabulary.value)
        number = TaskContext.get().partitionId() << 32
        ids, held, total = [], [], 0
        for batch in batches:
            raw, at = bytes_of(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            for i, j in text_groups(at):
                texts = [raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)]
                for name, found in zip(names[i:j], encode.many(texts), strict=True):
                    ids.append(name)
                    held.append(np.append(found, found.dtype.type(end_id)))
                    total += len(held[-1])
                    if total >= TOGETHER:
                        yield from _pieces(ids, held, number, capacity, linear, quadratic)
                        number += total // capacity + capacity.bit_length()
                        ids, held, total = [], [], 0
        if ids:
            yield from _pieces(ids, held, number, capacity, linear, quadratic)
        encode.forget()

    return texts.mapInArrow(shared.released(run), PIECES)


def placed(sizes: np.ndarray, capacity: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """Where items go: (item, start in the item, length, sequence, offset in the sequence)."""
    total = int(sizes.sum())
    tail = [1 << b for b in range(capacity.bit_length() - 2, -1, -1) if total % capacity >> b & 1]
    room = np.array([capacity] * (total // capacity) + tail, np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    start = np.zeros(len(sizes), np.int64)

    def put(item: int, sequence: int, length: int) -> tuple[int, int, int, int, int]:
        out = (item, int(start[item]), length, sequence, int(used[sequence]))
        start[item] += length
        used[sequence] += length
        room[sequence] -= length
        cost[sequence] += linear * length + quadratic * length * length
        return out

    free = 0
    for item in np.flatnonzero(sizes >= capacity).tolist():
        for _ in range(int(sizes[item]) // capacity):
            yield put(item, free, capacity)
            free += 1
    rest = sizes - start
    for item in np.argsort(-rest, kind="stable").tolist():
        left = int(rest[item])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            sequence = int(np.where(fits, cost, np.inf).argmin())
            length = min(left, int(room[sequence]))
            yield put(item, sequence, length)
            left -= length


def _pieces(names, held, number, capacity, linear, quadratic) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(x) for x in held], np.int64)
    item, start, length, sequence, offset = (
        np.array(x, np.int64) for x in zip(*placed(sizes, capacity, linear, quadratic), strict=True)
    )
    filled = np.bincount(sequence, weights=length).astype(np.int64)
    crc = [
        zlib.crc32(held[k][s : s + n].astype("<u4").tobytes())
        for k, s, n in zip(item.tolist(), start.tolist(), length.tolist(), strict=True)
    ]
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([names[k] for k in item.tolist()], pa.int64()), "start": pa.array(start),
            "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(sizes[item]),
            "sequence_id": pa.array(sequence + number), "offset": pa.array(offset),
            "sequence_tokens": pa.array(filled[sequence]),
        }
    )
