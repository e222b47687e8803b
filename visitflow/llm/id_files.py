"""Token ids in files of byte-aligned variable-length codes with separate control bytes.

A corpus folder holds two Parquet tables. `vocabulary` (rank, id) orders the ids by how often they occur in
the whole corpus. `blocks` holds, in ascending doc_id order, rows of neighbouring documents: their ids
and lengths, control bytes, and data bytes. An id is stored as its rank in as few bytes as that takes; its
number of bytes less one is in the control bytes, BITS[wide] bits an id, first id in the lowest bits. Each
document's control bytes begin with a whole byte, so documents can be read one by one. Decoding looks the
control bytes up in a table of lengths and never branches on an id.

Blocks are written by Spark's own writer, so a lost task leaves nothing half-written.

Defined cases: a null or empty text is the end id alone. A row without doc_id comes first. Rows with the same
doc_id are all kept, next to each other. An empty table gives a folder with no blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm import shared, tokens
from visitflow.llm.hashing import bytes_of, text_groups

#: Ids in a block, but for one document more.
BLOCK_IDS = 1 << 20
BLOCKS = (
    "part int, block int, first long, doc_ids array<long>, lengths array<long>, control binary, data binary"
)


class Codes:
    """Ranks to control and data bytes and back. `wide` vocabularies have more than 65,536 ids."""

    def __init__(self, wide: bool) -> None:
        self.bits = 2 if wide else 1
        self.each = 8 // self.bits
        byte = np.arange(256)[:, None] >> (self.bits * np.arange(self.each))[None, :]
        self.lengths = ((byte & (1 << self.bits) - 1) + 1).astype(np.int64)

    def encode(self, ranks: np.ndarray) -> tuple[bytes, bytes]:
        ranks = ranks.astype(np.uint32)
        size = 1 + sum((ranks >= np.uint32(1 << 8 * k)).astype(np.int64) for k in range(1, 1 << self.bits))
        padded = np.zeros(-(-len(ranks) // self.each) * self.each, np.uint8)
        padded[: len(ranks)] = size - 1
        shifted = padded.reshape(-1, self.each) << (self.bits * np.arange(self.each, dtype=np.uint8))
        control = np.bitwise_or.reduce(shifted, axis=1).astype(np.uint8).tobytes() if len(ranks) else b""
        four = np.ascontiguousarray(ranks.astype("<u4")).view(np.uint8).reshape(-1, 4)
        return control, four[np.arange(4)[None, :] < size[:, None]].tobytes()

    def control_bytes(self, lengths: np.ndarray) -> np.ndarray:
        return -(-lengths // self.each)

    def decode(self, control: bytes, data: bytes, lengths: np.ndarray) -> np.ndarray:
        """The ranks of neighbouring documents with these numbers of ids."""
        sizes = self.lengths[np.frombuffer(control, np.uint8)].ravel()
        whole = self.control_bytes(lengths) * self.each
        begin = np.repeat(np.cumsum(whole) - whole - np.cumsum(lengths) + lengths, lengths)
        sizes = sizes[begin + np.arange(int(lengths.sum()))]
        at = np.cumsum(sizes) - sizes
        raw = np.frombuffer(data + b"\0\0\0\0", np.uint8)
        out = raw[at].astype(np.uint32)
        for k in range(1, 1 << self.bits):
            more = sizes > k
            out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
        return out


def write(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> None:
    """Encode each whole text, end it with end_id, and write the corpus folder."""
    spark = docs.sparkSession
    vocabulary = tokens.vocabulary(spark, path)
    n = 4 * shared.parts(spark)
    bounds = shared.range_bounds(docs, "doc_id", n)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def encoded(batches):
        encode = tokens.encoder(vocabulary.value)
        for batch in batches:
            raw, at = bytes_of(batch.column("text"))
            for i, j in text_groups(at):
                some = encode.many([raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)])
                names = batch.column("doc_id").slice(i, j - i)
                part = np.searchsorted(bounds, names.fill_null(np.iinfo(np.int64).min).to_numpy(), "right")
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(part.astype(np.int32)), "doc_id": names,
                        "ids": pa.array([np.append(x, x.dtype.type(end_id)).tobytes() for x in some], pa.binary()),
                    }
                )

    ids = shared.stored(texts.mapInArrow(encoded, "part int, doc_id long, ids binary"), "ids")
    size = tokens.encoder(vocabulary.value).size
    kind = tokens.encoder(vocabulary.value).kind

    def counted(batches):
        seen = np.zeros(size, np.int64)
        for batch in batches:
            raw, _ = bytes_of(batch.column("ids"))
            seen += np.bincount(raw.view(kind), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"id": pa.array(at), "n": pa.array(seen[at])})

    counts = ids.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    often = {r.id: r.n for r in counts.collect()}  # one row for each id of the vocabulary, at most
    order = sorted(range(size), key=lambda k: (-often.get(k, 0), k))
    rank_of = np.empty(size, np.uint32)
    rank_of[order] = np.arange(size, dtype=np.uint32)
    schema = "rank int, id int"
    spark.createDataFrame(list(enumerate(order)), schema).coalesce(1).write.parquet(f"{folder}/vocabulary")
    codes = Codes(size > 1 << 16)

    def coded(batches):
        for batch in batches:
            raw, at = bytes_of(batch.column("ids"))
            ranks = rank_of[raw.view(kind)]
            at = at // kind.itemsize
            both = [codes.encode(ranks[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": batch.column("part"), "doc_id": batch.column("doc_id"), "n": pa.array(np.diff(at)),
                    "control": pa.array([c for c, _ in both], pa.binary()),
                    "data": pa.array([d for _, d in both], pa.binary()),
                }
            )

    rows = ids.mapInArrow(coded, "part int, doc_id long, n long, control binary, data binary")
    dealt = rows.repartitionById(n, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"))
    dealt.mapInArrow(_blocks, BLOCKS).write.option("compression", "zstd").parquet(f"{folder}/blocks")


_BLOCK_SCHEMA = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]
)


def _blocks(batches):
    """Rows sorted by part and doc_id, gathered into blocks; a block has rows of one part."""
    part, number, first = None, 0, 0
    names, lengths, control, data, total = [], [], [], [], 0

    def block():
        return pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip(
                (part, number, first, names, lengths, b"".join(control), b"".join(data)), _BLOCK_SCHEMA, strict=True
            )],
            schema=_BLOCK_SCHEMA,
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "control", "data")]
        for p, name, n, c, d in zip(*columns, strict=True):
            if names and (p != part or total >= BLOCK_IDS):
                yield block()
                first, number = first + total, number + 1
                names, lengths, control, data, total = [], [], [], [], 0
            if p != part:
                part, number, first = p, 0, 0
            names.append(name)
            lengths.append(n)
            control.append(c)
            data.append(d)
            total += n
    if names:
        yield block()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, ids), decoded from the files; start counts the ids before."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    ranked = spark.read.parquet(f"{folder}/vocabulary").orderBy("rank").collect()  # bounded by the vocabulary
    id_of = np.array([r.id for r in ranked], np.uint32)
    codes = Codes(len(id_of) > 1 << 16)

    def decoded(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[k].as_py(), np.int64)
                ranks = codes.decode(batch.column("control")[k].as_py(), batch.column("data")[k].as_py(), lengths)
                ids = id_of[ranks].astype("<u4")
                ends = np.cumsum(lengths)
                values = [ids[s:e].tobytes() for s, e in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(lengths), batch.column("part")[k].as_py(), np.int32)),
                        "doc_id": batch.column("doc_ids")[k].values,
                        "inside": pa.array(batch.column("first")[k].as_py() + ends - lengths),
                        "n_tokens": pa.array(lengths),
                        "ids_crc32": pa.array([zlib.crc32(v) for v in values], pa.int64()),
                        "ids": pa.array(values, pa.binary()),
                    }
                )

    rows = blocks.mapInArrow(decoded, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long, ids binary")
    totals = blocks.select("part", F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n"))
    before = totals.groupBy("part").agg(F.sum("n").alias("n")).select(  # one row for each range of doc_id
        "part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("ahead")
    )
    return rows.join(before, "part").select(
        "doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
