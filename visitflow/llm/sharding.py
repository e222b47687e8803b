"""Contiguous shards of near-equal bytes, cut from global prefix sums.

Rows are ordered by their keys and dealt into ranges; each range sums its own sizes, the totals of the
ranges give every row the bytes before it, and the total is cut at equal targets. A row goes to the shard
that holds its middle byte, so shards differ by no more than one row's size. No group, however common its
key or text, is brought together, and no text is moved.

Defined cases: a null text counts no bytes. Rows without doc_id come first; rows with the same doc_id are in
order of checksum and size, and rows alike in all of these in any order. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared


def with_shards(rows: DataFrame, size: str, keys: list[str], shards: int) -> DataFrame:
    """Add `shard` (0 to shards - 1) and `slot` (0, 1, ... in the shard) to rows in the order of keys.

    Columns of these two names are replaced; others stay, whatever their names.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    whole = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
        F.col(f"`{size}`").cast("long").alias("_size"),
        *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
    )
    ranked = shared.stored(shared.with_rank(whole, names, "_size"), "ranked")
    total = ranked.agg(F.sum("_size")).first()[0] or 1
    middle = f"cast((2 * before + _size) * {shards}L div {2 * total}L AS int)"
    cut = ranked.withColumn("shard", F.least(F.lit(shards - 1), F.expr(middle)))
    begins = cut.groupBy("shard").agg(F.min("position").alias("_begin"))  # one row for each shard
    kept = [F.col(f"_row.`{c}`") for c in rows.columns if c not in ("shard", "slot")]
    return cut.join(begins, "shard").select(*kept, "shard", (F.col("position") - F.col("_begin")).alias("slot"))


def sized(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, size, text_crc32): UTF-8 bytes of the text plus 1, and their unsigned checksum."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def document_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot)."""
    return with_shards(sized(docs), "size", ["doc_id", "text_crc32", "size"], shards)


def write(docs: DataFrame, folder: str, shards: int) -> None:
    """Write the documents as Parquet, one folder for each shard; every task writes one range of a shard."""
    text = F.coalesce("text", F.lit(""))
    sized_rows = docs.withColumn("_size", (F.octet_length(text) + 1).cast("long"))
    placed = with_shards(sized_rows, "_size", ["doc_id", "_size"], shards).drop("_size")
    ordered = placed.repartitionByRange(shared.parts(docs.sparkSession), "shard", "slot")
    ordered.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


#: crc32 by its polynomial, over the bytes of each text.
ORACLE_SQL = """
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), sized AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size FROM documents
), summed AS (
  SELECT doc_id, size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM sized, steps
), placed AS (
  SELECT *, sum(size) OVER w - size AS before, sum(size) OVER () AS total, row_number() OVER w - 1 AS position
  FROM summed WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), cut AS (
  SELECT *, least(7, (2 * before + size) * 8 // (2 * total)) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  (position - min(position) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""
