"""What several operators need: stored intermediate tables, ordered parts, and graph components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents in one Arrow batch of the registered queries and the pipeline.
BATCH_ROWS = 2000

_scratch: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_folders: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_shipped: weakref.WeakSet = weakref.WeakSet()


def ready(spark: SparkSession) -> SparkSession:
    """What an application does once, as the registered queries and the pipeline do; operators do not.

    It sends this package to the executors, for sessions whose workers cannot import it, and lets Arrow
    batches hold fewer rows, as rows with texts are wide.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="visitflow-code-")) / "visitflow_llm.zip"
        with zipfile.ZipFile(archive, "w") as z:
            z.write(root / "visitflow" / "__init__.py", "visitflow/__init__.py")
            for source in sorted(Path(__file__).parent.glob("*.py")):
                z.write(source, f"visitflow/llm/{source.name}")
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(spark)
    return spark


def folder(spark: SparkSession) -> str:
    """A folder of this run below spark.checkpoint.dir, which all executors share.

    Only a local master may have none set; it gets a temporary one. The caller's application clears
    the checkpoint folder when its results are written.
    """
    known = _folders.get(spark)
    if known is None:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="visitflow-llm-")
        known = _folders[spark] = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    return known


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back: lineage ends here."""
    spark = df.sparkSession
    path = f"{_scratch.get(spark) or folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(frame: DataFrame) -> None:
    """Delete a stored table that nothing will read again."""
    delete(frame.sparkSession, frame._stored_path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables stored in this block go to a folder of their own, whose path it gives."""
    outer = _scratch.get(spark)
    _scratch[spark] = f"{folder(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield _scratch[spark]
    finally:
        _scratch[spark] = outer


def released(run):
    """A task function that gives memory back to the system when it ends.

    Workers are used again, and what a task's buffers leave in the allocators would add up over the steps
    of a long run.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def release() -> None:
    """Give memory that this process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def words_of(text: Column) -> Column:
    """Words of a text: runs of characters other than space and \\t to \\r; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def with_rank(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Add `position` (0, 1, ... in the order of keys) and, with a weight, `before` (weights that precede).

    Rows are dealt into ranges of the keys; each range numbers its own rows, and only one count and one
    sum per range are gathered. Rows equal in all keys may come in either order.
    """
    spark = df.sparkSession
    measure = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    ranged = stored(
        df.withColumn("_w", measure)
        .repartitionByRange(parts(spark), *keys)
        .withColumn("_part", F.spark_partition_id()),
        "ranged",
    )
    totals = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_w").alias("_sum"))
    window = "(ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.select(  # one row for each range: as many as shuffle partitions
        "_part",
        F.expr(f"coalesce(sum(_n) OVER {window}, 0)").alias("_rows"),
        F.expr(f"coalesce(sum(_sum) OVER {window}, 0)").alias("_before"),
    )
    inside = "(PARTITION BY _part ORDER BY " + ", ".join(f"`{k}`" for k in keys)
    out = ranged.withColumn("_i", F.expr(f"row_number() OVER {inside})")).withColumn(
        "_sofar", F.expr(f"sum(_w) OVER {inside} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    )
    out = out.join(offsets, "_part").withColumn("position", F.col("_rows") + F.col("_i") - 1)
    if weight:
        out = out.withColumn("before", F.col("_before") + F.col("_sofar") - F.col("_w"))
    return out.drop("_part", "_rows", "_before", "_i", "_sofar", "_w")


EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """Whole numbers that cut the values of key into about n equal ranges."""
    shares = ", ".join(str(k / n) for k in range(1, n)) or "0.5"
    row = df.select(F.expr(f"percentile_approx(cast(`{key}` AS long), array({shares}), {max(10_000, 10 * n)})")).first()
    return sorted(set(row[0] or []))


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of undirected edges (a, b); root is the smallest node it can reach.

    Alternating large-star and small-star steps, a logarithmic number of rounds in practice. Each step is
    a grouping that combines before the shuffle and a join that adaptive execution can split, so a node
    with very many edges is no single task's work. Every round is stored.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stored(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        before, now = now, stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(before)
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (row[0], row[1])
