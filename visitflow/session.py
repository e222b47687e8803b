"""Session settings for applications, and where intermediate tables are kept.

`tune` is called by the application, once; no operator changes a setting or needs one for its results.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Re-plan joins and partition counts from the sizes seen at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a join partition that one key dominates, even when that costs another exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_own: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_scratch: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark not in _own:
        _own[spark] = tempfile.mkdtemp(prefix="visitflow-")
    return _own[spark]


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables that `stored` writes in this block go to a folder of their own, which is deleted at its end.

    So frames made in the block are read, or written, in it.
    """
    outer, files = _scratch.get(spark), spark._jvm.org.apache.hadoop.fs.Path
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _scratch[spark] = path
    try:
        yield path
    finally:
        if outer is None:
            del _scratch[spark]
        else:
            _scratch[spark] = outer
        files(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(files(path), True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write rows to a path of their own in the shared folder and read them back.

    Later readers neither recompute them nor lose them with an executor. They stay until the application clears
    the shared folder, or until the end of the `scratch` block that they were written in.
    """
    spark = df.sparkSession
    path = f"{_scratch.get(spark) or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
