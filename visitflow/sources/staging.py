"""How frames that several steps read are kept.

A plan passes every such frame through a `stage` function, by name. By default an extract stores them
(`written`), so later steps neither recompute them nor depend on executors that may be lost.

- `written(folder, extract)` stores frames as parquet in a folder all executors share, below a path
  that belongs to this extract and this run alone, and never overwrites;
- `resumable(spark, folder, extract, parameters)` does so under a path that a later run with the same
  parameters finds again, and keeps a record of each finished stage;
- `inline` leaves everything in one lazy plan;
- `verified(keys, then)` additionally refuses duplicate keys, as the source system did at each stage; the
  check reads what is kept.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from visitflow.operators.checks import assert_unique
from visitflow.session import scratch, shared_dir
from visitflow.sources.commits import Files

Stage = Callable[[str, DataFrame], DataFrame]


def inline(name: str, df: DataFrame) -> DataFrame:
    return df


def written(folder: str, extract: str) -> Stage:
    run = f"{folder.rstrip('/')}/{extract}-{uuid.uuid4().hex}"

    def stage(name: str, df: DataFrame) -> DataFrame:
        path = f"{run}/{name}.parquet"
        df.write.mode("error").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return stage


@contextlib.contextmanager
def resumable(spark: SparkSession, folder: str, extract: str, parameters: Mapping[str, object]) -> Iterator[Stage]:
    """A stage function for one run of an extract, in a block that ends when its rows are loaded.

    A finished stage is recorded with the fingerprint of what it was made from: the extract's parameters and
    the names, sizes and times of all files its frame reads, those of earlier stages among them. A run that
    was stopped leaves its stages and records; the next one with the same parameters reads each stage whose record
    still fits and computes the others. When the block ends without an error the run's folder is deleted, and
    what operators stored on the way is deleted in any case.

        with resumable(spark, "/shared/runs", "infusion", {"day": run_date, "site": site}) as stage:
            rows = infusion.report(wh, run_date, departments, load_ts, stage=stage)
            load.reload(infusion.table_rows(rows), contract, sink)
    """
    stated = json.dumps({k: str(v) for k, v in parameters.items()}, sort_keys=True)
    run = f"{folder.rstrip('/')}/{extract}-{hashlib.sha256(stated.encode()).hexdigest()[:16]}"
    files = Files(spark, run)

    def stage(name: str, df: DataFrame) -> DataFrame:
        path, record = f"{run}/{name}.parquet", f"{run}/_{name}.json"
        made_from = hashlib.sha256((stated + _inputs(files, df) + df.schema.json()).encode()).hexdigest()
        if not files.exists(record) or files.read(record) != made_from:
            files.delete(record)  # first, so that no record tells of another stage's rows
            df.write.mode("overwrite").parquet(path)
            files.write(f"{record}.draft", made_from)
            files.move(f"{record}.draft", record)
        return spark.read.schema(df.schema).parquet(path)

    with scratch(spark):
        yield stage
    files.delete(run)


def _inputs(files: Files, df: DataFrame) -> str:
    return json.dumps([files.state(path) for path in sorted(df.inputFiles())])


def usual(spark: SparkSession, extract: str, stage: Stage | None) -> Stage:
    """The given stage, or storing in the shared folder."""
    return written(shared_dir(spark), extract) if stage is None else stage


def verified(keys: Mapping[str, Sequence[str]], then: Stage) -> Stage:
    def stage(name: str, df: DataFrame) -> DataFrame:
        kept = then(name, df)
        return assert_unique(kept, keys[name]) if name in keys else kept

    return stage
