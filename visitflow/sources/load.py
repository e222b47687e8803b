"""Writing extracts: typed tables by contract, appends, reloads, refreshed days, and all-text flat files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from visitflow.functions.stamps import round_to_minute, stamp_literal, stamp_text
from visitflow.functions.text import blank
from visitflow.operators.checks import assert_new, assert_unique, keys_held
from visitflow.session import shared_dir
from visitflow.sources import commits
from visitflow.sources.contracts import Contract, SinkColumn

#: Buckets of a sink's key index.
BUCKETS = 16


def with_audit(df: DataFrame, tag: str, load_ts: datetime) -> DataFrame:
    return df.withColumns({"ETL_guid": F.lit(tag), "Load_Dte": stamp_literal(load_ts)})


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns in contract order and type.

    Text wider than its column, and null in a required column, fail the job that reads the rows.
    """
    out = []
    for column in contract.columns:
        value = F.col(f"`{column.name}`")
        if column.minute:
            value = round_to_minute(value)
        value = value.cast(column.type)
        if column.width is not None:
            message = F.concat(F.lit(f"text exceeds {column.width} in {column.name}: "), value)
            value = F.when(F.length(value) > column.width, _fail(message, column)).otherwise(value)
        if column.required:
            value = F.coalesce(value, _fail(F.lit(f"null in required {column.name}"), column))
        out.append(value.alias(column.name))
    return df.select(*out)


def _fail(message: Column, column: SinkColumn) -> Column:
    return F.raise_error(message).cast(column.type)


def create_table(spark: SparkSession, contract: Contract, table: str, path: str | None = None) -> None:
    """Drop and recreate an empty sink table, at a path of its own if one is given."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = spark.createDataFrame([], contract.schema()).write
    (writer.option("path", path) if path else writer).mode("overwrite").saveAsTable(table)


def append(
    df: DataFrame, contract: Contract, path: str, check: bool = True, within: Column | None = None
) -> None:
    """Add rows to what the sink holds.

    The rows are written once, beside the sink, their key is checked there and against the sink's key
    index, and then one commit makes them the sink's (see `commits`). A refused load leaves nothing behind.
    `within` limits which stored rows can share a key; it takes the rows themselves to tell, not the index.
    """
    _load(df, contract, path, check, replace=False, within=within)


def reload(df: DataFrame, contract: Contract, path: str, check: bool = True) -> None:
    """Replace what the sink holds; its files are deleted after the commit."""
    _load(df, contract, path, check, replace=True)


def refresh(
    df: DataFrame, contract: Contract, path: str, day: str, first: date, last: date, check: bool = True
) -> None:
    """Replace the rows of the visit days from first to last, in a sink laid out by the date of column `day`.

    The rows are the whole extract of these days. A visit that is not among them any more leaves its day. One
    that has moved in from another day leaves that day too: the key index tells which days hold such visits,
    and only those are written anew without them. Files of all other days stay as they are. A row of another
    day is refused. The first refresh makes the sink.
    """
    spark, log = df.sparkSession, commits.Log(df.sparkSession, path)
    now = log.newest()
    if now is not None and now.files and now.day != day:
        raise ValueError(f"{path} is laid out by {now.day or 'nothing'}, not by {day}")
    held = now.files if now is not None else ()
    load, inside = uuid.uuid4().hex, F.col(commits.DAY).between(F.lit(first), F.lit(last))
    with _staging(log, load) as staged:
        rows = _staged(df, contract, f"{staged}/rows", day)
        strange = rows.filter(~F.coalesce(inside, F.lit(False))).select(commits.DAY).take(1)
        if strange:
            raise ValueError(f"a row of {strange[0][0]} is not between {first} and {last}")
        if check and contract.key:
            assert_unique(rows, contract.key)
        gone = {f.day for f in held if f.day is not None and str(first) <= f.day <= str(last)}
        if contract.key and held:
            keys = [F.col(f"`{k}`") for k in contract.key]
            stored = _stored_keys(spark, log, contract, now, rows).filter(~F.coalesce(inside, F.lit(False)))
            moved = stored.join(rows.select(*keys), list(contract.key), "left_semi").select(commits.DAY).distinct()
            left = {None if r[0] is None else str(r[0]) for r in moved.collect()}  # days of the sink, at most
            if left:
                stay = _of_files(spark, log, contract, now, [f for f in held if f.day in left])
                stay.join(rows.select(*keys), list(contract.key), "left_anti").select(*rows.columns).write.partitionBy(
                    commits.DAY
                ).mode("append").parquet(f"{staged}/rows")
                gone |= left
        _commit(spark, log, contract, load, staged, now, [f for f in held if f.day not in gone], day)


def rows(spark: SparkSession, contract: Contract, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The rows of a sink's newest version; of the visit days from first to last only, if it is laid out by day."""
    log = commits.Log(spark, path)
    now = log.newest()
    files = [] if now is None else list(now.files)
    if first is not None and last is not None:
        if now is not None and now.day is None and files:
            raise ValueError(f"{path} is not laid out by day")
        files = [f for f in files if f.day is not None and str(first) <= f.day <= str(last)]
    return _of_files(spark, log, contract, now, files).select(*[f"`{c}`" for c in contract.names])


def keys_stored(spark: SparkSession, contract: Contract, path: str, rows: DataFrame) -> DataFrame:
    """Distinct keys of the rows that the sink has too; reads the index's buckets that these keys fall into."""
    log = commits.Log(spark, path)
    now = log.newest()
    names = [F.col(f"`{k}`") for k in contract.key]
    if now is None:
        return rows.select(*names).limit(0)
    return keys_held(rows, _stored_keys(spark, log, contract, now, rows), contract.key)


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete what stopped loads and earlier versions left in the sink. Only when no load is running."""
    commits.Log(spark, path).vacuum()


def append_table(df: DataFrame, contract: Contract, table: str, check: bool = True) -> None:
    """Like `append`, into a catalog table; its own writer copies the checked rows."""
    spark = df.sparkSession
    staged = f"{shared_dir(spark)}/{contract.name}-{uuid.uuid4().hex}"
    try:
        rows = _staged(df, contract, staged)
        if check and contract.key:
            assert_unique(rows, contract.key)
            assert_new(rows, spark.table(table), contract.key)
        rows.write.insertInto(table)
    finally:
        _delete(spark, staged)


def _load(df, contract, path, check, replace, within=None) -> None:
    spark, log = df.sparkSession, commits.Log(df.sparkSession, path)
    now, load = log.newest(), uuid.uuid4().hex
    day = now.day if now is not None else None
    with _staging(log, load) as staged:
        rows = _staged(df, contract, f"{staged}/rows", day)
        if check and contract.key:
            assert_unique(rows, contract.key)
            if now is not None and not replace:
                if within is None:
                    held = _stored_keys(spark, log, contract, now, rows)
                else:
                    held = _of_files(spark, log, contract, now, now.files).filter(within)
                assert_new(rows, held, contract.key)
        _commit(spark, log, contract, load, staged, now, [] if replace or now is None else now.files, day)


@contextmanager
def _staging(log: commits.Log, load: str):
    """A folder beside the sink for one load, gone afterwards."""
    staged = f"{log.path}.staged-{load}"
    try:
        yield staged
    finally:
        log.files.delete(staged)


def _commit(spark, log, contract, load, staged, now, kept, day) -> None:
    """Move the staged rows and their keys in, and name them and the kept files in the next version."""
    keys = _index(spark, contract, f"{staged}/rows", f"{staged}/keys", day)
    base = ()
    if now is not None and now.files and not log.logged():  # a folder that had no log yet
        name = _index(spark, contract, log.path, f"{staged}/base", None)
        _, base = log.move_in(f"{staged}/none", commits.BASE, name)
        log.commit(commits.Version(0, None, now.files, tuple(base)), load)
        now = commits.Version(0, None, now.files, tuple(base))
    data, index = log.move_in(f"{staged}/rows", load, keys)
    files = [*kept, *data]
    loads = {f.load for f in files}
    held = now.keys if now is not None else ()
    keys = [k for k in (*held, *index) if k.load in loads]
    try:
        log.commit(commits.Version(1 if now is None else now.number + 1, day, tuple(files), tuple(keys)), load)
    except commits.ConcurrentLoad:
        log.remove([f.path for f in data], f"{commits.KEYS}/_load={load}")
        raise
    named = {f.path for f in files}
    log.remove(f.path for f in (now.files if now is not None else ()) if f.path not in named)
    log.remove({f"{commits.KEYS}/_load={k.load}" for k in held if k.load not in loads})


def _laid_out(contract: Contract, day: str | None) -> StructType:
    schema = contract.schema()
    return schema if day is None else StructType([*schema.fields, StructField(commits.DAY, DateType())])


def _of_files(spark, log, contract, now, files) -> DataFrame:
    """Rows of some files of a sink, with their day if it is laid out by day."""
    schema = _laid_out(contract, now.day if now is not None else None)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", log.path).parquet(*[f"{log.path}/{f.path}" for f in files])


def _bucket(contract: Contract) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in contract.key]), F.lit(BUCKETS)).cast("int")


def _index_schema(contract: Contract) -> StructType:
    keys = [StructField(c.name, c.type) for c in contract.columns if c.name in contract.key]
    return StructType([*keys, StructField("_at", DateType()), StructField("_load", StringType()), StructField("_bucket", IntegerType())])


def _index(spark, contract, source: str, target: str, day: str | None) -> str | None:
    """Write the keys of the rows in a folder, with their day, in buckets; gives the folder if there is a key."""
    if not contract.key:
        return None
    rows = spark.read.schema(_laid_out(contract, day)).parquet(source)
    at = F.lit(None).cast("date") if day is None else F.col(commits.DAY)
    rows.select(*[F.col(f"`{k}`") for k in contract.key], at.alias("_at"), _bucket(contract).alias("_bucket")).hint(
        "rebalance", "_bucket"
    ).write.partitionBy("_bucket").parquet(target)
    return target


def _stored_keys(spark, log, contract, now, rows) -> DataFrame:
    """Keys that the sink holds in the buckets of the given rows' keys, with their day.

    An entry counts while the load that wrote it still has files of that day in the sink: what a later load
    replaced is out of the index without its files being touched.
    """
    keys = [F.col(f"`{k}`") for k in contract.key]
    if now.files and not now.keys:  # written before there was an index
        at = F.lit(None).cast("date") if now.day is None else F.col(commits.DAY)
        return _of_files(spark, log, contract, now, now.files).select(*keys, at.alias(commits.DAY))
    wanted = {r[0] for r in rows.select(_bucket(contract)).distinct().collect()}  # BUCKETS at most
    files = [f"{log.path}/{k.path}" for k in now.keys if k.bucket in wanted]
    schema = _index_schema(contract)
    if files:
        found = spark.read.schema(schema).option("basePath", f"{log.path}/{commits.KEYS}").parquet(*files)
    else:
        found = spark.createDataFrame([], schema)
    alive = sorted({(f.load, f.day or "") for f in now.files})
    valid = spark.createDataFrame(alive, "_load string, _day_text string")
    day = F.coalesce(F.col("_at").cast("string"), F.lit(""))
    return (
        found.withColumn("_day_text", day).join(valid, ["_load", "_day_text"], "left_semi")
        .select(*keys, F.col("_at").alias(commits.DAY))
    )


def _staged(df: DataFrame, contract: Contract, path: str, day: str | None = None) -> DataFrame:
    """Write the rows to a folder, laid out by day if one is given, and read them back."""
    rows = conform(df, contract)
    if day is None:
        rows.write.parquet(path)
    else:
        dated = rows.withColumn(commits.DAY, F.to_date(f"`{day}`"))
        dated.hint("rebalance", commits.DAY).write.partitionBy(commits.DAY).parquet(path)
    return df.sparkSession.read.schema(_laid_out(contract, day)).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    commits.Files(spark, path).delete(path)


def flat_file(
    df: DataFrame, contract: Contract, widths: Mapping[str, int] | None = None
) -> DataFrame:
    """All-text projection without the private columns: null as '', stamps to the second.

    `widths` are the text widths that differ from the sink table's.
    """
    widths = widths or {}
    out = []
    for column in contract.columns:
        value = F.col(f"`{column.name}`")
        if column.name in contract.private:
            continue
        if column.type.typeName() == "timestamp_ntz":
            text = stamp_text(value)
        else:
            text = blank(value, widths.get(column.name, column.width or 18))
        out.append(text.alias(column.name))
    return df.select(*out)


def flat_cell(value: Column) -> Column:
    """One value of a flat file.

    A line break becomes a space. A value with a comma or a quote is put in quotes, with its quotes
    doubled; one that is in quotes already keeps them, and only those inside are doubled.
    """
    text = F.regexp_replace(F.coalesce(value, F.lit("")), "\\r\\n|\\r|\\n", " ")
    quoted = (F.length(text) > 1) & text.startswith('"') & text.endswith('"')
    inner = F.when(quoted, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    whole = F.concat(F.lit('"'), F.replace(inner, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(quoted | text.contains(",") | text.contains('"'), whole).otherwise(text)


def write_flat_file(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Write all-text rows as comma-separated lines, sorted, with one header line.

    The part files in order of their names make up the file; the first one begins with the header.
    """
    by = list(order) or df.columns
    line = F.concat_ws(",", *[flat_cell(F.col(f"`{c}`")) for c in df.columns])
    keys = [f"_o{i}" for i in range(len(by))]
    lines = df.select(
        F.lit(1).alias("_body"), *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)], line.alias("value")
    )
    head = df.sparkSession.range(1).select(
        F.lit(0).alias("_body"),
        *[F.lit(None).cast(lines.schema[k].dataType).alias(k) for k in keys],
        F.concat_ws(",", *[flat_cell(F.lit(c)) for c in df.columns]).alias("value"),
    )
    head.unionByName(lines).orderBy("_body", *keys).select("value").write.mode("overwrite").text(path)
