"""Copies of source tables laid out for the extracts: in buckets of a join key and in periods of a time.

Tables in equal buckets of a key are joined and grouped by it where they lie; only the other, usually small,
side of a join moves. A window on a time reads the periods that it touches. `lay_out` writes the copies once, and
every run reads them through a `LaidOut` warehouse in place of the source.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitflow.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Layout:
    """Buckets of `key` and, where a time is given, a partition for each `period` ("month" or "day") of it."""

    key: str
    time: str | None = None
    period: str = "month"

    @property
    def column(self) -> str | None:
        """The partition column."""
        return None if self.time is None else f"{self.time}_{self.period}"

    def period_of(self, time: Column) -> Column:
        return F.to_date(time) if self.period == "day" else F.trunc(time, self.period)


#: The tables that extracts join by encounter or find a cohort in, and the times of their windows.
LAYOUTS: Mapping[str, Layout] = {
    "V_SCHED_APPT": Layout("PAT_ID", "APPT_DTTM"),
    "PATIENT": Layout("PAT_ID"),
    "F_SCHED_APPT": Layout("PAT_ENC_CSN_ID"),
    "PAT_ENC": Layout("PAT_ENC_CSN_ID"),
    "PAT_ENC_APPT": Layout("PAT_ENC_CSN_ID"),
    "PAT_ENC_APPT_NOTES": Layout("PAT_ENC_CSN_ID"),
    "PAT_ENC_RSN_VISIT": Layout("PAT_ENC_CSN_ID"),
    "MAR_ADMIN_INFO": Layout("MAR_ENC_CSN", "SCHEDULED_TIME"),
    "SMRTDTA_ELEM_DATA": Layout("CONTACT_SERIAL_NUM"),
    "ED_IEV_PAT_INFO": Layout("PAT_ENC_CSN_ID"),
}


class LaidOut(Warehouse):
    """The laid-out copies in a catalog schema, and the tables without a layout from their source."""

    def __init__(self, source: Warehouse, schema: str, layouts: Mapping[str, Layout] = LAYOUTS):
        super().__init__(source.spark, schema=schema)
        self._source, self._layouts = source, dict(layouts)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._layouts:
            return self._source[name]
        column, rows = self._layouts[name].column, super().__getitem__(name)
        return rows if column is None else rows.drop(column)

    def on_days(self, name: str, time: str, start: datetime, end: datetime) -> DataFrame:
        layout = self._layouts.get(name)
        if layout is None or layout.time != time:
            return super().on_days(name, time, start, end)
        first, last = (layout.period_of(F.lit(t.date())) for t in (start, end))
        rows = super().__getitem__(name).filter(F.col(layout.column).between(first, last))
        return self._within(rows, time, start, end).drop(layout.column)


def lay_out(
    source: Warehouse, schema: str, layouts: Mapping[str, Layout] = LAYOUTS, buckets: int | None = None
) -> LaidOut:
    """Write the copies into an existing catalog schema and return the warehouse that reads them.

    `buckets` is by default the session's number of shuffle partitions; with fewer Spark may prefer to shuffle
    both sides of a join. A bucket is read by one task, so a table with a key that holds more rows than a
    mean bucket (a null key too), and one whose key is a collated text, is written without buckets: its
    joins shuffle and adaptive skew handling splits them. A copy is a table of its own behind a view of the
    source's name; replacing the view is the last step, so a call that stops leaves each table's old copy or its
    new one, and the next call drops what it wrote in vain. Runs that still read an old copy are to end first.
    """
    spark = source.spark
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, layout in layouts.items():
        rows = source[name]
        if layout.time is not None:
            rows = rows.withColumn(layout.column, layout.period_of(F.col(layout.time)))
        if _even(rows, layout.key, buckets):
            # Spark deals rows to tasks as it does to buckets, so each task writes the files of one bucket.
            writer = rows.repartition(buckets, layout.key).write.bucketBy(buckets, layout.key).sortBy(layout.key)
        else:
            writer = (rows if layout.time is None else rows.hint("rebalance", layout.column)).write
        if layout.time is not None:
            writer = writer.partitionBy(layout.column)
        copy = f"{name}__{uuid.uuid4().hex}".lower()
        writer.format("parquet").saveAsTable(f"{schema}.{copy}")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT * FROM {schema}.{copy}")
        for table in spark.sql(f"SHOW TABLES IN {schema}").collect():
            if table.tableName.startswith(f"{name}__".lower()) and table.tableName != copy:
                spark.sql(f"DROP TABLE {schema}.{table.tableName}")
    return LaidOut(source, schema, layouts)


def _even(rows: DataFrame, key: str, buckets: int) -> bool:
    """Whether no key has more rows than a mean bucket; one aggregation that reads the key alone."""
    kind = rows.schema[key].dataType
    if isinstance(kind, T.StringType) and kind != T.StringType():
        return False
    sizes = rows.groupBy(key).count().agg(F.max("count").alias("heaviest"), F.sum("count").alias("total"))
    heaviest, total = sizes.first()
    return not total or heaviest * buckets <= total
