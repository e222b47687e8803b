"""Access to the named source tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.operators.cohort import on_window_days


class Warehouse(Mapping):
    """Source tables by name, from a folder of parquet tables, a catalog schema, or given frames.

    Frames are looked up on first use; a scan reads only the columns and rows a plan needs.

    `collations` names, by table and column, the collation that texts are compared by in filters, joins,
    groups and orders, such as UTF8_LCASE_RTRIM for a source system that ignores case and blanks at the end.
    Other columns are compared byte for byte; columns that are
    joined with each other are declared alike. A filter on a collated column does not reach the scan.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        schema: str | None = None,
        frames: Mapping[str, DataFrame] | None = None,
        collations: Mapping[str, Mapping[str, str]] | None = None,
    ):
        self.spark = spark
        self._folder, self._schema = folder, schema
        self._frames: dict[str, DataFrame] = {}
        self._given, self._collations = dict(frames or {}), collations or {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in self._given:
                frame = self._given[name]
            elif self._folder is not None:
                frame = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
            elif self._schema is not None:
                frame = self.spark.table(f"{self._schema}.{name}")
            else:
                raise KeyError(name)
            self._frames[name] = _collated(frame, self._collations.get(name, {}))
        return self._frames[name]

    def on_days(self, name: str, time: str, start: datetime, end: datetime) -> DataFrame:
        """A table's rows on the days that the window touches; a layout by that time reads no other periods."""
        return self._within(self[name], time, start, end)

    @staticmethod
    def _within(rows: DataFrame, time: str, start: datetime, end: datetime) -> DataFrame:
        return rows.filter(on_window_days(time, start, end))

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames | self._given)

    def __len__(self) -> int:
        return len(self._frames | self._given)


def _collated(frame: DataFrame, collations: Mapping[str, str]) -> DataFrame:
    if missing := set(collations) - set(frame.columns):
        raise KeyError(f"no such columns: {sorted(missing)}")
    return frame.withColumns({c: F.collate(F.col(f"`{c}`"), kind) for c, kind in collations.items()}) if collations else frame
