"""Key checks. The source system refused duplicate keys at every stage; these find them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """A key is held by more than one row."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; null counts as a value."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def keys_held(rows: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the rows that other, already stored rows have too."""
    names = [F.col(f"`{k}`") for k in keys]
    return rows.select(*names).distinct().join(held.select(*names), list(keys), "left_semi")


def assert_new(rows: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = keys_held(rows, held, keys).take(1)
    if found:
        raise KeyViolation(f"key {list(keys)} is already stored: {found[0].asDict()}")
    return rows


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = duplicate_keys(df, keys).take(1)
    if found:
        raise KeyViolation(f"duplicate key {list(keys)}: {found[0].asDict()}")
    return df
