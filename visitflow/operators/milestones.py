"""Flowsheet measures of a visit and the milestone columns made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def visit_measures(
    visits: DataFrame,
    records: DataFrame,
    measurements: DataFrame,
    groups: DataFrame,
    predicate: Column,
    templates: DataFrame | None = None,
) -> DataFrame:
    """Flowsheet rows of the visits that satisfy the predicate, with their template name.

    `visits` holds one row per visit with INPATIENT_DATA_ID. The predicate is applied to the
    measurements before any join, and the visits are reduced to their flowsheet records first, so
    the measurements are shuffled once.
    """
    rows = measurements.filter(predicate)
    if templates is not None:
        names = templates.select(F.col("TEMPLATE_ID").alias("FLT_ID"), "TEMPLATE_NAME")
        rows = rows.join(names, "FLT_ID", "left")
    return (
        records.select("FSD_ID", "INPATIENT_DATA_ID")
        .join(visits, "INPATIENT_DATA_ID")
        .join(rows.join(groups.select("FLO_MEAS_ID"), "FLO_MEAS_ID"), "FSD_ID")
    )


def _as_struct(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in keys])


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group, by an aggregation that combines before the shuffle."""
    best = F.min_by(_as_struct(df, keys), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def last_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    best = F.max_by(_as_struct(df, keys), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def milestone_columns(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    wanted: Mapping[str, tuple[Column, str]],
) -> DataFrame:
    """One row per group with the first or last time of the rows meeting each condition.

    `wanted` maps a column name to (condition, "first" or "last"). Rows meeting no condition only
    keep their group's row. A missing time sorts before every other, so it makes a "first" null.
    """
    columns = []
    for name, (condition, which) in wanted.items():
        stamp = F.when(condition, F.col(time))
        if which == "first":
            undated = F.coalesce(F.bool_or(condition & F.col(time).isNull()), F.lit(False))
            column = F.when(~undated, F.min(stamp))
        else:
            column = F.max(stamp)
        columns.append(column.alias(name))
    return df.groupBy(*keys).agg(*columns)


def milestone_pivot(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    time: str,
    wanted: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Milestone columns by code: `wanted` maps a code to (column name, "first" or "last")."""
    conditions = {
        name: (F.col(code) == value, which) for value, (name, which) in wanted.items()
    }
    return milestone_columns(df, keys, time, conditions)


def with_counts(
    df: DataFrame,
    counts: Mapping[str, tuple[Sequence[str], str | None]],
) -> DataFrame:
    """Add group sizes: name -> (keys, column whose nulls are not counted, or None for rows).

    Counted by aggregation and joined back, so no group has to fit one task.
    """
    out = df
    for name, (keys, column) in counts.items():
        counted = F.count(F.lit(1) if column is None else column).alias(name)
        sizes = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(counted)
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        out = out.join(sizes, same).drop(*[f"_k_{k}" for k in keys])
    return out
