"""Values of neighbouring rows within ordered groups of any size.

Rows are dealt into ranges of (keys, order) of about equal size (see `ranges`), so a group that holds a large
share of the rows spans many ranges. Each range runs its own windows. Only groups that a border cuts go on
in another range; for those, one summary row per range carries what a range needs from the ranges before or
after it. There is one plan for every size, and no row is collected but the sampled borders.

The rows are read once for the borders, their ordered columns only, once for the windows, and once, the
cut groups only, for the summaries. A caller whose rows are costly to compute stores them first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.operators import ranges

_PART = "_part"


@dataclass(frozen=True)
class Neighbour:
    """One value to read from another row of the group."""

    kind: str
    value: Column | None = None


def previous(value: Column) -> Neighbour:
    """Value of the row just before."""
    return Neighbour("previous", value)


def following(value: Column) -> Neighbour:
    """Value of the row just after."""
    return Neighbour("following", value)


def last_before(value: Column) -> Neighbour:
    """Latest non-null value among the rows before."""
    return Neighbour("last_before", value)


def first_after(value: Column) -> Neighbour:
    """Earliest non-null value among the rows after."""
    return Neighbour("first_after", value)


def position() -> Neighbour:
    """Row number counted from the first row of the group."""
    return Neighbour("position")


def position_from_end() -> Neighbour:
    return Neighbour("position_from_end")


def tally(value: Column) -> Neighbour:
    """Number of non-null values in the rows of the group up to this one."""
    return Neighbour("tally", value)


_BACKWARD = ("following", "first_after", "position_from_end")


def with_neighbours(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], wanted: Mapping[str, Neighbour]
) -> DataFrame:
    """Add the wanted neighbour values; `order` must be unique within a group."""
    columns = [*keys, *order]
    cuts = ranges.borders(df, columns, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = ranges.with_range(df, columns, cuts, _PART)
    joined = _windowed(placed, [_PART, *keys], order, wanted)
    if cuts:
        carried = _carry(_spanning(placed, keys, cuts), list(keys), order, wanted)
        same = [joined[k].eqNullSafe(carried[f"_k_{k}"]) for k in [*keys, _PART]]
        joined = joined.join(carried, same, "left")
    else:
        joined = joined.withColumns({f"_c_{name}": F.lit(None).cast(joined.schema[name].dataType) for name in wanted})
    out = [F.col(c) for c in df.columns]
    for name, step in wanted.items():
        inside, outside = F.col(name), F.col(f"_c_{name}")
        if step.value is None or step.kind == "tally":
            out.append((inside + F.coalesce(outside, F.lit(0))).cast("long").alias(name))
        else:
            out.append(F.coalesce(inside, outside).getField("v").alias(name))
    return joined.select(*out)


def _spanning(placed: DataFrame, keys: Sequence[str], cuts: Sequence[ranges.Border]) -> DataFrame:
    """The rows of the groups that a border cuts."""
    groups = ranges.groups_cut(placed, keys, cuts)
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    return placed.join(groups, same, "left_semi")


def _windowed(df, keys, order, wanted) -> DataFrame:
    """One window per direction; values are boxed so that an absent row differs from a null."""
    ahead = Window.partitionBy(*keys).orderBy(*order)
    behind = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    columns = {}
    for name, step in wanted.items():
        window = behind if step.kind in _BACKWARD else ahead
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        if step.value is None:
            columns[name] = F.row_number().over(window).cast("long")
            continue
        if step.kind == "tally":
            columns[name] = F.count(step.value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            continue
        value = F.struct(step.value.alias("v"))
        if step.kind in ("previous", "following"):
            columns[name] = F.lag(value).over(window)
        else:
            present = F.when(step.value.isNotNull(), value)
            columns[name] = F.last(present, ignorenulls=True).over(earlier)
    return df.withColumns(columns)


def _carry(rows, keys, order, wanted) -> DataFrame:
    """Per range: what its first (or last) row must take from the ranges before (or after) it."""
    at = F.struct(*order)
    edges = []
    for name, step in wanted.items():
        if step.value is None:
            edges.append(F.count(F.lit(1)).alias(name))
            continue
        if step.kind == "tally":
            edges.append(F.count(step.value).alias(name))
            continue
        edge = F.min_by if step.kind in _BACKWARD else F.max_by
        counted = step.kind in ("previous", "following")
        when = at if counted else F.when(step.value.isNotNull(), at)
        edges.append(edge(F.struct(step.value.alias("v")), when).alias(name))
    summary = rows.groupBy(*keys, _PART).agg(*edges)
    columns = [F.col(k).alias(f"_k_{k}") for k in [*keys, _PART]]
    for name, step in wanted.items():
        direction = F.col(_PART).desc() if step.kind in _BACKWARD else F.col(_PART)
        earlier = (
            Window.partitionBy(*keys)
            .orderBy(direction)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        if step.value is None or step.kind == "tally":
            carried = F.sum(name).over(earlier)
        else:
            carried = F.last(name, ignorenulls=True).over(earlier)
        columns.append(carried.alias(f"_c_{name}"))
    return summary.select(*columns)
