"""Same-day links from a visit to an earlier or later visit of the same patient."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow import codes
from visitflow.operators.ordered import (
    first_after,
    following,
    last_before,
    previous,
    with_neighbours,
)


def _record(carry: Mapping[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in carry.items()])


def _attach(df: DataFrame, keep: Sequence[str], linked: Column, carry) -> DataFrame:
    return df.select(*keep, linked.alias("_linked")).select(
        *keep, *[F.col("_linked").getField(name).alias(name) for name in carry]
    )


def link_previous(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    status: str,
    carry: Mapping[str, Column],
    skip: Sequence = codes.INACTIVE_STATUSES,
    active: Sequence = codes.ACTIVE_STATUSES,
) -> DataFrame:
    """Carry values from the visit before this one in its group.

    That is the row just before, unless its status is in `skip`: then the latest earlier row
    whose status is in `active`. A missing or unlisted status does not skip.
    """
    record = _record(carry)
    found = with_neighbours(
        df,
        part,
        order,
        {
            "_prev_status": previous(F.col(status)),
            "_prev": previous(record),
            "_prev_active": last_before(F.when(F.col(status).isin(*active), record)),
        },
    )
    linked = F.when(F.col("_prev_status").isin(*skip), F.col("_prev_active")).otherwise(
        F.col("_prev")
    )
    return _attach(found, df.columns, linked, carry)


def link_next(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    status: str,
    department: str,
    target: Sequence,
    from_scope: Column,
    carry: Mapping[str, Column],
    skip: Sequence = codes.INACTIVE_STATUSES,
    active: Sequence = codes.ACTIVE_STATUSES,
) -> DataFrame:
    """Carry values from the next active visit to a target department.

    Only for rows in `from_scope` whose next row is in the target with a listed status. When
    that row is active it is the first active target row itself, so one search serves both cases.
    """
    record = _record(carry)
    usable = F.col(department).isin(*target) & F.col(status).isin(*active)
    found = with_neighbours(
        df,
        part,
        order,
        {
            "_next_department": following(F.col(department)),
            "_next_status": following(F.col(status)),
            "_next_usable": first_after(F.when(usable, record)),
        },
    )
    linked = F.when(
        from_scope
        & F.col("_next_department").isin(*target)
        & F.col("_next_status").isin(*active, *skip),
        F.col("_next_usable"),
    )
    return _attach(found, df.columns, linked, carry)
