"""Which patients, days and appointments a report covers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from datetime import time as dt_time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.functions.stamps import stamp_literal
from visitflow.session import stored


def in_scope(
    departments: Sequence = (),
    providers: Sequence = (),
    department: str = "DEPARTMENT_ID",
    provider: str = "PROV_ID",
) -> Column:
    """Department in one list or provider in the other."""
    rule = F.col(department).isin(*departments)
    if providers:
        rule = rule | F.col(provider).isin(*providers)
    return rule


def in_window(time: str, start: datetime, end: datetime) -> Column:
    return F.col(time).between(stamp_literal(start), stamp_literal(end))


def on_window_days(time: str, start: datetime, end: datetime) -> Column:
    """Times on any day the window touches: what an expanded cohort can hold, as a scan filter."""
    first = datetime.combine(start.date(), dt_time())
    after = datetime.combine(end.date() + timedelta(days=1), dt_time())
    return (F.col(time) >= stamp_literal(first)) & (F.col(time) < stamp_literal(after))


def patient_day_cohort(
    appointments: DataFrame,
    patients: DataFrame,
    start: datetime,
    end: datetime,
    scope: Column,
    patient: str = "PAT_ID",
    time: str = "APPT_DTTM",
    attributes: Sequence[str] = ("PAT_MRN_ID",),
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Distinct (patient, visit day) with an in-scope appointment in the window, plus attributes."""
    days = (
        appointments.filter(in_window(time, start, end) & scope)
        .select(patient, *extra_keys, F.to_date(time).alias("appt_date"))
        .distinct()
    )
    # The second distinct shares the first one's partitioning; it covers repeated patient rows.
    return days.join(patients.select(patient, *attributes), patient, "left").distinct()


def expand_cohort(
    appointments: DataFrame,
    cohort: DataFrame,
    scope: Column | None = None,
    patient: str = "PAT_ID",
    time: str = "APPT_DTTM",
) -> DataFrame:
    """Every appointment of a cohort patient on a cohort day, in any department unless scoped.

    Give appointments already limited to `on_window_days`; the join cannot infer that bound.
    """
    rows = appointments if scope is None else appointments.filter(scope)
    return rows.withColumn("appt_date", F.to_date(time)).join(cohort, [patient, "appt_date"])


def rows_of(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of a large table that belong to the given ids, before they are joined or folded."""
    return table.join(ids.select(key), key, "left_semi")


def left_to_many(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Left join to a table that may hold a large share of its rows under one key.

    Spark can split such a key in an inner join but not on the right of a left join. So parents
    meet their children in an inner join, and parents without any are added with nulls. The children are
    reduced to the parents' and stored first: their table is read once, and both parts read the rest.
    """
    kept = stored(rows_of(children, parents, key), "children")
    found = parents.join(kept, key)
    childless = parents.join(kept.select(key).distinct(), key, "left_anti")
    return found.unionByName(childless, allowMissingColumns=True)
