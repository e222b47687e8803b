"""Cohort, scope and same-day link queries."""

from pyspark.sql import functions as F

from fixtures.registry import (
    CLINIC_PROVIDERS,
    CLINICS,
    INFUSION_UNITS,
    RUN_DATE,
    query,
)
from fixtures.sql import CSN, ids, minute
from visitflow.functions.labels import link_flag
from visitflow.functions.stamps import report_window, report_window_columns, round_to_minute
from visitflow.operators.cohort import expand_cohort, in_scope, in_window, patient_day_cohort
from visitflow.operators.linking import link_next, link_previous
from visitflow.operators.ordered import position, position_from_end, with_neighbours

UNITS, CLINIC_IDS = ids(INFUSION_UNITS), ids(CLINICS)
SCOPE_SQL = f"(DEPARTMENT_ID IN {CLINIC_IDS} OR PROV_ID IN {ids(CLINIC_PROVIDERS)})"
WINDOW = report_window(RUN_DATE, 1, 2)
WINDOW_SQL = "BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-04-01 00:00:00'"
DAY_PART, DAY_ORDER = ["PAT_ID", "appt_date"], ["APPT_DTTM", CSN]


def dated(wh):
    return wh["V_SCHED_APPT"].withColumn("appt_date", F.to_date("APPT_DTTM"))


@query(
    "report_window",
    f"""SELECT {CSN}, CAST(CONTACT_DATE - 1 AS TIMESTAMP) AS infusion_start,
          CAST(date_trunc('month', CONTACT_DATE) + INTERVAL 3 MONTH AS TIMESTAMP) AS infusion_end,
          CAST(CONTACT_DATE - 3 AS TIMESTAMP) AS board_start,
          CAST(CONTACT_DATE + 1 AS TIMESTAMP) AS board_end
        FROM V_SCHED_APPT WHERE APPT_DTTM {WINDOW_SQL}""",
)
def _(wh):
    infusion = report_window_columns("CONTACT_DATE", 1, 2)
    board = report_window_columns("CONTACT_DATE", 3)
    return wh["V_SCHED_APPT"].filter(in_window("APPT_DTTM", *WINDOW)).select(
        CSN,
        infusion[0].alias("infusion_start"),
        infusion[1].alias("infusion_end"),
        board[0].alias("board_start"),
        board[1].alias("board_end"),
    )


@query(
    "patient_day_cohort",
    f"""SELECT DISTINCT a.PAT_ID, CAST(APPT_DTTM AS DATE) AS appt_date, PAT_MRN_ID
        FROM V_SCHED_APPT a LEFT JOIN PATIENT p ON p.PAT_ID = a.PAT_ID
        WHERE APPT_DTTM {WINDOW_SQL} AND DEPARTMENT_ID IN {UNITS}""",
)
def cohort(wh):
    return patient_day_cohort(
        wh["V_SCHED_APPT"], wh["PATIENT"], *WINDOW, in_scope(INFUSION_UNITS)
    )


@query(
    "expand_cohort",
    f"""SELECT a.{CSN}, a.PAT_ID, c.d AS appt_date, a.DEPARTMENT_ID, c.PAT_MRN_ID
        FROM V_SCHED_APPT a JOIN (
          SELECT DISTINCT v.PAT_ID, CAST(APPT_DTTM AS DATE) AS d, PAT_MRN_ID
          FROM V_SCHED_APPT v LEFT JOIN PATIENT p ON p.PAT_ID = v.PAT_ID
          WHERE APPT_DTTM {WINDOW_SQL} AND DEPARTMENT_ID IN {UNITS}) c
        ON c.PAT_ID = a.PAT_ID AND c.d = CAST(a.APPT_DTTM AS DATE)""",
)
def _(wh):
    return expand_cohort(wh["V_SCHED_APPT"], cohort(wh)).select(
        CSN, "PAT_ID", "appt_date", "DEPARTMENT_ID", "PAT_MRN_ID"
    )


@query(
    "scope_filter",
    f"SELECT {CSN}, DEPARTMENT_ID, PROV_ID FROM V_SCHED_APPT WHERE {SCOPE_SQL}",
)
def _(wh):
    scope = in_scope(CLINICS, CLINIC_PROVIDERS)
    return wh["V_SCHED_APPT"].filter(scope).select(CSN, "DEPARTMENT_ID", "PROV_ID")


def _visit(x: str) -> str:
    """A visit as one value that sorts by time, then id."""
    return (
        f"{{'t': {x}.APPT_DTTM, 'id': {x}.{CSN}, 'status': {x}.APPT_STATUS_C,"
        f" 'length': {x}.APPT_LENGTH, 'unit': {x}.DEPARTMENT_ID}}"
    )


def previous_sql(table: str, patient: str, day: str) -> str:
    """Of the visits earlier that day, the latest; if that one fell through, the latest active one."""
    return f"""
      WITH seen AS (
        SELECT v.{CSN}, max({_visit("e")}) FILTER (e.{CSN} IS NOT NULL) AS latest,
          max({_visit("e")}) FILTER (e.APPT_STATUS_C IN (1, 2, 6)) AS active
        FROM (SELECT *, {day} AS d FROM {table}) v LEFT JOIN (SELECT *, {day} AS d FROM {table}) e
          ON e.{patient} = v.{patient} AND e.d = v.d
            AND (e.APPT_DTTM < v.APPT_DTTM OR (e.APPT_DTTM = v.APPT_DTTM AND e.{CSN} < v.{CSN}))
        GROUP BY v.{CSN}),
      linked AS (SELECT {CSN}, if(latest.status IN (3, 4, 5), active, latest) AS found FROM seen)
      SELECT {CSN}, found.id AS previous_id, {minute("found.t")} AS previous_time,
        found.length AS previous_length, found.unit AS previous_department FROM linked"""


def next_sql(table: str, patient: str, day: str, scope: str, linkable: str, target: str) -> str:
    """The first active target visit later that day, if a target visit of known status comes right after."""
    return f"""
      WITH near AS (SELECT *, {day} AS d, {scope} AS starts FROM {table} WHERE {linkable}),
      seen AS (
        SELECT v.{CSN}, any_value(v.starts) AS starts,
          min({_visit("f")}) FILTER (f.{CSN} IS NOT NULL) AS soonest,
          min({_visit("f")}) FILTER (f.DEPARTMENT_ID IN {target} AND f.APPT_STATUS_C IN (1, 2, 6)) AS usable
        FROM near v LEFT JOIN near f ON f.{patient} = v.{patient} AND f.d = v.d
          AND (f.APPT_DTTM > v.APPT_DTTM OR (f.APPT_DTTM = v.APPT_DTTM AND f.{CSN} > v.{CSN}))
        GROUP BY v.{CSN}),
      linked AS (SELECT {CSN}, if(starts AND soonest.unit IN {target} AND soonest.status BETWEEN 1 AND 6,
          usable, NULL) AS found FROM seen)
      SELECT {CSN}, found.id AS next_id, found.length AS next_length, found.unit AS next_department
      FROM linked"""


def previous_carry():
    return {
        "previous_id": F.col(CSN),
        "previous_time": round_to_minute("APPT_DTTM"),
        "previous_length": F.col("APPT_LENGTH"),
        "previous_department": F.col("DEPARTMENT_ID"),
    }


def next_carry():
    return {
        "next_id": F.col(CSN),
        "next_length": F.col("APPT_LENGTH"),
        "next_department": F.col("DEPARTMENT_ID"),
    }


@query("link_previous", previous_sql("V_SCHED_APPT", "PAT_ID", "CAST(APPT_DTTM AS DATE)"))
def previous_links(wh):
    linked = link_previous(dated(wh), DAY_PART, DAY_ORDER, "APPT_STATUS_C", previous_carry())
    return linked.select(CSN, *previous_carry())


@query("link_previous_busy_patient", previous_sql("BUSY_APPT", "PAT_ID", "appt_date"))
def _(wh):
    appt = wh["BUSY_APPT"]
    linked = link_previous(appt, DAY_PART, DAY_ORDER, "APPT_STATUS_C", previous_carry())
    return linked.select(CSN, *previous_carry())


SPLIT = "DEPARTMENT_ID < 20"
TARGET = (20, 21, 22, 23, 24)


@query(
    "link_next",
    next_sql("V_SCHED_APPT", "PAT_ID", "CAST(APPT_DTTM AS DATE)", SPLIT, "true", ids(TARGET)),
)
def _(wh):
    linked = link_next(
        dated(wh), DAY_PART, DAY_ORDER, "APPT_STATUS_C", "DEPARTMENT_ID", TARGET,
        F.col("DEPARTMENT_ID") < 20, next_carry(),
    )
    return linked.select(CSN, *next_carry())


@query(
    "link_next_busy_patient",
    next_sql("BUSY_APPT", "PAT_ID", "appt_date", SPLIT, "true", ids(TARGET)),
)
def _(wh):
    appt = wh["BUSY_APPT"]
    linked = link_next(
        appt, DAY_PART, DAY_ORDER, "APPT_STATUS_C", "DEPARTMENT_ID", TARGET,
        F.col("DEPARTMENT_ID") < 20, next_carry(),
    )
    return linked.select(CSN, *next_carry())


@query(
    "link_next_scoped_only",
    next_sql(
        "V_SCHED_APPT", "PAT_ID", "CAST(APPT_DTTM AS DATE)", SCOPE_SQL, SCOPE_SQL, UNITS
    ),
)
def _(wh):
    scope = in_scope(CLINICS, CLINIC_PROVIDERS)
    linked = link_next(
        dated(wh).filter(scope), DAY_PART, DAY_ORDER, "APPT_STATUS_C", "DEPARTMENT_ID",
        INFUSION_UNITS, scope, next_carry(),
    )
    return linked.select(CSN, *next_carry())


@query(
    "link_next_with_target",
    next_sql(
        "V_SCHED_APPT", "PAT_ID", "CAST(APPT_DTTM AS DATE)", f"DEPARTMENT_ID IN {CLINIC_IDS}",
        f"(DEPARTMENT_ID IN {CLINIC_IDS} OR DEPARTMENT_ID IN {UNITS})", UNITS,
    ),
)
def _(wh):
    scope = in_scope(CLINICS)
    linked = link_next(
        dated(wh).filter(scope | in_scope(INFUSION_UNITS)), DAY_PART, DAY_ORDER, "APPT_STATUS_C",
        "DEPARTMENT_ID", INFUSION_UNITS, scope, next_carry(),
    )
    return linked.select(CSN, *next_carry())


@query(
    "link_flag",
    f"""SELECT {CSN}, CASE WHEN previous_id IS NULL THEN 'N' ELSE 'Y' END AS flag,
          CASE WHEN previous_id IS NULL THEN '0' ELSE '1' END AS digit
        FROM ({previous_sql("V_SCHED_APPT", "PAT_ID", "CAST(APPT_DTTM AS DATE)")}) x""",
)
def _(wh):
    return previous_links(wh).select(
        CSN, link_flag("previous_id").alias("flag"), link_flag("previous_id", "1", "0").alias("digit")
    )


@query(
    "row_numbers",
    f"""SELECT {CSN}, row_number() OVER (PARTITION BY PAT_ID, appt_date ORDER BY APPT_DTTM, {CSN}) AS n,
          row_number() OVER (PARTITION BY PAT_ID, appt_date ORDER BY APPT_DTTM DESC, {CSN} DESC)
            AS n_from_end
        FROM BUSY_APPT""",
)
def _(wh):
    appt = wh["BUSY_APPT"]
    wanted = {"n": position(), "n_from_end": position_from_end()}
    return with_neighbours(appt, DAY_PART, DAY_ORDER, wanted).select(CSN, *wanted)
