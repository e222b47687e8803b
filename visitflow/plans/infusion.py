"""Daily infusion extract: visits to the infusion units with their link to an earlier clinic visit,
medication span, treatment plans, milestones, resources and notes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow import codes
from visitflow.functions.labels import link_flag, status_label
from visitflow.functions.stamps import report_window, round_to_minute, round_to_second, stamp_text
from visitflow.functions.text import blank, clip_list, non_empty, pseudonym, quote_list
from visitflow.operators.administrations import (
    attach_treatment_plan,
    infusion_administrations,
    infusion_intervals,
    order_intervals,
)
from visitflow.operators.cohort import (
    expand_cohort,
    in_scope,
    patient_day_cohort,
    rows_of,
)
from visitflow.operators.linking import link_previous
from visitflow.operators.lists import enumerate_lines
from visitflow.operators.milestones import milestone_columns, visit_measures
from visitflow.sources.contracts import infusion as contract
from visitflow.sources.contracts import summary_heading
from visitflow.sources.load import flat_file, with_audit
from visitflow.sources.staging import Stage, inline, usual
from visitflow.sources.warehouse import Warehouse

BACK_DAYS, FORWARD_MONTHS = 1, 2
FLAT_ORDER = ("PAT_MRN_ID", "Appointment Time")
CSN = "PAT_ENC_CSN_ID"
STAGE_KEYS = {
    "cohort": ("PAT_ID", "appt_date"),
    "day_visits": (CSN,),
    "visits": (CSN,),
    "administrations": ("ORDER_MED_ID", "TAKEN_TIME"),
    "orders": ("MAR_ENC_CSN", "ORDER_MED_ID"),
}
LINK_PART, LINK_ORDER = ("PAT_ID", "appt_date"), ("APPT_DTTM", CSN)
_APPT = (
    CSN, "PAT_ID", "APPT_DTTM", "DEPARTMENT_ID", "DEPT_SPECIALTY_NAME", "PRC_NAME", "APPT_LENGTH",
    "APPT_STATUS_C", "CHECKIN_DTTM", "ARVL_LIST_REMOVE_DTTM", "APPT_MADE_DATE", "APPT_CANC_DATE",
    "REFERRING_PROV_NAME_WID", "CANCEL_REASON_NAME",
)


def linked_visits(
    wh: Warehouse,
    departments: Sequence,
    start: datetime,
    end: datetime,
    stage: Stage = inline,
    patient: str | None = None,
) -> DataFrame:
    """In-scope visits of the window with the earlier same-day visit they are linked to.

    Links are found among all of the patient's visits that day; only then are the visits reduced
    to the departments in scope and looked up elsewhere.
    """
    appt = wh.on_days("V_SCHED_APPT", "APPT_DTTM", start, end).select(*_APPT)
    scope = in_scope(departments)
    if patient is not None:
        appt = appt.filter(F.col("PAT_ID") == patient)
    cohort = stage("cohort", patient_day_cohort(appt, wh["PATIENT"], start, end, scope))
    linked = link_previous(
        stage("day_visits", expand_cohort(appt, cohort)),
        LINK_PART,
        LINK_ORDER,
        "APPT_STATUS_C",
        carry={
            "previous_id": F.col(CSN),
            "previous_time": round_to_minute("APPT_DTTM"),
            "previous_length": F.col("APPT_LENGTH"),
            "previous_department": F.col("DEPARTMENT_ID"),
        },
    )
    return stage("visits", linked.filter(scope))


def medication_spans(
    wh: Warehouse, departments: Sequence, start: datetime, end: datetime, stage: Stage = inline
) -> DataFrame:
    """Per encounter: infusion span, plan count and the treatment plan lists."""
    given = stage(
        "administrations",
        infusion_administrations(
            wh.on_days("MAR_ADMIN_INFO", "SCHEDULED_TIME", start, end), wh["ORDER_MEDINFO"], wh["PAT_ENC"],
            departments, start, end,
        ),
    )
    orders = attach_treatment_plan(
        order_intervals(given), wh["V_ONC_TREATMENT_PLAN_ORDERS"], wh["CLARITY_SER"]
    )
    return infusion_intervals(stage("orders", orders))


def milestones(wh: Warehouse, visits: DataFrame, site: str = "") -> DataFrame:
    """Nurse assignment, visit summary, intake and checked-out stamps in one pass over the measures.

    `visits` holds the encounter id and INPATIENT_DATA_ID of each visit.
    """
    measure, template, value = F.col("FLO_MEAS_ID"), F.col("FLT_ID"), F.col("MEAS_VALUE")
    by_template = (measure.isin(*codes.MEASURES_SUMMARY_GIVEN) & (value == "Yes")) | (
        template == codes.TEMPLATE_NURSE_ASSIGNMENT
    )
    tracked = (measure == codes.MEASURE_TRACK) & value.isin(
        codes.TRACK_INTAKE, codes.TRACK_CHECKED_OUT
    )
    rows = visit_measures(
        visits,
        wh["IP_FLWSHT_REC"],
        wh["IP_FLWSHT_MEAS"],
        wh["IP_FLO_GP_DATA"],
        by_template | tracked,
    )
    return milestone_columns(
        rows,
        [CSN],
        "RECORDED_TIME",
        {
            "BCN INFUSION NURSE ASSIGNMENT": (
                by_template & (template == codes.TEMPLATE_NURSE_ASSIGNMENT), "first"),
            summary_heading(site): (
                by_template & (template == codes.TEMPLATE_SUMMARY_GIVEN), "first"),
            "Intake Time": (tracked & (value == codes.TRACK_INTAKE), "first"),
            "Check-out Time": (tracked & (value == codes.TRACK_CHECKED_OUT), "last"),
        },
    )


def report(
    wh: Warehouse,
    run_date: date,
    departments: Sequence,
    load_ts: datetime,
    tag: str = "infusion_daily",
    start: datetime | None = None,
    end: datetime | None = None,
    site: str = "",
    stage: Stage | None = None,
    patient: str | None = None,
) -> DataFrame:
    """Report rows before they are shaped for a sink; one row per in-scope visit."""
    stage = usual(wh.spark, "infusion", stage)
    start, end = report_window(run_date, BACK_DAYS, FORWARD_MONTHS, start, end)
    visits = linked_visits(wh, departments, start, end, stage, patient)
    ids = visits.select(CSN)
    encounters = rows_of(wh["PAT_ENC"], ids, CSN).select(CSN, "INPATIENT_DATA_ID")
    providers = wh["CLARITY_SER"].select("PROV_ID", "PROV_NAME")
    resources = enumerate_lines(
        rows_of(wh["PAT_ENC_APPT"], ids, CSN)
        .select(CSN, "LINE", "PROV_ID")
        .join(providers, "PROV_ID", "left"),
        [CSN], "LINE", "PROV_NAME", "Appointment Resource", unique_lines=True,
    )
    notes = enumerate_lines(
        rows_of(wh["PAT_ENC_APPT_NOTES"].filter(non_empty("APPT_NOTE")), ids, CSN),
        [CSN], "LINE", "APPT_NOTE", "Appointment Note", unique_lines=True,
    )
    spans = medication_spans(wh, departments, start, end, stage)
    marks = milestones(wh, encounters, site)
    updates = rows_of(wh["F_SCHED_APPT"], ids, CSN).select(CSN, "UPDATE_DATE")
    units = wh["CLARITY_DEP"].select("DEPARTMENT_ID", "DEPARTMENT_NAME")
    previous_units = units.select(
        F.col("DEPARTMENT_ID").alias("previous_department"),
        F.col("DEPARTMENT_NAME").alias("Previous Unit Name"),
    )
    detail = (
        visits.join(updates, CSN, "left")
        .join(spans.withColumnRenamed("MAR_ENC_CSN", CSN), CSN, "left")
        .join(marks, CSN, "left")
        .join(resources, CSN, "left")
        .join(notes, CSN, "left")
        .join(units, "DEPARTMENT_ID", "left")
        .join(previous_units, "previous_department", "left")
    )
    summary = summary_heading(site)
    rows = detail.select(
        F.col(CSN).alias("Appointment ID"),
        pseudonym("PAT_MRN_ID", 10).alias("PAT_MRN_ID"),
        F.col("DEPARTMENT_NAME").alias("Unit Name"),
        F.col("DEPT_SPECIALTY_NAME").alias("Visit Type"),
        F.col("PRC_NAME").alias("Appointment Type"),
        F.col("APPT_LENGTH").alias("Expected Duration"),
        status_label("APPT_STATUS_C").alias("Appointment Status"),
        round_to_minute("APPT_DTTM").alias("Appointment Time"),
        round_to_minute("CHECKIN_DTTM").alias("Check-in Time"),
        round_to_minute("ARVL_LIST_REMOVE_DTTM").alias("Chair Time"),
        round_to_minute("start_time").alias("First Med Start"),
        round_to_minute("stop_time").alias("Last Med Stop"),
        round_to_minute("BCN INFUSION NURSE ASSIGNMENT").alias("BCN INFUSION NURSE ASSIGNMENT"),
        round_to_minute(summary).alias(summary),
        F.to_date("APPT_MADE_DATE").alias("Appointment Made Date"),
        F.to_date("APPT_CANC_DATE").alias("Cancel Date"),
        link_flag("previous_id").alias("Linked Appointment Flag"),
        F.col("previous_time").alias("Clinic Appointment Time"),
        F.col("previous_length").alias("Clinic Appointment Length"),
        F.col("plan_names").alias("Treatment Plan"),
        F.col("plan_providers").alias("Treatment Plan Provider"),
        round_to_minute("Intake Time").alias("Intake Time"),
        round_to_minute("Check-out Time").alias("Check-out Time"),
        stamp_text(round_to_second("UPDATE_DATE"), blank=False).alias("UPDATE_DATE"),
        # A visit without resource or note lines counts as one empty line.
        F.coalesce("Appointment Resource", F.lit("|")).alias("Appointment Resource"),
        "REFERRING_PROV_NAME_WID",
        F.coalesce("Appointment Note", F.lit("|")).alias("Appointment Note"),
        F.col("CANCEL_REASON_NAME").alias("Cancel Reason Name"),
        F.col("PAT_ID").alias("patient_id"),
        F.col("UPDATE_DATE").alias("update_stamp"),
        "plan_count",
        "Previous Unit Name",
    )
    return with_audit(rows, tag, load_ts)


_LATER = ("Appointment Resource", "REFERRING_PROV_NAME_WID", "Appointment Note", "Cancel Reason Name")


def table_rows(rows: DataFrame, site: str = "", first_revision: bool = False) -> DataFrame:
    """Report rows as the sink table takes them.

    The first revision had no resources, referring provider, note or cancel reason, and did not round
    the update time.
    """
    names = contract(site).names
    if first_revision:
        names = [n for n in names if n not in _LATER]
        rows = rows.withColumn("UPDATE_DATE", stamp_text("update_stamp", blank=False))
    return rows.withColumns(
        {
            "Treatment Plan": clip_list("`Treatment Plan`", 200),
            "Treatment Plan Provider": clip_list("`Treatment Plan Provider`", 18),
            "Appointment Resource": clip_list("`Appointment Resource`", 200),
            "Appointment Note": quote_list("`Appointment Note`", 1000),
        }
    ).select(*[f"`{c}`" for c in names])


def flat_rows(rows: DataFrame, site: str = "") -> DataFrame:
    """Report rows as all text for the flat file, lists in quotes."""
    quoted = rows.withColumns(
        {
            "Treatment Plan": quote_list("`Treatment Plan`", 255),
            "Treatment Plan Provider": quote_list("`Treatment Plan Provider`", 255),
            "Appointment Resource": quote_list("`Appointment Resource`", 255),
            "Appointment Note": quote_list("`Appointment Note`", 1000),
            "Appointment ID": blank("`Appointment ID`", 18),
        }
    )
    return flat_file(quoted, contract(site), {"Unit Name": 255})
