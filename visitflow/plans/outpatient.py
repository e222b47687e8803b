"""Daily outpatient clinic extract: scoped visits with reasons, notes, room and track histories,
milestones and the link to a later infusion visit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow import codes
from visitflow.functions.labels import canonical_code, face_to_face, link_flag
from visitflow.functions.stamps import report_window, round_to_minute
from visitflow.functions.text import blank, comma_safe, non_empty, pseudonym, sanitize_list
from visitflow.operators.cohort import (
    expand_cohort,
    in_scope,
    patient_day_cohort,
    rows_of,
)
from visitflow.operators.linking import link_next
from visitflow.operators.lists import enumerate_lines, measure_history
from visitflow.operators.milestones import milestone_pivot, visit_measures
from visitflow.sources.contracts import clinics as contract
from visitflow.sources.contracts import summary_heading, vitals_heading
from visitflow.sources.load import flat_file, with_audit
from visitflow.sources.staging import Stage, inline, usual
from visitflow.sources.warehouse import Warehouse

BACK_DAYS, FORWARD_MONTHS = 3, 6
FLAT_ORDER = ("DEPARTMENT_NAME", "APPT_DTTM")
CSN = "PAT_ENC_CSN_ID"
STAGE_KEYS = {"cohort": ("PAT_ID", "appt_date"), "visits": (CSN,)}
LINK_PART, LINK_ORDER = ("PAT_ID", "appt_date"), ("APPT_DTTM", CSN)
_STAMPS = (
    "SIGNIN_DTTM", "BEGIN_CHECKIN_DTTM", "ROOMED_DTTM", "NURSE_LEAVE_DTTM", "PHYS_ENTER_DTTM",
    "VISIT_END_DTTM", "CHECKOUT_DTTM",
)
_MINUTES = ("TIME_TO_ROOM_MINUTES", "TIME_IN_ROOM_MINUTES", "CYCLE_TIME_MINUTES")
_APPT = (
    CSN, "PAT_ID", "APPT_DTTM", "DEPARTMENT_ID", "DEPT_SPECIALTY_NAME", "PRC_NAME", "PROV_ID",
    "REFERRAL_ID", "APPT_LENGTH", "APPT_STATUS_C", "CHECKIN_DTTM", "ARVL_LIST_REMOVE_DTTM",
    "APPT_MADE_DTTM", "APPT_CANC_DTTM", *_STAMPS, *_MINUTES,
)


_LINK = ("next_id", "next_time", "next_length", "next_department")


def scoped_visits(
    wh: Warehouse,
    departments: Sequence,
    providers: Sequence,
    start: datetime,
    end: datetime,
    stage: Stage = inline,
) -> DataFrame:
    """Scoped visits on the days of the cohort's patients."""
    appt = wh.on_days("V_SCHED_APPT", "APPT_DTTM", start, end).select(*_APPT)
    scope = in_scope(departments, providers)
    cohort = stage("cohort", patient_day_cohort(appt, wh["PATIENT"], start, end, scope))
    return stage("visits", expand_cohort(appt, cohort, scope))


def linked_visits(
    wh: Warehouse,
    departments: Sequence,
    providers: Sequence,
    target: Sequence,
    start: datetime,
    end: datetime,
    keep_target: bool = False,
    stage: Stage = inline,
) -> DataFrame:
    """Scoped visits with the later same-day target visit they are linked to.

    The current rule looks for the link among scoped visits only. `keep_target` is the earlier
    rule, which also considers visits to the target departments before scoping.
    """
    appt = wh.on_days("V_SCHED_APPT", "APPT_DTTM", start, end).select(*_APPT)
    scope = in_scope(departments, providers)
    cohort = stage("link_cohort", patient_day_cohort(appt, wh["PATIENT"], start, end, scope))
    linkable = scope | F.col("DEPARTMENT_ID").isin(*target) if keep_target else scope
    linked = link_next(
        stage("link_visits", expand_cohort(appt, cohort, linkable)),
        LINK_PART,
        LINK_ORDER,
        "APPT_STATUS_C",
        "DEPARTMENT_ID",
        target,
        scope,
        carry={
            "next_id": F.col(CSN),
            "next_time": round_to_minute("APPT_DTTM"),
            "next_length": F.col("APPT_LENGTH"),
            "next_department": F.col("DEPARTMENT_ID"),
        },
    )
    return stage("links", linked.filter(scope))


def _marks() -> Column:
    answered = F.col("FLO_MEAS_ID").isin(*codes.MEASURES_SUMMARY_GIVEN, *codes.MEASURES_PATIENT_VERIFIED)
    return (answered & (F.col("MEAS_VALUE") == "Yes")) | F.col("FLT_ID").isin(*codes.TEMPLATES_VITALS_MERGED)


def _tracked() -> Column:
    return F.col("FLO_MEAS_ID").isin(codes.MEASURE_ROOM, codes.MEASURE_TRACK)


def measures(wh: Warehouse, visits: DataFrame) -> DataFrame:
    """The visits' flowsheet rows that milestones and histories are made of, in one pass."""
    return visit_measures(
        visits, wh["IP_FLWSHT_REC"], wh["IP_FLWSHT_MEAS"], wh["IP_FLO_GP_DATA"], _marks() | _tracked()
    )


def milestones(measured: DataFrame, site: str = "") -> DataFrame:
    rows = measured.filter(_marks()).withColumn(
        "FLT_ID", canonical_code("FLT_ID", codes.TEMPLATES_VITALS_MERGED, codes.TEMPLATE_VITALS)
    )
    return milestone_pivot(
        rows,
        [CSN],
        "FLT_ID",
        "RECORDED_TIME",
        {
            codes.TEMPLATE_PATIENT_VERIFIED: ("AMB PATIENT VERIFIED", "first"),
            codes.TEMPLATE_SUMMARY_GIVEN: (summary_heading(site), "first"),
            codes.TEMPLATE_VITALS: (vitals_heading(site), "first"),
        },
    )


def histories(measured: DataFrame) -> DataFrame:
    """Room and track histories of a visit as parallel lists."""
    rows = measured.filter(_tracked())
    names = {
        codes.MEASURE_ROOM: ("Patient_Room", "Patient_Room_Recorded_DtTm"),
        codes.MEASURE_TRACK: ("Patient_Track", "Patient_Track_Recorded_DtTm"),
    }
    return measure_history(rows, [CSN], "RECORDED_TIME", "MEAS_VALUE", "FLO_MEAS_ID", names)


def referral_dates(wh: Warehouse) -> DataFrame:
    """Entry and first-change date per referral; several first changes repeat the referral."""
    first_change = wh["REFERRAL_HIST"].filter(
        F.col("CHANGE_TYPE_C") == codes.REFERRAL_FIRST_CHANGE
    )
    return (
        wh["REFERRAL"]
        .select("REFERRAL_ID", "ENTRY_DATE")
        .join(first_change.select("REFERRAL_ID", "CHANGE_DATE"), "REFERRAL_ID", "left")
    )


def report(
    wh: Warehouse,
    run_date: date,
    departments: Sequence,
    load_ts: datetime,
    providers: Sequence = (),
    target: Sequence = (),
    tag: str = "outpatient_daily",
    start: datetime | None = None,
    end: datetime | None = None,
    back_days: int = BACK_DAYS,
    forward_months: int = FORWARD_MONTHS,
    keep_target: bool = False,
    with_link: bool = False,
    with_referrals: bool = False,
    site: str = "",
    stage: Stage | None = None,
) -> DataFrame:
    """Report rows before they are shaped for a sink; one row per scoped visit.

    Lists carry no trailing separator here. No sink takes referral dates or the link to a later visit;
    `with_referrals` and `with_link` add them.
    """
    stage = usual(wh.spark, "outpatient", stage)
    start, end = report_window(run_date, back_days, forward_months, start, end)
    visits = scoped_visits(wh, departments, providers, start, end, stage)
    if with_link:
        links = linked_visits(wh, departments, providers, target, start, end, keep_target, stage)
        visits = visits.join(links.select(CSN, *_LINK), CSN)
    ids = visits.select(CSN)
    encounters = rows_of(wh["PAT_ENC"], ids, CSN).select(
        CSN, "INPATIENT_DATA_ID", "ENC_TYPE_C", F.col(CSN).alias("enc_csn"),
        F.col("APPT_STATUS_C").alias("enc_status"),
    )
    reasons = enumerate_lines(
        rows_of(wh["PAT_ENC_RSN_VISIT"], ids, CSN)
        .select(CSN, "LINE", F.col("ENC_REASON_ID").alias("REASON_VISIT_ID"))
        .join(wh["CL_RSN_FOR_VISIT"], "REASON_VISIT_ID", "left"),
        [CSN], "LINE", "REASON_VISIT_NAME", "reasons", trailing=False, unique_lines=True,
    )
    notes = enumerate_lines(
        rows_of(wh["PAT_ENC_APPT_NOTES"].filter(non_empty("APPT_NOTE")), ids, CSN),
        [CSN], "LINE", "APPT_NOTE", "notes", trailing=False, unique_lines=True,
    )
    measured = stage("measures", measures(wh, encounters.select(CSN, "INPATIENT_DATA_ID")))
    updates = rows_of(wh["F_SCHED_APPT"], ids, CSN).select(CSN, "UPDATE_DATE")
    status = wh["ZC_APPT_STATUS"].select(
        F.col("APPT_STATUS_C").alias("enc_status"), F.col("NAME").alias("APPT_STATUS_NAME")
    )
    detail = (
        visits.join(updates, CSN, "left")
        .join(encounters, CSN, "left")
        .join(reasons, CSN, "left")
        .join(notes, CSN, "left")
        .join(histories(measured), CSN, "left")
        .join(milestones(measured, site), CSN, "left")
        .join(wh["CLARITY_DEP"].select("DEPARTMENT_ID", "DEPARTMENT_NAME"), "DEPARTMENT_ID", "left")
        .join(wh["CLARITY_SER"].select("PROV_ID", "PROV_NAME"), "PROV_ID", "left")
        .join(status, "enc_status", "left")
    )
    if with_referrals:
        detail = detail.join(referral_dates(wh), "REFERRAL_ID", "left")
    has_encounter = F.col("enc_csn").isNotNull()  # lists hang on the encounter record
    summary, vitals = summary_heading(site), vitals_heading(site)
    rows = detail.select(
        F.col(CSN).alias("PAT_ENC_CSN_ID_unhashed"),
        pseudonym("enc_csn", 18).alias(CSN),
        pseudonym("PAT_MRN_ID", 10).alias("PAT_MRN_ID"),
        "DEPARTMENT_NAME",
        "DEPT_SPECIALTY_NAME",
        "PROV_ID",
        "PROV_NAME",
        round_to_minute("APPT_DTTM").alias("APPT_DTTM"),
        F.when(has_encounter, F.col("reasons")).alias("ENC_REASON_NAME"),
        F.when(has_encounter, F.col("notes")).alias("APPT_NOTES"),
        "PRC_NAME",
        "APPT_LENGTH",
        "APPT_STATUS_NAME",
        "APPT_MADE_DTTM",
        "APPT_CANC_DTTM",
        "UPDATE_DATE",
        "SIGNIN_DTTM",
        "BEGIN_CHECKIN_DTTM",
        round_to_minute("CHECKIN_DTTM").alias("CHECKIN_DTTM"),
        "Patient_Room",
        "Patient_Room_Recorded_DtTm",
        "Patient_Track",
        "Patient_Track_Recorded_DtTm",
        round_to_minute("ARVL_LIST_REMOVE_DTTM").alias("ARVL_LIST_REMOVE_DTTM"),
        round_to_minute("AMB PATIENT VERIFIED").alias("AMB PATIENT VERIFIED"),
        round_to_minute(vitals).alias(vitals),
        "ROOMED_DTTM",
        "NURSE_LEAVE_DTTM",
        "PHYS_ENTER_DTTM",
        round_to_minute(summary).alias(summary),
        "VISIT_END_DTTM",
        "CHECKOUT_DTTM",
        *_MINUTES,
        face_to_face("ENC_TYPE_C").alias("F2F_Flag"),
        *([link_flag("next_id", "1", "0").alias("Linked Appointment Flag"), *_LINK] if with_link else ()),
        *(("ENTRY_DATE", "CHANGE_DATE") if with_referrals else ()),
    )
    return with_audit(rows, tag, load_ts)


_PLAIN = {"DEPARTMENT_NAME": 254, "DEPT_SPECIALTY_NAME": 254, "PROV_ID": 18, "PRC_NAME": 254,
          "APPT_STATUS_NAME": 254, "Patient_Room": 1200, "Patient_Room_Recorded_DtTm": 1200,
          "Patient_Track": 1200, "Patient_Track_Recorded_DtTm": 1200}


def table_rows(rows: DataFrame, site: str = "", first_revision: bool = False) -> DataFrame:
    """Report rows as the sink table takes them; the plain encounter id stays in the table.

    `first_revision` leaves commas, ends no list with a separator and has no provider id.
    """
    names = contract(site).names
    texts = {name: blank(name, width) for name, width in _PLAIN.items()}
    if first_revision:
        names.remove("PROV_ID")
        texts |= {"PROV_NAME": blank("PROV_NAME", 200)}
        texts |= {name: blank(name, 1200) for name in ("ENC_REASON_NAME", "APPT_NOTES")}
    else:
        texts["PROV_NAME"] = comma_safe("PROV_NAME", 200)
        texts["ENC_REASON_NAME"] = sanitize_list("ENC_REASON_NAME", 1200, strip_last=False)
        texts["APPT_NOTES"] = comma_safe(F.concat("APPT_NOTES", F.lit("|")), 1200)
    return rows.withColumns(texts).select(*[f"`{c}`" for c in names])


def flat_rows(rows: DataFrame, site: str = "") -> DataFrame:
    """Report rows as all text for the flat file, without the plain encounter id."""
    reasons = sanitize_list("ENC_REASON_NAME", 1200, strip_last=False)
    return flat_file(
        rows.withColumn("ENC_REASON_NAME", reasons), contract(site), {"PROV_ID": 200, "APPT_NOTES": 254}
    )
