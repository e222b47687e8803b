"""Daily status board: recent scoped visits with durations, infections, comments, interpreter
details, and one row per visit event."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow import codes
from visitflow.functions.durations import cycle_time, earliest_after, time_in_room, time_to_room
from visitflow.functions.labels import face_to_face
from visitflow.functions.stamps import report_window, round_to_minute
from visitflow.functions.text import blank, non_empty, pseudonym, sanitize_list
from visitflow.operators.cohort import (
    expand_cohort,
    in_scope,
    left_to_many,
    patient_day_cohort,
    rows_of,
)
from visitflow.operators.conditions import active_condition_list, element_values
from visitflow.operators.events import recorded_events, with_note_lines
from visitflow.operators.lists import enumerate_lines
from visitflow.sources.contracts import status_board as contract
from visitflow.sources.load import flat_file, with_audit
from visitflow.sources.staging import Stage, inline, usual
from visitflow.sources.warehouse import Warehouse

BACK_DAYS = 3
FLAT_ORDER = ("DEPARTMENT_NAME", "APPT_DTTM", "PAT_MRN_ID", "PAT_ENC_CSN_ID", "EVENT_DTTM")
CSN = "PAT_ENC_CSN_ID"
STAGE_KEYS = {"cohort": ("PAT_ID", CSN, "appt_date"), "visits": (CSN,)}
ROOM_STAMPS = ("ARVL_LIST_REMOVE_DTTM", "ROOMED_DTTM", "FIRST_ROOM_ASSIGN_DTTM")
_APPT = (
    CSN, "PAT_ID", "APPT_DTTM", "DEPARTMENT_ID", "DEPT_SPECIALTY_NAME", "PROV_ID", "APPT_LENGTH",
    "APPT_STATUS_C",
)


def with_durations(stamps: DataFrame) -> DataFrame:
    """Time to room, time in room and cycle time from the visit's own stamps."""
    roomed = earliest_after("CHECKIN_DTTM", *ROOM_STAMPS)
    return stamps.withColumns(
        {
            "TIME_TO_ROOM_MINUTES": time_to_room("CHECKIN_DTTM", *ROOM_STAMPS),
            "TIME_IN_ROOM_MINUTES": time_in_room(roomed, "VISIT_END_DTTM", "CHECKOUT_DTTM"),
            "CYCLE_TIME_MINUTES": cycle_time("CHECKIN_DTTM", "VISIT_END_DTTM", "CHECKOUT_DTTM"),
        }
    )


def _named(wh: Warehouse, table: str, key: str, code: str, name: str) -> DataFrame:
    return wh[table].select(F.col(key).alias(code), F.col("NAME").alias(name))


def scoped_visits(
    wh: Warehouse, departments: Sequence, start: datetime, end: datetime, stage: Stage = inline
) -> tuple[DataFrame, DataFrame]:
    """The cohort of encounters, and the scoped visits on its patient-days."""
    appt = wh.on_days("V_SCHED_APPT", "APPT_DTTM", start, end).select(*_APPT)
    scope = in_scope(departments)
    cohort = stage(
        "cohort",
        patient_day_cohort(
            appt, wh["PATIENT"], start, end, scope,
            attributes=("PAT_MRN_ID", "LANGUAGE_C"), extra_keys=(CSN,),
        ),
    )
    days = cohort.select("PAT_ID", "appt_date", "PAT_MRN_ID", "LANGUAGE_C").distinct()
    return cohort, stage("visits", expand_cohort(appt, days, scope))


def visit_details(
    wh: Warehouse, cohort: DataFrame, visits: DataFrame, element: str
) -> DataFrame:
    """Visits with names, durations, note, comment and infection lists; one row per visit."""
    ids = visits.select(CSN)
    notes = enumerate_lines(
        rows_of(wh["PAT_ENC_APPT_NOTES"].filter(non_empty("APPT_NOTE")), ids, CSN),
        [CSN], "LINE", "APPT_NOTE", "APPT_NOTES", trailing=False, unique_lines=True,
    )
    comments = enumerate_lines(
        element_values(
            cohort, wh["SMRTDTA_ELEM_DATA"], wh["SMRTDTA_ELEM_VALUE"], element
        ).withColumnRenamed("CONTACT_SERIAL_NUM", CSN),
        [CSN], "LINE", "SMRTDTA_ELEM_VALUE", "SDE_VALUES", trailing=False, unique_lines=True,
    )
    days = cohort.select("PAT_ID", "appt_date").distinct()
    patients = days.select("PAT_ID").distinct()
    conditions = rows_of(wh["HSP_INFECTION_PL"], patients, "PAT_ID").join(
        wh["ZC_INFECTION"].select("INFECTION_C", F.col("NAME").alias("INFECTION_NAME")),
        "INFECTION_C",
        "left",
    )
    infections = active_condition_list(
        days, conditions, "INFECTION_NAME", "INFECTION_NAMES"
    ).withColumnRenamed("PAT_ID", "enc_pat")
    durations = with_durations(rows_of(wh["F_SCHED_APPT"], ids, CSN)).select(
        CSN, "TIME_TO_ROOM_MINUTES", "TIME_IN_ROOM_MINUTES", "CYCLE_TIME_MINUTES"
    )
    encounters = rows_of(wh["PAT_ENC"], ids, CSN).select(
        CSN, F.col(CSN).alias("enc_csn"), F.col("PAT_ID").alias("enc_pat"), "ENC_TYPE_C",
        F.col("APPT_STATUS_C").alias("enc_status"), "INTERPRETER_NEED_YN", "INTRP_ASSIGNMENT_C",
        "ASGND_INTERP_TYPE_C", "INTERPRETER_VEND_C",
    )
    detail = (
        visits.join(durations, CSN, "left")
        .join(encounters, CSN, "left")
        .join(notes, CSN, "left")
        .join(comments, CSN, "left")
        .join(infections, ["enc_pat", "appt_date"], "left")
        .join(wh["CLARITY_DEP"].select("DEPARTMENT_ID", "DEPARTMENT_NAME"), "DEPARTMENT_ID", "left")
        .join(wh["CLARITY_SER"].select("PROV_ID", "PROV_NAME"), "PROV_ID", "left")
    )
    lookups = (
        ("ZC_APPT_STATUS", "APPT_STATUS_C", "enc_status", "APPT_STATUS_NAME"),
        ("ZC_DISP_ENC_TYPE", "DISP_ENC_TYPE_C", "ENC_TYPE_C", "ENC_TYPE_NAME"),
        ("ZC_LANGUAGE", "LANGUAGE_C", "LANGUAGE_C", "PRIMARY_LANGUAGE"),
        ("ZC_INTRP_ASSIGNMEN", "INTRP_ASSIGNMEN_C", "INTRP_ASSIGNMENT_C", "INTERPRETER_ASSIGNMENT"),
        ("ZC_ASGND_INTERP_TY", "ASGND_INTERP_TY_C", "ASGND_INTERP_TYPE_C", "INTERPRETER_TYPE"),
        ("ZC_INTERPRETER_VEN", "INTERPRETER_VEN_C", "INTERPRETER_VEND_C", "INTERPRETER_VENDOR"),
    )
    for table, key, code, name in lookups:
        detail = detail.join(_named(wh, table, key, code, name), code, "left")
    has_encounter = F.col("enc_csn").isNotNull()
    return detail.withColumns(
        {
            "APPT_NOTES": F.when(has_encounter, F.col("APPT_NOTES")),
            "SDE_VALUES": F.when(has_encounter, F.col("SDE_VALUES")),
            "F2F_Flag": face_to_face("ENC_TYPE_C"),
        }
    )


def report(
    wh: Warehouse,
    run_date: date,
    departments: Sequence,
    load_ts: datetime,
    element: str,
    tag: str = "status_board_daily",
    start: datetime | None = None,
    end: datetime | None = None,
    forward_months: int | None = None,
    event_types: Sequence[str] = codes.BOARD_EVENT_TYPES,
    stage: Stage | None = None,
) -> DataFrame:
    """Report rows: each visit with each of its events, or once without. Lists are unterminated."""
    stage = usual(wh.spark, "status_board", stage)
    start, end = report_window(run_date, BACK_DAYS, forward_months, start, end)
    cohort, visits = scoped_visits(wh, departments, start, end, stage)
    ids = visits.select(CSN)
    detail = visit_details(wh, cohort, visits, element)
    # Of the event details the board shows none, but an event repeats for each note line.
    recorded = stage("events", recorded_events(wh, ids, event_types))
    events = with_note_lines(recorded, wh["HNO_NOTE_TEXT"]).select(
        CSN, "EVENT_DISPLAY_NAME_iev", "EVENT_TIME_iev"
    )
    shown = left_to_many(ids, events, CSN)
    rows = shown.join(detail, CSN).select(
        F.col(CSN).alias("PAT_ENC_CSN_ID_unhashed"),
        pseudonym("enc_csn", 18).alias(CSN),
        pseudonym("PAT_MRN_ID", 10).alias("PAT_MRN_ID"),
        "DEPARTMENT_NAME",
        "PROV_NAME",
        F.col("EVENT_DISPLAY_NAME_iev").alias("EVENT_DISPLAY_NAME"),
        F.col("INFECTION_NAMES").alias("INFECTION_STATUS"),
        "APPT_NOTES",
        F.col("EVENT_TIME_iev").alias("EVENT_DTTM"),
        F.col("SDE_VALUES").alias("VISIT_FLOW_COMMENTS"),
        "PRIMARY_LANGUAGE",
        "INTERPRETER_ASSIGNMENT",
        "INTERPRETER_TYPE",
        "INTERPRETER_VENDOR",
        "APPT_STATUS_NAME",
        round_to_minute("APPT_DTTM").alias("APPT_DTTM"),
        "APPT_LENGTH",
        "ENC_TYPE_NAME",
        "TIME_TO_ROOM_MINUTES",
        "TIME_IN_ROOM_MINUTES",
        "CYCLE_TIME_MINUTES",
    )
    return with_audit(rows, tag, load_ts)


_LISTS = ("INFECTION_STATUS", "APPT_NOTES", "VISIT_FLOW_COMMENTS")
_NUMBERS = ("APPT_LENGTH", "TIME_TO_ROOM_MINUTES", "TIME_IN_ROOM_MINUTES", "CYCLE_TIME_MINUTES")


def _texts(rows: DataFrame, first_revision: bool = False) -> DataFrame:
    def shaped(column):
        if column.name not in _LISTS:
            return blank(column.name, column.width)
        if first_revision:
            return blank(column.name, 254)
        return sanitize_list(column.name, column.width, strip_last=False)

    texts = [c for c in contract().columns if c.width is not None]
    return rows.withColumns({c.name: shaped(c) for c in texts})


def table_rows(
    rows: DataFrame, legacy_blanks: bool = False, first_revision: bool = False
) -> DataFrame:
    """Report rows as the sink table takes them.

    Missing numbers and visit times stay null. `legacy_blanks` writes them as the source system
    did, where a blank text became 0 or 1900-01-01. `first_revision` cuts lists at 254 characters
    and leaves their commas, as the first version of the extract did.
    """
    out = _texts(rows, first_revision)
    if legacy_blanks:
        epoch = F.to_timestamp_ntz(F.lit("1900-01-01 00:00:00"))
        filled = {n: F.coalesce(n, F.lit(0)) for n in _NUMBERS}
        out = out.withColumns({**filled, "APPT_DTTM": F.coalesce("APPT_DTTM", epoch)})
    return out.select(*contract().names)


def flat_rows(rows: DataFrame) -> DataFrame:
    return flat_file(_texts(rows), contract())
