"""Ad-hoc reviews: provider notes, timestamp review, treatment-plan drill-down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.functions.text import clip
from visitflow.operators.lists import enumerate_lines
from visitflow.sources.warehouse import Warehouse

CSN = "PAT_ENC_CSN_ID"


def provider_notes(wh: Warehouse, providers: Sequence, ordered: bool = True) -> DataFrame:
    """Flattened appointment notes of every encounter of the given visit providers."""
    mine = wh["PAT_ENC"].filter(F.col("VISIT_PROV_ID").isin(*providers)).select(CSN)
    notes = enumerate_lines(
        wh["PAT_ENC_APPT_NOTES"].join(mine, CSN, "left_semi"),
        [CSN], "LINE", "APPT_NOTE", "whole_note", trailing=False, nulls="skip",
    )
    appointments = wh["V_SCHED_APPT"].select(
        CSN,
        "CONTACT_DATE",
        F.col("APPT_STATUS_NAME").alias("APPT_STATUS"),
        "DEPARTMENT_ID",
        "DEPARTMENT_NAME",
        "PROV_NAME_WID",
        F.col("PRC_NAME").alias("VISIT_TYPE"),
    )
    kinds = wh["V_PAT_ENC"].select(CSN, F.col("ENC_TYPE_TITLE").alias("ENC_TYPE"))
    rows = (
        notes.join(appointments, CSN, "left")
        .join(kinds, CSN, "left")
        .select(
            F.col(CSN).alias("Encounter_CSN"),
            F.lit("").alias("COMM_TYPE"),
            clip("whole_note", 255).alias("APPT_NOTE"),
            "CONTACT_DATE", "APPT_STATUS", "DEPARTMENT_ID", "DEPARTMENT_NAME", "PROV_NAME_WID",
            "VISIT_TYPE", "ENC_TYPE", "whole_note",
        )
    )
    return (rows.orderBy("whole_note") if ordered else rows).drop("whole_note")


REVIEW_STAMPS = (
    "ARVL_LIST_REMOVE_DTTM", "ROOMED_DTTM", "FIRST_ROOM_ASSIGN_DTTM", "TIME_TO_ROOM_MINUTES",
)


def timestamp_review(
    extract: DataFrame, appointments: DataFrame, status: str = "comp", ordered: bool = True
) -> DataFrame:
    """Completed infusion visits beside their raw room stamps."""
    raw = appointments.select(F.col(CSN).alias("Appointment ID"), *REVIEW_STAMPS)
    rows = extract.filter(F.col("`Appointment Status`") == status).join(
        raw, "Appointment ID", "left"
    )
    return rows.orderBy("`Unit Name`", "`Appointment Time`") if ordered else rows


def drill_down(df: DataFrame, predicate: Column, order: Sequence[str] = ()) -> DataFrame:
    """Rows of an intermediate or final result that satisfy a predicate, in a readable order."""
    rows = df.filter(predicate)
    return rows.orderBy(*order) if order else rows
