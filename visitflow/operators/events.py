"""Visit events, timelines, availability slots and event templates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow import codes
from visitflow.operators.cohort import left_to_many
from visitflow.session import stored

CSN = "PAT_ENC_CSN_ID"

# Appointment stamps shown on a timeline, in visit order
MILESTONE_STAMPS = (
    "APPT_DTTM", "SIGNIN_DTTM", "CHECKIN_DTTM", "ARVL_LIST_REMOVE_DTTM", "ROOMED_DTTM",
    "NURSE_LEAVE_DTTM", "PHYS_ENTER_DTTM", "VISIT_END_DTTM", "CHECKOUT_DTTM",
)


def sample_encounters(
    appointments: DataFrame,
    departments: Sequence,
    since: date,
    status: int = codes.COMPLETED,
    ids: Sequence[int] = (),
) -> DataFrame:
    """Encounter ids by department, contact date floor, status and optionally an id list."""
    rows = appointments.filter(
        F.col("DEPARTMENT_ID").isin(*departments)
        & (F.col("CONTACT_DATE") >= F.lit(since))
        & (F.col("APPT_STATUS_C") == status)
    )
    if ids:
        rows = rows.filter(F.col(CSN).isin(*ids))
    return rows.select(CSN)


def template_catalogue(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Event templates with their class code and class name."""
    templates = tables["ED_EVENT_TMPL_INFO"].select("RECORD_ID", "RECORD_NAME", "EVENT_NAME")
    names = tables["ZC_EVT_TMPLT_CLASS"].select(
        "EVT_TMPLT_CLASS_C", F.col("NAME").alias("CLASS_NAME")
    )
    return templates.join(
        tables["ED_LEV_EVENT_INFO"].select("RECORD_ID", "EVT_TMPLT_CLASS_C"), "RECORD_ID", "left"
    ).join(names, "EVT_TMPLT_CLASS_C", "left")


def event_templates(
    tables: Mapping[str, DataFrame],
    classes: Sequence[str],
    name_prefix: str | None = None,
    or_ids: Sequence[str] = (),
) -> DataFrame:
    """Templates of the given classes (and name prefix), or with one of the given ids."""
    rule = F.col("EVT_TMPLT_CLASS_C").isin(*classes)
    if name_prefix is not None:
        rule = rule & F.col("RECORD_NAME").like(f"{name_prefix}%")
    if or_ids:
        rule = rule | F.col("RECORD_ID").isin(*or_ids)
    return template_catalogue(tables).filter(rule)


def recorded_events(
    tables: Mapping[str, DataFrame],
    encounters: DataFrame,
    types: Sequence[str] = codes.BOARD_EVENT_TYPES,
) -> DataFrame:
    """Events of the encounters, restricted to the given types; one row per event entry.

    The type filter runs on the event scan and the encounter filter on the patient-event scan, so
    both sides of their join are already reduced.
    """
    wanted = encounters.select(CSN).distinct()
    by_patient = tables["ED_IEV_PAT_INFO"].join(wanted, CSN, "left_semi").select(
        "PAT_ID", CSN, F.col("TYPE_ID").alias("TYPE_ID_pat"), "EVENT_ID",
        F.col("EVENT_ID").alias("EVENT_ID_pat"), "DEPT_EVENT_DEP_ID",
    )
    events = tables["ED_IEV_EVENT_INFO"].filter(F.col("EVENT_TYPE").isin(*types))
    events = events.select(
        "EVENT_ID",
        *[
            F.col(c).alias(f"{c}_iev")
            for c in (
                "EVENT_TYPE", "EVENT_DISPLAY_NAME", "LINE", "EVENT_TIME", "EVENT_CMT",
                "EVENT_DEPT_ID", "EVENT_KEY", "EVENT_NOTE_ID", "EVENT_PROV_ID", "LOCATION_ID",
            )
        ],
    )
    return by_patient.join(events, "EVENT_ID").withColumnRenamed("EVENT_ID", "EVENT_ID_iev")


def with_note_lines(events: DataFrame, notes: DataFrame) -> DataFrame:
    """Events repeated for each line of their note; events without a note stay."""
    lines = notes.select(
        F.col("NOTE_ID").alias("EVENT_NOTE_ID_iev"), F.col("LINE").alias("NOTE_LINE"), "NOTE_TEXT"
    )
    return left_to_many(events, lines, "EVENT_NOTE_ID_iev")


def visit_events(
    tables: Mapping[str, DataFrame],
    encounters: DataFrame,
    types: Sequence[str] = codes.BOARD_EVENT_TYPES,
) -> DataFrame:
    """Recorded events with note lines, template and class in both roles, and other details.

    One template catalogue serves the role of the event and the role of the patient's event type.
    """
    catalogue = template_catalogue(tables)

    def in_role(role: str) -> DataFrame:
        return catalogue.select(
            F.col("RECORD_ID").alias(f"RECORD_ID_{role}"),
            F.col("RECORD_NAME").alias(f"RECORD_NAME_{role}"),
            F.col("EVENT_NAME").alias(f"EVENT_NAME_{role}"),
            F.col("EVT_TMPLT_CLASS_C").alias(f"EVT_TMPLT_CLASS_C_{role}"),
            F.col("CLASS_NAME").alias(f"EVT_TMPLT_CLASS_C_name_{role}"),
        )

    departments = tables["CLARITY_DEP"].select(
        F.col("DEPARTMENT_ID").alias("DEPT_EVENT_DEP_ID"), "DEPARTMENT_NAME"
    )
    providers = tables["CLARITY_SER"].select(
        F.col("PROV_ID").alias("EVENT_PROV_ID"), F.col("PROV_NAME").alias("EVENT_PROV_NAME")
    )
    places = tables["CL_PLC"].select(
        F.col("LOCATION_EVNT_ID").alias("LOCATION_ID_iev"),
        F.col("COMMENTS").alias("LOCATION_COMMENTS"),
    )
    events = recorded_events(tables, encounters, types)
    return (
        with_note_lines(events, tables["HNO_NOTE_TEXT"])
        .join(in_role("iev"), F.col("EVENT_TYPE_iev") == F.col("RECORD_ID_iev"), "left")
        .join(in_role("pat"), F.col("TYPE_ID_pat") == F.col("RECORD_ID_pat"), "left")
        .join(departments, "DEPT_EVENT_DEP_ID", "left")
        .join(providers, F.col("EVENT_PROV_ID_iev") == F.col("EVENT_PROV_ID"), "left")
        .join(places, "LOCATION_ID_iev", "left")
    )


def attach_events(appointments: DataFrame, events: DataFrame, on: str = CSN) -> DataFrame:
    """Each appointment with each of its events; appointments without events stay.

    Events meet the bare ids first, so the appointments' details are computed once.
    """
    ids = appointments.select(on).distinct()
    return left_to_many(ids, events, on).join(appointments, on)


def unpivot_stamps(
    appointments: DataFrame, stamps: Sequence[str] = MILESTONE_STAMPS, key: str = CSN
) -> DataFrame:
    """One row per recorded stamp; empty stamps are dropped."""
    return appointments.unpivot([key], list(stamps), "TimeType", "TimeDTTM").filter(
        F.col("TimeDTTM").isNotNull()
    )


def visit_timeline(events: DataFrame, appointments: DataFrame, stamps=MILESTONE_STAMPS) -> DataFrame:
    """Events and appointment stamps as one long list, tagged by origin."""
    happened = events.select(
        F.lit("Event_Data").alias("DataSet"),
        CSN,
        F.col("EVENT_DISPLAY_NAME_iev").alias("EVENT_DISPLAY_NAME"),
        F.lit(None).cast("string").alias("vsa_TimeType"),
        F.col("EVENT_TIME_iev").alias("EVENT_TIME"),
    )
    stamped = unpivot_stamps(appointments, stamps).select(
        F.lit("Appt_Data").alias("DataSet"),
        CSN,
        F.lit(None).cast("string").alias("EVENT_DISPLAY_NAME"),
        F.col("TimeType").alias("vsa_TimeType"),
        F.col("TimeDTTM").alias("EVENT_TIME"),
    )
    return happened.unionByName(stamped)


def reconcile_timeline(
    events: DataFrame, appointments: DataFrame, stamps=MILESTONE_STAMPS
) -> DataFrame:
    """Events matched to appointment stamps of the same encounter at the very same time."""
    happened = stored(
        events.select(
            F.col(CSN).alias("e_csn"),
            F.col("EVENT_DISPLAY_NAME_iev").alias("EVENT_DISPLAY_NAME"),
            F.col("EVENT_TIME_iev").alias("e_time"),
        ),
        "events",
    )
    stamped = unpivot_stamps(appointments, stamps)
    same = (F.col("e_csn") == F.col(CSN)) & (F.col("e_time") == F.col("TimeDTTM"))
    columns = (CSN, "EVENT_DISPLAY_NAME", "TimeType", "TimeDTTM")
    # A full join as left join plus the unmatched stamps: these two can be split when one
    # encounter dominates, a full join cannot.
    with_event = happened.join(stamped, same, "left").select(
        F.col("e_csn").alias(CSN), "EVENT_DISPLAY_NAME", "TimeType", F.col("e_time").alias("TimeDTTM")
    )
    taken = happened.select("e_csn", "e_time").distinct()
    without = stamped.join(taken, same, "left_anti").select(
        CSN, F.lit(None).cast("string").alias("EVENT_DISPLAY_NAME"), "TimeType", "TimeDTTM"
    )
    return with_event.unionByName(without).select(*columns).withColumnRenamed(CSN, "CSN")


def open_and_used_slots(
    slots: DataFrame, encounters: DataFrame, appointments: DataFrame
) -> DataFrame:
    """Slots of the encounters, then the unbooked slots on the dates of those encounters."""
    used = slots.join(encounters.select(CSN).distinct(), CSN, "left_semi")
    dates = (
        appointments.join(encounters.select(CSN).distinct(), CSN, "left_semi")
        .select(F.col("CONTACT_DATE").alias("SLOT_DATE"))
        .distinct()
    )
    # Few dates hold all slots; the join's size check or its splitting keeps them from piling up.
    unbooked = slots.filter(F.col("APPT_NUMBER") == 0).join(dates, "SLOT_DATE", "left_semi")
    return used.unionByName(unbooked)
