"""Event, timeline, slot and review queries."""

from datetime import date

from fixtures.registry import query
from fixtures.sql import CSN, escaped, ids
from visitflow.codes import BOARD_EVENT_TYPES
from visitflow.operators.events import (
    attach_events,
    event_templates,
    open_and_used_slots,
    reconcile_timeline,
    sample_encounters,
    unpivot_stamps,
    visit_events,
    visit_timeline,
)
from visitflow.plans.event_notes import COLUMNS, event_notes
from visitflow.plans.reviews import provider_notes

SINCE = date(2024, 1, 2)
SAMPLE_DEPARTMENTS = tuple(range(20))
SAMPLE_SQL = f"""
    csns AS (SELECT {CSN} FROM V_SCHED_APPT WHERE DEPARTMENT_ID IN {ids(SAMPLE_DEPARTMENTS)}
             AND CONTACT_DATE >= DATE '2024-01-02' AND APPT_STATUS_C = 2)"""
# Events of the encounters in `csns`; one catalogue names the event's and the patient's template.
EVENTS_SQL = f"""
    catalogue AS (SELECT t.RECORD_ID, t.RECORD_NAME, l.EVT_TMPLT_CLASS_C AS class, c.NAME AS class_name
                  FROM ED_EVENT_TMPL_INFO t LEFT JOIN ED_LEV_EVENT_INFO l ON l.RECORD_ID = t.RECORD_ID
                    LEFT JOIN ZC_EVT_TMPLT_CLASS c ON c.EVT_TMPLT_CLASS_C = l.EVT_TMPLT_CLASS_C),
    happened AS (SELECT * FROM ED_IEV_EVENT_INFO WHERE EVENT_TYPE IN {ids(BOARD_EVENT_TYPES)}),
    iev AS (SELECT p.PAT_ID, p.{CSN}, p.TYPE_ID AS "TYPE_ID_pat", EVENT_ID AS "EVENT_ID_pat",
        EVENT_TYPE AS "EVENT_TYPE_iev", EVENT_ID AS "EVENT_ID_iev",
        EVENT_DISPLAY_NAME AS "EVENT_DISPLAY_NAME_iev", e.LINE AS "LINE_iev",
        EVENT_TIME AS "EVENT_TIME_iev", EVENT_CMT AS "EVENT_CMT_iev",
        own.RECORD_NAME AS "RECORD_NAME_iev", own.class AS "EVT_TMPLT_CLASS_C_iev",
        own.class_name AS "EVT_TMPLT_CLASS_C_name_iev", kind.RECORD_NAME AS "RECORD_NAME_pat",
        kind.class AS "EVT_TMPLT_CLASS_C_pat", kind.class_name AS "EVT_TMPLT_CLASS_C_name_pat",
        p.DEPT_EVENT_DEP_ID, d.DEPARTMENT_NAME, n.LINE AS NOTE_LINE, n.NOTE_TEXT,
        s.PROV_ID AS EVENT_PROV_ID, s.PROV_NAME AS EVENT_PROV_NAME, l.COMMENTS AS LOCATION_COMMENTS
      FROM happened e LEFT JOIN catalogue own ON own.RECORD_ID = EVENT_TYPE
        LEFT JOIN CL_PLC l ON l.LOCATION_EVNT_ID = LOCATION_ID
        LEFT JOIN CLARITY_SER s ON s.PROV_ID = EVENT_PROV_ID
        LEFT JOIN HNO_NOTE_TEXT n ON n.NOTE_ID = EVENT_NOTE_ID
        JOIN ED_IEV_PAT_INFO p USING (EVENT_ID)
        LEFT JOIN CLARITY_DEP d ON d.DEPARTMENT_ID = p.DEPT_EVENT_DEP_ID
        LEFT JOIN catalogue kind ON kind.RECORD_ID = p.TYPE_ID
      WHERE p.{CSN} IN (SELECT {CSN} FROM csns))"""
STAMP_NAMES = (
    "APPT_DTTM, SIGNIN_DTTM, CHECKIN_DTTM, ARVL_LIST_REMOVE_DTTM, ROOMED_DTTM, NURSE_LEAVE_DTTM,"
    " PHYS_ENTER_DTTM, VISIT_END_DTTM, CHECKOUT_DTTM"
)
STAMPS_SQL = f"""
    stamps AS (SELECT {CSN}, "TimeType", "TimeDTTM" FROM (
      UNPIVOT (SELECT {CSN}, {STAMP_NAMES} FROM V_SCHED_APPT WHERE {CSN} IN (SELECT {CSN} FROM csns))
      ON {STAMP_NAMES} INTO NAME "TimeType" VALUE "TimeDTTM") x)"""
ALL_SQL = f"csns AS (SELECT {CSN} FROM V_SCHED_APPT)"


@query("sample_encounters", f"WITH {SAMPLE_SQL} SELECT {CSN} FROM csns")
def sample(wh):
    return sample_encounters(wh["V_SCHED_APPT"], SAMPLE_DEPARTMENTS, SINCE)


SAMPLE_IDS = tuple(range(0, 2000, 3))


@query("sample_encounters_by_id", f"WITH {SAMPLE_SQL} SELECT {CSN} FROM csns WHERE {CSN} IN {ids(SAMPLE_IDS)}")
def _(wh):
    return sample_encounters(wh["V_SCHED_APPT"], SAMPLE_DEPARTMENTS, SINCE, ids=SAMPLE_IDS)


EVENT_COLUMNS = (
    "PAT_ID", CSN, "TYPE_ID_pat", "EVENT_ID_pat", "EVENT_TYPE_iev", "EVENT_ID_iev",
    "EVENT_DISPLAY_NAME_iev", "LINE_iev", "EVENT_TIME_iev", "EVENT_CMT_iev", "RECORD_NAME_iev",
    "EVT_TMPLT_CLASS_C_iev", "EVT_TMPLT_CLASS_C_name_iev", "RECORD_NAME_pat",
    "EVT_TMPLT_CLASS_C_pat", "EVT_TMPLT_CLASS_C_name_pat", "DEPT_EVENT_DEP_ID", "DEPARTMENT_NAME",
    "NOTE_LINE", "NOTE_TEXT", "EVENT_PROV_ID", "EVENT_PROV_NAME", "LOCATION_COMMENTS",
)


@query("visit_events", f"WITH {ALL_SQL}, {EVENTS_SQL} SELECT * FROM iev")
def _(wh):
    return visit_events(wh, wh["V_SCHED_APPT"]).select(*EVENT_COLUMNS)


@query(
    "attach_events",
    f"""WITH {ALL_SQL}, {EVENTS_SQL}
        SELECT a.{CSN}, "EVENT_ID_iev", "EVENT_TIME_iev", NOTE_LINE
        FROM V_SCHED_APPT a LEFT JOIN iev ON iev.{CSN} = a.{CSN}""",
)
def _(wh):
    events = visit_events(wh, wh["V_SCHED_APPT"]).select(
        CSN, "EVENT_ID_iev", "EVENT_TIME_iev", "NOTE_LINE"
    )
    return attach_events(wh["V_SCHED_APPT"].select(CSN), events)


@query(
    "event_notes",
    f"""WITH {SAMPLE_SQL}, {EVENTS_SQL}
        SELECT {", ".join(f'"{c}"' for c in COLUMNS)} FROM iev""",
)
def _(wh):
    return event_notes(wh, SAMPLE_DEPARTMENTS, SINCE)


def _sampled(wh):
    return wh["V_SCHED_APPT"].join(sample(wh), CSN, "left_semi")


@query("unpivot_stamps", f"WITH {ALL_SQL}, {STAMPS_SQL} SELECT * FROM stamps")
def _(wh):
    return unpivot_stamps(wh["V_SCHED_APPT"])


@query(
    "visit_timeline",
    f"""WITH {SAMPLE_SQL}, {EVENTS_SQL}, {STAMPS_SQL}
        SELECT 'Event_Data' AS "DataSet", {CSN}, "EVENT_DISPLAY_NAME_iev" AS "EVENT_DISPLAY_NAME",
          CAST(NULL AS VARCHAR) AS "vsa_TimeType", "EVENT_TIME_iev" AS "EVENT_TIME" FROM iev
        UNION ALL
        SELECT 'Appt_Data', {CSN}, NULL, "TimeType", "TimeDTTM" FROM stamps""",
)
def _(wh):
    return visit_timeline(visit_events(wh, sample(wh)), _sampled(wh))


@query(
    "reconcile_timeline",
    f"""WITH {SAMPLE_SQL}, {EVENTS_SQL}, {STAMPS_SQL}
        SELECT coalesce(iev.{CSN}, stamps.{CSN}) AS "CSN",
          "EVENT_DISPLAY_NAME_iev" AS "EVENT_DISPLAY_NAME", "TimeType",
          coalesce("EVENT_TIME_iev", "TimeDTTM") AS "TimeDTTM"
        FROM iev FULL OUTER JOIN stamps ON iev.{CSN} = stamps.{CSN}
          AND "EVENT_TIME_iev" = "TimeDTTM" """,
)
def _(wh):
    return reconcile_timeline(visit_events(wh, sample(wh)), _sampled(wh))


@query(
    "open_and_used_slots",
    f"""WITH {SAMPLE_SQL}
        SELECT v.* FROM V_AVAILABILITY v JOIN csns ON csns.{CSN} = v.{CSN}
        UNION ALL
        SELECT v.* FROM V_AVAILABILITY v WHERE APPT_NUMBER = 0 AND SLOT_DATE IN (
          SELECT DISTINCT a.CONTACT_DATE FROM csns LEFT JOIN V_SCHED_APPT a ON a.{CSN} = csns.{CSN})""",
)
def _(wh):
    return open_and_used_slots(wh["V_AVAILABILITY"], sample(wh), wh["V_SCHED_APPT"]).select(
        CSN, "APPT_NUMBER", "SLOT_DATE"
    )


@query(
    "event_templates",
    """SELECT t.RECORD_ID, RECORD_NAME, EVENT_NAME, c.EVT_TMPLT_CLASS_C, z.NAME AS CLASS_NAME
       FROM ED_EVENT_TMPL_INFO t LEFT JOIN ED_LEV_EVENT_INFO c ON c.RECORD_ID = t.RECORD_ID
         LEFT JOIN ZC_EVT_TMPLT_CLASS z ON z.EVT_TMPLT_CLASS_C = c.EVT_TMPLT_CLASS_C
       WHERE (c.EVT_TMPLT_CLASS_C IN ('30', '56009') AND RECORD_NAME LIKE 'WAITING%')
         OR t.RECORD_ID IN ('1400000222', '2104200001')""",
)
def _(wh):
    return event_templates(
        wh, ["30", "56009"], name_prefix="WAITING", or_ids=["1400000222", "2104200001"]
    ).select("RECORD_ID", "RECORD_NAME", "EVENT_NAME", "EVT_TMPLT_CLASS_C", "CLASS_NAME")


NOTE_PROVIDERS = (0, 1, 2, 3, 4)


@query(
    "provider_notes",
    f"""WITH flat AS (SELECT {CSN}, string_agg({escaped("APPT_NOTE")}, '|' ORDER BY LINE) AS note
                      FROM PAT_ENC_APPT_NOTES GROUP BY {CSN})
        SELECT flat.{CSN} AS "Encounter_CSN", '' AS COMM_TYPE, left(note, 255) AS APPT_NOTE,
          CONTACT_DATE, APPT_STATUS_NAME AS APPT_STATUS, DEPARTMENT_ID, DEPARTMENT_NAME,
          PROV_NAME_WID, PRC_NAME AS VISIT_TYPE, ENC_TYPE_TITLE AS ENC_TYPE
        FROM flat JOIN (SELECT {CSN} FROM PAT_ENC WHERE VISIT_PROV_ID IN {ids(NOTE_PROVIDERS)}) i
            ON i.{CSN} = flat.{CSN}
          LEFT JOIN V_SCHED_APPT a ON a.{CSN} = flat.{CSN}
          LEFT JOIN V_PAT_ENC p ON p.{CSN} = flat.{CSN}""",
)
def _(wh):
    return provider_notes(wh, NOTE_PROVIDERS)
