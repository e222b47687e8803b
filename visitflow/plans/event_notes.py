"""Ad-hoc event review: events of sampled encounters with department, notes, provider and place."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from visitflow import codes
from visitflow.operators.events import sample_encounters, visit_events
from visitflow.sources.warehouse import Warehouse

COLUMNS = (
    "PAT_ID", "PAT_ENC_CSN_ID", "TYPE_ID_pat", "EVENT_ID_pat", "EVT_TMPLT_CLASS_C_iev",
    "EVT_TMPLT_CLASS_C_name_iev", "EVENT_TYPE_iev", "EVENT_DISPLAY_NAME_iev", "LINE_iev",
    "EVENT_TIME_iev", "DEPARTMENT_NAME", "NOTE_LINE", "NOTE_TEXT", "EVENT_PROV_ID",
    "EVENT_PROV_NAME", "LOCATION_COMMENTS",
)
ORDER = ("PAT_ID", "PAT_ENC_CSN_ID", "EVENT_TIME_iev", "EVENT_ID_pat", "LINE_iev")


def event_notes(
    wh: Warehouse,
    departments: Sequence,
    since: date,
    ids: Sequence[int] = (),
    event_types: Sequence[str] = codes.BOARD_EVENT_TYPES,
    ordered: bool = True,
) -> DataFrame:
    sample = sample_encounters(wh["V_SCHED_APPT"], departments, since, ids=ids)
    rows = visit_events(wh, sample, event_types).select(*COLUMNS)
    return rows.orderBy(*ORDER) if ordered else rows
