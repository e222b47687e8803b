"""Column contracts of the sinks.

`site` is the prefix the hospital puts in front of its own flowsheet headings; without one the
headings are plain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SinkColumn:
    name: str
    type: T.DataType
    width: int | None = None  # text columns
    required: bool = False
    minute: bool = False  # stamps kept to the minute


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[SinkColumn, ...]
    key: tuple[str, ...] = ()
    private: tuple[str, ...] = ()  # kept in the table, left out of the flat file

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, not c.required) for c in self.columns])


def _id(name: str) -> SinkColumn:
    return SinkColumn(name, T.DecimalType(18, 0), required=True)


def _text(name: str, width: int, required: bool = False) -> SinkColumn:
    return SinkColumn(name, T.StringType(), width, required)


def _time(name: str, minute: bool = False) -> SinkColumn:
    return SinkColumn(name, T.TimestampNTZType(), minute=minute)


def _int(name: str) -> SinkColumn:
    return SinkColumn(name, T.IntegerType())


AUDIT = (_text("ETL_guid", 50), _time("Load_Dte", minute=True))


def summary_heading(site: str = "") -> str:
    """Heading of the stamp at which the visit summary was explained to the patient."""
    return f"T {site} AMB PATIENT UNDERSTANDING AVS" if site else "AMB PATIENT UNDERSTANDING AVS"


def vitals_heading(site: str = "") -> str:
    return f"{site} AMB VITALS SIMPLE" if site else "AMB VITALS SIMPLE"


def infusion(site: str = "") -> Contract:
    columns = (
        _id("Appointment ID"), _text("PAT_MRN_ID", 256), _text("Unit Name", 254),
        _text("Visit Type", 50), _text("Appointment Type", 200), _int("Expected Duration"),
        _text("Appointment Status", 20), _time("Appointment Time"), _time("Check-in Time"),
        _time("Chair Time"), _time("First Med Start"), _time("Last Med Stop"),
        _time("BCN INFUSION NURSE ASSIGNMENT"), _time(summary_heading(site)),
        _time("Appointment Made Date"), _time("Cancel Date"), _text("Linked Appointment Flag", 1),
        _time("Clinic Appointment Time"), _int("Clinic Appointment Length"),
        _text("Treatment Plan", 1200), _text("Treatment Plan Provider", 1200),
        _time("Intake Time"), _time("Check-out Time"), _text("UPDATE_DATE", 19),
        _text("Appointment Resource", 1200), _text("REFERRING_PROV_NAME_WID", 221),
        _text("Appointment Note", 1000), _text("Cancel Reason Name", 1200), *AUDIT,
    )
    return Contract("infusion_extract", columns, key=("Appointment ID",))


def clinics(site: str = "", with_private: bool = True) -> Contract:
    """The table with the plain encounter id and provider id, or the older one without both."""
    private = (_id("PAT_ENC_CSN_ID_unhashed"),) if with_private else ()
    provider = (_text("PROV_ID", 18),) if with_private else ()
    columns = (
        *private, _text("PAT_ENC_CSN_ID", 256, required=True), _text("PAT_MRN_ID", 256),
        _text("DEPARTMENT_NAME", 254), _text("DEPT_SPECIALTY_NAME", 254), *provider,
        _text("PROV_NAME", 200), _time("APPT_DTTM"), _text("ENC_REASON_NAME", 1200),
        _text("APPT_NOTES", 1200), _text("PRC_NAME", 254), _int("APPT_LENGTH"),
        _text("APPT_STATUS_NAME", 254), _time("APPT_MADE_DTTM"), _time("APPT_CANC_DTTM"),
        _time("UPDATE_DATE"), _time("SIGNIN_DTTM"), _time("BEGIN_CHECKIN_DTTM"),
        _time("CHECKIN_DTTM"), _text("Patient_Room", 1200),
        _text("Patient_Room_Recorded_DtTm", 1200), _text("Patient_Track", 1200),
        _text("Patient_Track_Recorded_DtTm", 1200), _time("ARVL_LIST_REMOVE_DTTM"),
        _time("AMB PATIENT VERIFIED"), _time(vitals_heading(site)), _time("ROOMED_DTTM"),
        _time("NURSE_LEAVE_DTTM"), _time("PHYS_ENTER_DTTM"), _time(summary_heading(site)),
        _time("VISIT_END_DTTM"), _time("CHECKOUT_DTTM"), _int("TIME_TO_ROOM_MINUTES"),
        _int("TIME_IN_ROOM_MINUTES"), _int("CYCLE_TIME_MINUTES"), *AUDIT,
    )
    kept = ("PAT_ENC_CSN_ID_unhashed",) if with_private else ()
    return Contract("clinics_extract", columns, key=kept, private=kept)


def status_board() -> Contract:
    columns = (
        _id("PAT_ENC_CSN_ID_unhashed"), _text("PAT_ENC_CSN_ID", 256, required=True),
        _text("PAT_MRN_ID", 256), _text("DEPARTMENT_NAME", 254), _text("PROV_NAME", 200),
        _text("EVENT_DISPLAY_NAME", 254), _text("INFECTION_STATUS", 1200),
        _text("APPT_NOTES", 1200), _time("EVENT_DTTM"), _text("VISIT_FLOW_COMMENTS", 1200),
        _text("PRIMARY_LANGUAGE", 200), _text("INTERPRETER_ASSIGNMENT", 254),
        _text("INTERPRETER_TYPE", 254), _text("INTERPRETER_VENDOR", 254),
        _text("APPT_STATUS_NAME", 254), _time("APPT_DTTM"), _int("APPT_LENGTH"),
        _text("ENC_TYPE_NAME", 254), _int("TIME_TO_ROOM_MINUTES"), _int("TIME_IN_ROOM_MINUTES"),
        _int("CYCLE_TIME_MINUTES"), *AUDIT,
    )
    return Contract("status_board_extract", columns, private=("PAT_ENC_CSN_ID_unhashed",))
