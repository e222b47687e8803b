"""Hospital source tables derived from the generic test tables.

The test data holds no hospital records, so every source table is derived from whole test tables
by SQL that Spark and DuckDB both run. `{name}` refers to a raw or derived table, `{TS}` to the
zone-less timestamp type.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from visitflow.sources.warehouse import Warehouse

RAW = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _visit_time(csn: str) -> str:
    return (
        f"{{TS}} '2024-01-01 07:00:00' + ({csn} % 5) * INTERVAL '1' DAY"
        f" + (({csn} * 37) % 600) * INTERVAL '1' MINUTE + ({csn} % 60) * INTERVAL '1' SECOND"
    )


def _after(minutes: str, missing: str, column: str = "t") -> str:
    return f"CASE WHEN {missing} THEN NULL ELSE {column} + ({minutes}) * INTERVAL '1' MINUTE END"


_ORDER_MED = "l_orderkey * 2 + l_suppkey % 2"
_EVENT_CSN = "CAST((event_id - event_id % 5) / 5 AS BIGINT)"

VIEWS = {
    "PATIENT": """
        SELECT 'Z' || CAST(c_custkey AS STRING) AS PAT_ID,
          CASE WHEN c_custkey % 17 = 3 THEN NULL ELSE 'M' || CAST(c_custkey * 1000003 AS STRING) END
            AS PAT_MRN_ID,
          c_name AS PAT_NAME, CAST(c_nationkey AS BIGINT) AS LANGUAGE_C
        FROM {customer}""",
    "F_SCHED_APPT": f"""
        SELECT PAT_ENC_CSN_ID, t + (PAT_ENC_CSN_ID % 13) * INTERVAL '1' HOUR AS UPDATE_DATE,
          {_after("PAT_ENC_CSN_ID % 30 - 10", "PAT_ENC_CSN_ID % 11 = 0")} AS CHECKIN_DTTM,
          {_after("PAT_ENC_CSN_ID * 3 % 60 - 5", "PAT_ENC_CSN_ID % 5 = 0")}
            + (PAT_ENC_CSN_ID % 59) * INTERVAL '1' SECOND AS ARVL_LIST_REMOVE_DTTM,
          {_after("PAT_ENC_CSN_ID * 2 % 50", "PAT_ENC_CSN_ID % 3 = 0")} AS ROOMED_DTTM,
          {_after("PAT_ENC_CSN_ID * 4 % 70", "PAT_ENC_CSN_ID % 2 = 0")} AS FIRST_ROOM_ASSIGN_DTTM,
          {_after("PAT_ENC_CSN_ID * 5 % 120", "PAT_ENC_CSN_ID % 4 = 0")} AS VISIT_END_DTTM,
          {_after("PAT_ENC_CSN_ID * 7 % 150", "PAT_ENC_CSN_ID % 6 = 0")} AS CHECKOUT_DTTM
        FROM (SELECT o_orderkey AS PAT_ENC_CSN_ID, {_visit_time("o_orderkey")} AS t
              FROM {{orders}}) x""",
    "V_SCHED_APPT": f"""
        SELECT PAT_ENC_CSN_ID, 'Z' || CAST(o_custkey AS STRING) AS PAT_ID, t AS APPT_DTTM,
          CAST(t AS DATE) AS CONTACT_DATE,
          PAT_ENC_CSN_ID % 25 AS DEPARTMENT_ID,
          'NATION_' || CAST(PAT_ENC_CSN_ID % 25 AS STRING) AS DEPARTMENT_NAME,
          'Specialty ' || CAST(PAT_ENC_CSN_ID % 6 AS STRING) AS DEPT_SPECIALTY_NAME,
          o_orderpriority AS PRC_NAME, PAT_ENC_CSN_ID % 10 AS PROV_ID,
          'Supplier ' || CAST(PAT_ENC_CSN_ID % 10 AS STRING) || ' [x]' AS PROV_NAME_WID,
          CASE WHEN o_custkey % 4 = 0 THEN NULL
               ELSE 'Referrer ' || CAST(o_custkey % 40 AS STRING) END AS REFERRING_PROV_NAME_WID,
          CASE WHEN (PAT_ENC_CSN_ID * 7 + o_custkey) % 7 + 1 = 3
               THEN 'Reason ' || o_orderstatus END AS CANCEL_REASON_NAME,
          o_custkey AS REFERRAL_ID, 15 * (1 + PAT_ENC_CSN_ID % 8) AS APPT_LENGTH,
          (PAT_ENC_CSN_ID * 7 + o_custkey) % 7 + 1 AS APPT_STATUS_C,
          'Status ' || CAST((PAT_ENC_CSN_ID * 7 + o_custkey) % 7 + 1 AS STRING) AS APPT_STATUS_NAME,
          o_orderdate AS APPT_MADE_DATE, o_orderdate + INTERVAL '9' HOUR AS APPT_MADE_DTTM,
          CASE WHEN (PAT_ENC_CSN_ID * 7 + o_custkey) % 7 + 1 = 3 THEN o_orderdate END
            AS APPT_CANC_DATE,
          CASE WHEN (PAT_ENC_CSN_ID * 7 + o_custkey) % 7 + 1 = 3
               THEN o_orderdate + INTERVAL '10' HOUR END AS APPT_CANC_DTTM,
          {_after("PAT_ENC_CSN_ID % 20 - 15", "PAT_ENC_CSN_ID % 7 = 0")} AS SIGNIN_DTTM,
          {_after("PAT_ENC_CSN_ID % 20 - 12", "PAT_ENC_CSN_ID % 7 = 1")} AS BEGIN_CHECKIN_DTTM,
          {_after("PAT_ENC_CSN_ID % 30 - 10", "PAT_ENC_CSN_ID % 11 = 0")} AS CHECKIN_DTTM,
          {_after("PAT_ENC_CSN_ID * 3 % 60 - 5", "PAT_ENC_CSN_ID % 5 = 0")}
            + (PAT_ENC_CSN_ID % 59) * INTERVAL '1' SECOND AS ARVL_LIST_REMOVE_DTTM,
          {_after("PAT_ENC_CSN_ID * 2 % 50", "PAT_ENC_CSN_ID % 3 = 0")} AS ROOMED_DTTM,
          {_after("PAT_ENC_CSN_ID * 4 % 70", "PAT_ENC_CSN_ID % 2 = 0")} AS FIRST_ROOM_ASSIGN_DTTM,
          {_after("PAT_ENC_CSN_ID % 33", "PAT_ENC_CSN_ID % 8 = 0")} AS NURSE_LEAVE_DTTM,
          {_after("PAT_ENC_CSN_ID % 44", "PAT_ENC_CSN_ID % 9 = 0")} AS PHYS_ENTER_DTTM,
          {_after("PAT_ENC_CSN_ID * 5 % 120", "PAT_ENC_CSN_ID % 4 = 0")} AS VISIT_END_DTTM,
          {_after("PAT_ENC_CSN_ID * 7 % 150", "PAT_ENC_CSN_ID % 6 = 0")} AS CHECKOUT_DTTM,
          PAT_ENC_CSN_ID % 31 AS TIME_TO_ROOM_MINUTES, PAT_ENC_CSN_ID % 61 AS TIME_IN_ROOM_MINUTES,
          PAT_ENC_CSN_ID % 91 AS CYCLE_TIME_MINUTES
        FROM (SELECT o_orderkey AS PAT_ENC_CSN_ID, o_custkey, o_orderstatus, o_orderpriority,
                o_orderdate, {_visit_time("o_orderkey")} AS t FROM {{orders}}) x""",
    # A third of all visits on one patient-day, with many equal times.
    "BUSY_APPT": """
        SELECT o_orderkey AS PAT_ENC_CSN_ID,
          CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS PAT_ID,
          CASE WHEN o_orderkey % 3 = 0 THEN DATE '2024-01-01'
               ELSE CAST({TS} '2024-01-01 00:00:00' + (o_orderkey % 5) * INTERVAL '1' DAY AS DATE)
          END AS appt_date,
          {TS} '2024-01-01 07:00:00' + ((o_orderkey * 37) % 60) * INTERVAL '1' MINUTE AS APPT_DTTM,
          o_orderkey % 25 AS DEPARTMENT_ID, (o_orderkey * 7 + o_custkey) % 7 + 1 AS APPT_STATUS_C,
          15 * (1 + o_orderkey % 8) AS APPT_LENGTH
        FROM {orders}""",
    "PAT_ENC": """
        SELECT o_orderkey AS PAT_ENC_CSN_ID, 'Z' || CAST(o_custkey AS STRING) AS PAT_ID,
          'I' || CAST(o_orderkey AS STRING) AS INPATIENT_DATA_ID, o_orderkey % 25 AS DEPARTMENT_ID,
          CASE o_orderkey % 6 WHEN 0 THEN '1001' WHEN 1 THEN '50' WHEN 2 THEN '101' WHEN 3 THEN '70'
               WHEN 4 THEN '71' END AS ENC_TYPE_C,
          (o_orderkey * 7 + o_custkey) % 7 + 1 AS APPT_STATUS_C, o_orderkey % 10 AS VISIT_PROV_ID,
          CASE WHEN o_orderkey % 9 = 0 THEN 'Y' ELSE 'N' END AS INTERPRETER_NEED_YN,
          CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 4 END AS INTRP_ASSIGNMENT_C,
          CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 3 END AS ASGND_INTERP_TYPE_C,
          CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 2 END AS INTERPRETER_VEND_C
        FROM {orders}""",
    "V_PAT_ENC": """
        SELECT o_orderkey AS PAT_ENC_CSN_ID, 'Type ' || CAST(o_orderkey % 6 AS STRING)
          AS ENC_TYPE_TITLE FROM {orders}""",
    "PAT_ENC_APPT": """
        SELECT l_orderkey AS PAT_ENC_CSN_ID, CAST(l_linenumber AS BIGINT) AS LINE,
          CASE WHEN max(l_suppkey) % 10 = 9 THEN NULL ELSE max(l_suppkey) END AS PROV_ID
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "PAT_ENC_APPT_NOTES": """
        SELECT CAST((doc_id - doc_id % 4) / 4 AS BIGINT) AS PAT_ENC_CSN_ID, doc_id % 4 AS LINE,
          CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN '  ' ELSE text END
            AS APPT_NOTE
        FROM {documents}""",
    "PAT_ENC_RSN_VISIT": """
        SELECT l_orderkey AS PAT_ENC_CSN_ID, CAST(l_linenumber AS BIGINT) AS LINE,
          CASE WHEN max(l_partkey) % 11 = 0 THEN NULL ELSE max(l_partkey) END AS ENC_REASON_ID
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "CL_RSN_FOR_VISIT": """
        SELECT p_partkey AS REASON_VISIT_ID, p_name || ', ' || p_type
          || CASE WHEN p_size % 5 = 0 THEN ' & <' || p_brand || '>' ELSE '' END AS REASON_VISIT_NAME
        FROM {part}""",
    "REFERRAL": """
        SELECT c_custkey AS REFERRAL_ID,
          CAST({TS} '2023-12-01 00:00:00' + (c_custkey % 20) * INTERVAL '1' DAY AS DATE) AS ENTRY_DATE
        FROM {customer}""",
    "REFERRAL_HIST": """
        SELECT c_custkey AS REFERRAL_ID, CAST(c_nationkey % 2 + 1 AS BIGINT) AS CHANGE_TYPE_C,
          CAST({TS} '2023-12-05 00:00:00' + (c_custkey % 20) * INTERVAL '1' DAY AS DATE) AS CHANGE_DATE
        FROM {customer}""",
    "MAR_ADMIN_INFO": f"""
        SELECT MAR_ENC_CSN, ORDER_MED_ID, TAKEN_TIME, TAKEN_TIME - INTERVAL '5' MINUTE
            AS SCHEDULED_TIME,
          min(line) AS LINE, max(line) AS EDITED_LINE, max(action_c) AS MAR_ACTION_C,
          CASE WHEN min(line) % 3 = 0 THEN 1 WHEN min(line) % 7 = 0 THEN 2 END AS DUE_ACTION_C,
          min(line) % 4 AS REASON_C, max(quantity) AS INFUSION_RATE, max(line) * 10 AS MAR_DURATION,
          min(line) % 3 AS MAR_DURATION_UNIT_C, 'sig ' || CAST(max(line) AS STRING) AS SIG,
          min(line) % 5 AS DOSE_UNIT_C,
          CASE WHEN max(supplier) % 8 = 0 THEN NULL WHEN max(supplier) % 8 = 1 THEN 'X1'
               ELSE 'U' || CAST(max(supplier) AS STRING) END AS USER_ID,
          CASE WHEN min(line) % 2 = 0 THEN 'comment, ' || CAST(min(line) AS STRING) END AS COMMENTS
        FROM (SELECT l_orderkey AS MAR_ENC_CSN, {_ORDER_MED} AS ORDER_MED_ID,
                CAST(l_linenumber AS BIGINT) AS line, l_quantity AS quantity, l_suppkey AS supplier,
                {{TS}} '2024-01-01 07:00:00' + CAST(l_linenumber AS BIGINT) * INTERVAL '1' HOUR
                  + (l_partkey % 60) * INTERVAL '1' MINUTE AS TAKEN_TIME,
                CASE WHEN l_returnflag = 'A' THEN 6
                     WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 120
                     WHEN l_returnflag = 'R' THEN 8
                     WHEN l_linestatus = 'F' THEN 99 ELSE 100 END AS action_c
              FROM {{lineitem}}) x
        GROUP BY MAR_ENC_CSN, ORDER_MED_ID, TAKEN_TIME""",
    "ORDER_MED": f"""
        SELECT {_ORDER_MED} AS ORDER_MED_ID, max(l_partkey) AS MEDICATION_ID
        FROM {{lineitem}} GROUP BY {_ORDER_MED}""",
    "ORDER_MEDINFO": f"""
        SELECT {_ORDER_MED} AS ORDER_MED_ID,
          CASE WHEN max(l_suppkey) % 4 = 0 THEN 2 ELSE 1 END AS MAR_ADMIN_TYPE_C,
          max(l_suppkey) % 3 AS INFUSION_TYPE_C
        FROM {{lineitem}} GROUP BY {_ORDER_MED}""",
    "CLARITY_MEDICATION": """
        SELECT p_partkey AS MEDICATION_ID, p_name || ' ' || p_brand AS NAME FROM {part}""",
    "V_ONC_TREATMENT_PLAN_ORDERS": f"""
        SELECT CASE WHEN o.part % 5 = 0 THEN NULL ELSE o.ORDER_MED_ID END AS ORDER_ID,
          o.plan AS TREATMENT_PLAN_ID, p_name || ' & ' || p_type AS PLAN_NAME, o.prov AS PLAN_PROV_ID
        FROM (SELECT {_ORDER_MED} AS ORDER_MED_ID, max(l_partkey) AS part,
                max(l_partkey) % 40 AS plan, max(l_suppkey) % 12 AS prov
              FROM {{lineitem}} GROUP BY {_ORDER_MED}) o JOIN {{part}} ON p_partkey = o.plan""",
    "IP_FLWSHT_REC": """
        SELECT o_orderkey AS FSD_ID, 'I' || CAST(o_orderkey AS STRING) AS INPATIENT_DATA_ID,
          'Z' || CAST(o_custkey AS STRING) AS PAT_ID FROM {orders}""",
    "IP_FLWSHT_MEAS": f"""
        SELECT {_EVENT_CSN} AS FSD_ID, event_id AS MEAS_ID, ts AS RECORDED_TIME,
          CASE event_type WHEN 'view' THEN '4143' WHEN 'click' THEN '4147'
            WHEN 'purchase' THEN '2103800002' WHEN 'signup' THEN '3506' ELSE '9' END AS FLO_MEAS_ID,
          CASE event_type
            WHEN 'view' THEN CASE WHEN event_id % 11 = 0 THEN NULL
                                  ELSE 'Room <' || CAST(event_id % 9 AS STRING) || '>' END
            WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'B - Intake' WHEN 1 THEN 'G- Checked Out'
                                                ELSE 'C - Exam' END
            WHEN 'purchase' THEN CASE WHEN event_id % 4 = 0 THEN 'No' ELSE 'Yes' END
            WHEN 'signup' THEN 'Yes' ELSE 'n/a' END AS MEAS_VALUE,
          CASE event_type
            WHEN 'purchase' THEN CASE WHEN event_id % 6 = 0 THEN '7' ELSE '2103800001' END
            WHEN 'signup' THEN '2100000001'
            WHEN 'error' THEN CASE event_id % 4 WHEN 0 THEN '1150000005' WHEN 1 THEN '2100300004'
                                                WHEN 2 THEN '31010' ELSE '31000' END
            ELSE '5' END AS FLT_ID
        FROM {{events}}""",
    "IP_FLO_GP_DATA": "SELECT DISTINCT FLO_MEAS_ID FROM {IP_FLWSHT_MEAS}",
    "IP_FLT_DATA": """
        SELECT DISTINCT FLT_ID AS TEMPLATE_ID, 'Template ' || FLT_ID AS TEMPLATE_NAME
        FROM {IP_FLWSHT_MEAS}""",
    "HSP_INFECTION_PL": """
        SELECT 'Z' || CAST(user_id AS STRING) AS PAT_ID, event_type AS INFECTION_C, event_id AS LINE,
          CASE WHEN event_id % 19 = 0 THEN NULL ELSE ts END AS INF_ADD_PL_TIME,
          CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL '1' DAY END AS INF_RSV_PL_TIME
        FROM {events}""",
    "ZC_INFECTION": """
        SELECT DISTINCT event_type AS INFECTION_C, event_type || ', watch' AS NAME FROM {events}""",
    "SMRTDTA_ELEM_DATA": """
        SELECT DISTINCT conv_id AS HLV_ID,
          CASE WHEN conv_id % 5 = 1 THEN 'OTHER#1' ELSE 'FLOW#1' END AS ELEMENT_ID,
          CASE WHEN conv_id % 7 = 1 THEN 'PATIENT' ELSE 'ENCOUNTER' END AS CONTEXT_NAME,
          conv_id * 3 AS CONTACT_SERIAL_NUM
        FROM {conversations}""",
    "SMRTDTA_ELEM_VALUE": """
        SELECT conv_id AS HLV_ID, turn AS LINE,
          CASE WHEN (conv_id + turn) % 9 = 0 THEN ' ' ELSE text END AS SMRTDTA_ELEM_VALUE
        FROM {conversations}""",
    "ED_IEV_PAT_INFO": f"""
        SELECT event_id AS EVENT_ID, {_EVENT_CSN} AS PAT_ENC_CSN_ID,
          'Z' || CAST(user_id AS STRING) AS PAT_ID,
          CASE event_id % 3 WHEN 0 THEN '604' WHEN 1 THEN '57043' ELSE '999' END AS TYPE_ID,
          event_id % 25 AS DEPT_EVENT_DEP_ID
        FROM {{events}}""",
    "ED_IEV_EVENT_INFO": f"""
        SELECT event_id AS EVENT_ID, event_id % 3 + 1 AS LINE,
          CASE event_type WHEN 'view' THEN '1400000222' WHEN 'click' THEN '604'
            WHEN 'purchase' THEN '2104200001' WHEN 'signup' THEN '57043' ELSE '999' END AS EVENT_TYPE,
          event_type AS EVENT_DISPLAY_NAME,
          CASE WHEN event_id % 4 = 0 THEN {_visit_time(_EVENT_CSN)} ELSE ts END AS EVENT_TIME,
          props AS EVENT_CMT, event_id % 25 AS EVENT_DEPT_ID, 'K' || CAST(event_id AS STRING)
            AS EVENT_KEY,
          event_id AS EVENT_NOTE_ID, event_id % 10 AS EVENT_PROV_ID, event_id % 30 AS LOCATION_ID
        FROM {{events}}""",
    "ED_EVENT_TMPL_INFO": """
        SELECT DISTINCT EVENT_TYPE AS RECORD_ID,
          CASE WHEN EVENT_DISPLAY_NAME = 'click' THEN 'WAITING ROOM' ELSE upper(EVENT_DISPLAY_NAME)
          END AS RECORD_NAME, 'Event ' || EVENT_DISPLAY_NAME AS EVENT_NAME
        FROM {ED_IEV_EVENT_INFO}""",
    "ED_LEV_EVENT_INFO": """
        SELECT DISTINCT EVENT_TYPE AS RECORD_ID,
          CASE EVENT_TYPE WHEN '604' THEN '30' WHEN '57043' THEN '56009' WHEN '999' THEN '30' END
            AS EVT_TMPLT_CLASS_C
        FROM {ED_IEV_EVENT_INFO}""",
    "ZC_EVT_TMPLT_CLASS": """
        SELECT DISTINCT EVT_TMPLT_CLASS_C, 'Class ' || EVT_TMPLT_CLASS_C AS NAME
        FROM {ED_LEV_EVENT_INFO}""",
    "HNO_NOTE_TEXT": """
        SELECT doc_id - doc_id % 2 AS NOTE_ID, doc_id % 2 AS LINE, text AS NOTE_TEXT
        FROM {documents}""",
    "CL_PLC": """
        SELECT CAST(n_nationkey AS BIGINT) AS LOCATION_EVNT_ID, n_name AS COMMENTS FROM {nation}""",
    "CLARITY_DEP": """
        SELECT CAST(n_nationkey AS BIGINT) AS DEPARTMENT_ID, n_name AS DEPARTMENT_NAME
        FROM {nation}""",
    "CLARITY_SER": """
        SELECT s_suppkey AS PROV_ID,
          s_name || CASE WHEN s_nationkey % 2 = 0 THEN ', MD & Co' ELSE '' END AS PROV_NAME
        FROM {supplier}""",
    "CLARITY_EMP": """
        SELECT 'U' || CAST(s_suppkey AS STRING) AS USER_ID,
          CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_name END AS NAME FROM {supplier}""",
    "ZC_MAR_RSLT": """
        SELECT CASE n_nationkey WHEN 0 THEN 6 WHEN 1 THEN 8 WHEN 2 THEN 99 WHEN 3 THEN 120
            WHEN 4 THEN 100 ELSE 1000 + n_nationkey END AS RESULT_C,
          CASE n_nationkey WHEN 0 THEN 'New Bag' WHEN 1 THEN 'Taken' WHEN 2 THEN 'Missed'
            WHEN 3 THEN 'Completed' ELSE n_name END AS NAME
        FROM {nation}""",
    "V_AVAILABILITY": f"""
        SELECT l_orderkey AS PAT_ENC_CSN_ID, CAST(l_linenumber AS BIGINT) - 1 AS APPT_NUMBER,
          CAST({_visit_time("l_orderkey")} + (l_partkey % 3) * INTERVAL '1' DAY AS DATE) AS SLOT_DATE
        FROM {{lineitem}}""",
}


def _codes(table: str, code: str, label: str, as_text: bool = False) -> None:
    kind = "STRING" if as_text else "BIGINT"
    VIEWS[table] = (
        f"SELECT CAST(n_nationkey AS {kind}) AS {code},"
        f" '{label} ' || CAST(n_nationkey AS STRING) AS NAME FROM {{nation}}"
    )


_codes("ZC_MED_DURATION_UN", "MED_DURATION_UN_C", "Unit")
_codes("ZC_MED_UNIT", "DISP_QTYUNIT_C", "Dose unit")
_codes("ZC_MAR_RSN", "REASON_C", "Reason")
_codes("ZC_INFUSION_TYPE", "INFUSION_TYPE_C", "Infusion")
_codes("ZC_MAR_ADMIN_TYPE", "MAR_ADMIN_TYPE_C", "Admin")
_codes("ZC_APPT_STATUS", "APPT_STATUS_C", "Status")
_codes("ZC_LANGUAGE", "LANGUAGE_C", "Language")
_codes("ZC_INTRP_ASSIGNMEN", "INTRP_ASSIGNMEN_C", "Assignment")
_codes("ZC_ASGND_INTERP_TY", "ASGND_INTERP_TY_C", "Interpreter")
_codes("ZC_INTERPRETER_VEN", "INTERPRETER_VEN_C", "Vendor")
VIEWS["ZC_DISP_ENC_TYPE"] = """
    SELECT DISTINCT ENC_TYPE_C AS DISP_ENC_TYPE_C, 'Encounter ' || ENC_TYPE_C AS NAME
    FROM {PAT_ENC}"""


def _references(sql: str) -> list[str]:
    return [f for _, f, _, _ in Formatter().parse(sql) if f and f != "TS"]


class TestWarehouse(Warehouse):
    """The raw test tables and every derived source table, by name."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, folder=sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames and name in VIEWS:
            sql = VIEWS[name].replace("{TS}", "TIMESTAMP_NTZ")
            used = {table: self[table] for table in _references(sql)}
            self._frames[name] = self.spark.sql(sql, **used)
        return super().__getitem__(name)


def oracle(sql: str) -> str:
    """A DuckDB query with the derived tables it mentions in front."""
    needed: dict[str, str] = {}

    def need(name: str) -> None:
        if name in needed or name not in VIEWS:
            return
        for used in _references(VIEWS[name]):
            need(used)
        used = {t: t for t in _references(VIEWS[name])}
        needed[name] = VIEWS[name].format(TS="TIMESTAMP", **used)

    for word in dict.fromkeys(re.findall(r"[A-Z][A-Z0-9_]+", sql)):
        need(word)
    parts = [f"{name} AS ({body})" for name, body in needed.items()]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
