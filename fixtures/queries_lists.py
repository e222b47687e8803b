"""List, text and label queries."""

from pyspark.sql import functions as F

from fixtures.registry import LOAD_TS, query
from fixtures.sql import CSN, escaped, line_list, minute, pseudonym, second, stamp
from visitflow.functions import labels
from visitflow.functions import text as tx
from visitflow.functions.stamps import (
    minutes_between,
    round_to_minute,
    round_to_second,
    stamp_text,
)
from visitflow.operators.lists import (
    attach_lines,
    enumerate_distinct,
    enumerate_lines,
    measure_history,
)
from visitflow.sources.load import with_audit


@query("list_lines", line_list("PAT_ENC_APPT_NOTES", CSN, "LINE", "APPT_NOTE", "items"))
def _(wh):
    return enumerate_lines(
        wh["PAT_ENC_APPT_NOTES"], [CSN], "LINE", "APPT_NOTE", "items"
    )


@query(
    "list_lines_of_turns",
    line_list("conversations", "conv_id", "turn", "text", "items", trailing=False),
)
def _(wh):
    return enumerate_lines(
        wh["conversations"], ["conv_id"], "turn", "text", "items", trailing=False,
        unique_lines=True,
    )


# A third of all lines on one parent.
@query(
    "list_lines_busy_parent",
    f"""SELECT parent, string_agg({escaped("coalesce(text, '')")}, '|' ORDER BY doc_id) || '|' AS items
        FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id END AS parent, doc_id, text
              FROM documents) x GROUP BY parent""",
)
def _(wh):
    parent = F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id"))
    docs = wh["documents"].withColumn("parent", parent)
    return enumerate_lines(docs, ["parent"], "doc_id", "text", "items", unique_lines=True, huge=True)


@query(
    "list_lines_leading",
    f"""SELECT {CSN}, string_agg({escaped("APPT_NOTE")}, '|' ORDER BY LINE) AS items
        FROM PAT_ENC_APPT_NOTES GROUP BY {CSN}""",
)
def _(wh):
    return enumerate_lines(
        wh["PAT_ENC_APPT_NOTES"], [CSN], "LINE", "APPT_NOTE", "items", trailing=False,
        nulls="skip",
    )


@query(
    "list_lines_raw",
    line_list("PAT_ENC_APPT_NOTES", CSN, "LINE", "APPT_NOTE", "items", raw=True),
)
def _(wh):
    return enumerate_lines(
        wh["PAT_ENC_APPT_NOTES"], [CSN], "LINE", "APPT_NOTE", "items", escape=False
    )


@query(
    "list_distinct",
    """SELECT l_orderkey, string_agg(p_name || '|', '' ORDER BY p_size, p_name) AS items
       FROM (SELECT DISTINCT l_orderkey, p_size, p_name
             FROM lineitem JOIN part ON p_partkey = l_partkey) x GROUP BY l_orderkey""",
)
def _(wh):
    rows = wh["lineitem"].join(wh["part"], F.col("l_partkey") == F.col("p_partkey"))
    return enumerate_distinct(
        rows, ["l_orderkey"], ["p_size"], "p_name", "items", escape=False
    )


def _history_list(measure: str, item: str, name: str) -> str:
    return (
        f"string_agg({item}, '|' ORDER BY RECORDED_TIME)"
        f" FILTER (WHERE FLO_MEAS_ID = '{measure}') AS {name}"
    )


@query(
    "parallel_lists",
    f"""SELECT FSD_ID, {_history_list("4143", escaped("v"), "rooms")},
          {_history_list("4143", "strftime(RECORDED_TIME, '%Y-%m-%d %H:%M')", "room_times")},
          {_history_list("4147", escaped("v"), "tracks")},
          {_history_list("4147", "strftime(RECORDED_TIME, '%Y-%m-%d %H:%M')", "track_times")}
        FROM (SELECT FSD_ID, FLO_MEAS_ID, RECORDED_TIME, max(coalesce(MEAS_VALUE, 'NA')) AS v
              FROM IP_FLWSHT_MEAS GROUP BY FSD_ID, FLO_MEAS_ID, RECORDED_TIME) x
        GROUP BY FSD_ID""",
)
def _(wh):
    names = {"4143": ("rooms", "room_times"), "4147": ("tracks", "track_times")}
    return measure_history(
        wh["IP_FLWSHT_MEAS"], ["FSD_ID"], "RECORDED_TIME", "MEAS_VALUE", "FLO_MEAS_ID", names
    )


@query(
    "lines_with_lookup",
    f"""SELECT v.{CSN}, LINE, PROV_NAME FROM V_SCHED_APPT v
        LEFT JOIN (SELECT {CSN}, LINE, PROV_NAME FROM PAT_ENC_APPT
                   LEFT JOIN CLARITY_SER ON CLARITY_SER.PROV_ID = PAT_ENC_APPT.PROV_ID) x
          ON x.{CSN} = v.{CSN}""",
)
def _(wh):
    return attach_lines(
        wh["V_SCHED_APPT"], wh["PAT_ENC_APPT"], CSN, wh["CLARITY_SER"], "PROV_ID"
    ).select(CSN, "LINE", "PROV_NAME")


@query(
    "pseudonym",
    f"SELECT PAT_ID, {pseudonym('PAT_MRN_ID', 10)} AS hashed, PAT_MRN_ID AS plain FROM PATIENT",
)
def _(wh):
    return wh["PATIENT"].select(
        "PAT_ID", tx.pseudonym("PAT_MRN_ID", 10).alias("hashed"), F.col("PAT_MRN_ID").alias("plain")
    )


@query(
    "status_label",
    f"""SELECT {CSN}, CASE APPT_STATUS_C WHEN 1 THEN 'sch' WHEN 2 THEN 'comp' WHEN 3 THEN 'canc'
          WHEN 4 THEN 'no show' WHEN 5 THEN 'left' WHEN 6 THEN 'arrived' END AS label
        FROM V_SCHED_APPT""",
)
def _(wh):
    return wh["V_SCHED_APPT"].select(CSN, labels.status_label("APPT_STATUS_C").alias("label"))


@query(
    "face_to_face",
    f"""SELECT {CSN}, CASE WHEN ENC_TYPE_C IN ('1001', '50', '213', '2103500001', '3', '108', '1201',
          '101', '2100700001', '1003', '1200') THEN 1 ELSE 0 END AS flag FROM PAT_ENC""",
)
def _(wh):
    return wh["PAT_ENC"].select(CSN, labels.face_to_face("ENC_TYPE_C").alias("flag"))


@query(
    "sanitize_list",
    """SELECT doc_id, CASE WHEN length(rtrim(t)) = 0 THEN '' ELSE
          left(replace(left(left(t, length(rtrim(t)) - 1), 1200), ',', '^'), 1200) END AS clean,
          left(replace(t, ',', '^'), 1200) AS whole
        FROM (SELECT doc_id, text || '|' AS t FROM documents) x""",
)
def _(wh):
    text = F.concat("text", F.lit("|"))
    return wh["documents"].select(
        "doc_id",
        tx.sanitize_list(text, 1200).alias("clean"),
        tx.sanitize_list(text, 1200, strip_last=False).alias("whole"),
    )


@query(
    "quote_list",
    f"""SELECT {CSN}, LINE, coalesce(left('"' || rtrim(APPT_NOTE) || '"', 1000), '|') AS quoted
        FROM PAT_ENC_APPT_NOTES""",
)
def _(wh):
    return wh["PAT_ENC_APPT_NOTES"].select(
        CSN, "LINE", tx.quote_list("APPT_NOTE", 1000).alias("quoted")
    )


@query(
    "clip_list",
    f"""SELECT {CSN}, LINE, coalesce(left(rtrim(APPT_NOTE), 200), '|') AS clipped
        FROM PAT_ENC_APPT_NOTES""",
)
def _(wh):
    return wh["PAT_ENC_APPT_NOTES"].select(
        CSN, "LINE", tx.clip_list("APPT_NOTE", 200).alias("clipped")
    )


@query(
    "non_empty_lines",
    f"SELECT {CSN}, LINE FROM PAT_ENC_APPT_NOTES WHERE length(rtrim(APPT_NOTE)) > 0",
)
def _(wh):
    return wh["PAT_ENC_APPT_NOTES"].filter(tx.non_empty("APPT_NOTE")).select(CSN, "LINE")


@query(
    "stamp_text",
    f"""SELECT event_id, {stamp("ts")} AS full_text,
          coalesce(strftime(ts, '%Y-%m-%d %H:%M'), '') AS minute_text,
          coalesce(strftime(ts, '%m/%d/%Y'), '') AS us_date,
          coalesce(strftime(ts, '%H:%M:%S'), '') AS clock, {stamp(second("ts"))} AS rounded
        FROM events""",
)
def _(wh):
    return wh["events"].select(
        "event_id",
        stamp_text("ts").alias("full_text"),
        stamp_text("ts", "minute").alias("minute_text"),
        stamp_text("ts", "us_date").alias("us_date"),
        stamp_text("ts", "clock").alias("clock"),
        stamp_text(round_to_second("ts")).alias("rounded"),
    )


@query(
    "minute_rounding",
    f"""SELECT event_id, {minute("ts")} AS to_minute, {second("ts")} AS to_second,
          CAST(date_diff('minute', ts, ts + (event_id % 500) * INTERVAL '1' SECOND) AS INTEGER)
            AS boundaries
        FROM events""",
)
def _(wh):
    later = F.expr("ts + (event_id % 500) * INTERVAL '1' SECOND")
    return wh["events"].select(
        "event_id",
        round_to_minute("ts").alias("to_minute"),
        round_to_second("ts").alias("to_second"),
        minutes_between("ts", later).alias("boundaries"),
    )


@query(
    "audit_columns",
    f"""SELECT {CSN}, 'infusion_daily' AS "ETL_guid",
          TIMESTAMP '2024-01-02 06:30:40' AS "Load_Dte" FROM V_SCHED_APPT""",
)
def _(wh):
    return with_audit(wh["V_SCHED_APPT"].select(CSN), "infusion_daily", LOAD_TS)


@query(
    "projection",
    f"""SELECT {CSN} AS "Appointment ID", '' AS "COMM_TYPE", left(PRC_NAME, 5) AS "Visit Type",
          'tag' AS source FROM V_SCHED_APPT""",
)
def _(wh):
    return wh["V_SCHED_APPT"].select(
        F.col(CSN).alias("Appointment ID"),
        F.lit("").alias("COMM_TYPE"),
        tx.clip("PRC_NAME", 5).alias("Visit Type"),
        F.lit("tag").alias("source"),
    )
