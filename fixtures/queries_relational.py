"""Filters, joins, aggregations, windows, set and scalar forms the source queries use."""

from datetime import date

from pyspark.sql import functions as F

from fixtures.registry import query
from fixtures.sql import CSN
from visitflow.functions.stamps import minutes_between
from visitflow.functions.text import clip
from visitflow.operators.checks import duplicate_keys
from visitflow.operators.cohort import left_to_many, rows_of
from visitflow.operators.milestones import milestone_pivot
from visitflow.operators.ordered import following, previous, with_neighbours
from visitflow.plans.outpatient import referral_dates


def appt(wh):
    return wh["V_SCHED_APPT"]


# --- Filters --------------------------------------------------------------------------------------


@query(
    "filter_in_lists",
    f"""SELECT {CSN}, APPT_STATUS_C, PRC_NAME FROM V_SCHED_APPT
        WHERE APPT_STATUS_C IN (1, 2, 6) AND PRC_NAME IN ('1-URGENT', '2-HIGH')""",
)
def _(wh):
    rule = F.col("APPT_STATUS_C").isin(1, 2, 6) & F.col("PRC_NAME").isin("1-URGENT", "2-HIGH")
    return appt(wh).filter(rule).select(CSN, "APPT_STATUS_C", "PRC_NAME")


@query(
    "filter_closed_range",
    f"""SELECT {CSN}, APPT_DTTM FROM V_SCHED_APPT
        WHERE APPT_DTTM BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-04'
          AND APPT_LENGTH >= 30 AND APPT_LENGTH <= 90""",
)
def _(wh):
    times = F.col("APPT_DTTM").between(
        F.lit("2024-01-02").cast("timestamp_ntz"), F.lit("2024-01-04").cast("timestamp_ntz")
    )
    return appt(wh).filter(times & F.col("APPT_LENGTH").between(30, 90)).select(CSN, "APPT_DTTM")


@query(
    "filter_not_equal",
    f"SELECT {CSN}, CANCEL_REASON_NAME FROM V_SCHED_APPT WHERE CANCEL_REASON_NAME <> 'Reason F'",
)
def _(wh):
    return (
        appt(wh)
        .filter(F.col("CANCEL_REASON_NAME") != "Reason F")
        .select(CSN, "CANCEL_REASON_NAME")
    )


@query(
    "filter_date_floor",
    f"""SELECT {CSN}, CONTACT_DATE FROM V_SCHED_APPT
        WHERE CONTACT_DATE >= DATE '2024-01-03' AND APPT_STATUS_C = 2""",
)
def _(wh):
    rule = (F.col("CONTACT_DATE") >= F.lit(date(2024, 1, 3))) & (F.col("APPT_STATUS_C") == 2)
    return appt(wh).filter(rule).select(CSN, "CONTACT_DATE")


@query(
    "filter_and_or",
    """SELECT MEAS_ID FROM IP_FLWSHT_MEAS
       WHERE (FLO_MEAS_ID IN ('2103800002', '2103800003') AND MEAS_VALUE = 'Yes')
         OR FLT_ID = '1150000005' """,
)
def _(wh):
    answered = F.col("FLO_MEAS_ID").isin("2103800002", "2103800003")
    rule = (answered & (F.col("MEAS_VALUE") == "Yes")) | (F.col("FLT_ID") == "1150000005")
    return wh["IP_FLWSHT_MEAS"].filter(rule).select("MEAS_ID")


@query(
    "filter_nulls",
    """SELECT PAT_ID, LINE FROM HSP_INFECTION_PL
       WHERE INF_ADD_PL_TIME IS NOT NULL AND INF_RSV_PL_TIME IS NULL""",
)
def _(wh):
    rule = F.col("INF_ADD_PL_TIME").isNotNull() & F.col("INF_RSV_PL_TIME").isNull()
    return wh["HSP_INFECTION_PL"].filter(rule).select("PAT_ID", "LINE")


@query(
    "filter_like",
    """SELECT doc_id FROM documents WHERE text LIKE 'The%' OR text LIKE '%data%' """,
)
def _(wh):
    rule = F.col("text").like("The%") | F.col("text").like("%data%")
    return wh["documents"].filter(rule).select("doc_id")


@query(
    "filter_in_subquery",
    f"""SELECT {CSN}, LINE FROM PAT_ENC_APPT WHERE {CSN} IN (
          SELECT DISTINCT {CSN} FROM V_SCHED_APPT WHERE APPT_STATUS_C = 2)""",
)
def _(wh):
    done = appt(wh).filter(F.col("APPT_STATUS_C") == 2)
    return rows_of(wh["PAT_ENC_APPT"], done, CSN).select(CSN, "LINE")


@query(
    "filter_column_compare",
    f"""SELECT {CSN} FROM F_SCHED_APPT WHERE VISIT_END_DTTM >= CHECKIN_DTTM
          AND (CHECKOUT_DTTM IS NULL OR VISIT_END_DTTM <= CHECKOUT_DTTM)""",
)
def _(wh):
    rule = (F.col("VISIT_END_DTTM") >= F.col("CHECKIN_DTTM")) & (
        F.col("CHECKOUT_DTTM").isNull() | (F.col("VISIT_END_DTTM") <= F.col("CHECKOUT_DTTM"))
    )
    return wh["F_SCHED_APPT"].filter(rule).select(CSN)


@query(
    "filter_text_against_number",
    f"SELECT {CSN} FROM V_SCHED_APPT WHERE DEPARTMENT_ID = CAST('7' AS BIGINT)",
)
def _(wh):
    return appt(wh).filter(F.col("DEPARTMENT_ID") == F.lit("7").cast("long")).select(CSN)


@query(
    "searched_case",
    f"""SELECT {CSN}, CASE WHEN APPT_LENGTH < 30 THEN 'short' WHEN APPT_LENGTH < 90 THEN 'medium'
          ELSE 'long' END AS kind FROM V_SCHED_APPT""",
)
def _(wh):
    length = F.col("APPT_LENGTH")
    kind = F.when(length < 30, "short").when(length < 90, "medium").otherwise("long")
    return appt(wh).select(CSN, kind.alias("kind"))


# --- Joins ----------------------------------------------------------------------------------------


@query(
    "join_inner",
    """SELECT MEAS_ID, INPATIENT_DATA_ID FROM IP_FLWSHT_REC r
       JOIN IP_FLWSHT_MEAS m ON m.FSD_ID = r.FSD_ID""",
)
def _(wh):
    return wh["IP_FLWSHT_REC"].join(wh["IP_FLWSHT_MEAS"], "FSD_ID").select(
        "MEAS_ID", "INPATIENT_DATA_ID"
    )


@query(
    "join_expression_key",
    f"""SELECT a.{CSN}, e.day FROM V_SCHED_APPT a JOIN (
          SELECT DISTINCT 'Z' || CAST(user_id AS VARCHAR) AS PAT_ID, CAST(ts AS DATE) AS day
          FROM events) e ON a.PAT_ID = e.PAT_ID AND CAST(a.APPT_DTTM AS DATE) = e.day""",
)
def _(wh):
    active_days = (
        wh["events"]
        .select(
            F.concat(F.lit("Z"), F.col("user_id").cast("string")).alias("PAT_ID"),
            F.to_date("ts").alias("day"),
        )
        .distinct()
    )
    dated = appt(wh).withColumn("day", F.to_date("APPT_DTTM"))
    return dated.join(active_days, ["PAT_ID", "day"]).select(CSN, "day")


@query(
    "join_left_lookup",
    f"""SELECT {CSN}, PROV_NAME FROM PAT_ENC_APPT a
        LEFT JOIN CLARITY_SER s ON s.PROV_ID = a.PROV_ID""",
)
def _(wh):
    return wh["PAT_ENC_APPT"].join(wh["CLARITY_SER"], "PROV_ID", "left").select(CSN, "PROV_NAME")


@query(
    "join_left_aggregate",
    f"""SELECT a.{CSN}, n_lines, last_line FROM V_SCHED_APPT a LEFT JOIN (
          SELECT {CSN}, count(*) AS n_lines, max(LINE) AS last_line FROM PAT_ENC_APPT
          GROUP BY {CSN}) x ON x.{CSN} = a.{CSN}""",
)
def _(wh):
    lines = wh["PAT_ENC_APPT"].groupBy(CSN).agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("LINE").alias("last_line")
    )
    return appt(wh).select(CSN).join(lines, CSN, "left")


@query(
    "join_left_filtered",
    """SELECT r.REFERRAL_ID, ENTRY_DATE, CHANGE_DATE FROM REFERRAL r LEFT JOIN (
         SELECT * FROM REFERRAL_HIST WHERE CHANGE_TYPE_C = 1) h ON h.REFERRAL_ID = r.REFERRAL_ID""",
)
def _(wh):
    return referral_dates(wh)


@query(
    "join_two_roles",
    """SELECT s_suppkey, home.n_name AS home, next_to.n_name AS next_to FROM supplier
       LEFT JOIN nation home ON home.n_nationkey = s_nationkey
       LEFT JOIN nation next_to ON next_to.n_nationkey = s_nationkey + 1""",
)
def _(wh):
    nation = wh["nation"]
    home = nation.select(F.col("n_nationkey").alias("home_key"), F.col("n_name").alias("home"))
    near = nation.select(F.col("n_nationkey").alias("near_key"), F.col("n_name").alias("next_to"))
    return (
        wh["supplier"]
        .join(home, F.col("s_nationkey") == F.col("home_key"), "left")
        .join(near, F.col("s_nationkey") + 1 == F.col("near_key"), "left")
        .select("s_suppkey", "home", "next_to")
    )


@query(
    "join_semi",
    f"""SELECT p.EVENT_ID FROM ED_IEV_PAT_INFO p JOIN (SELECT DISTINCT {CSN} FROM V_SCHED_APPT
          WHERE APPT_STATUS_C = 2) c ON c.{CSN} = p.{CSN}""",
)
def _(wh):
    done = appt(wh).filter(F.col("APPT_STATUS_C") == 2)
    return rows_of(wh["ED_IEV_PAT_INFO"], done, CSN).select("EVENT_ID")


@query(
    "join_full",
    """SELECT coalesce(c.PAT_ID, u.PAT_ID) AS PAT_ID, PAT_MRN_ID, n_events FROM PATIENT c
       FULL OUTER JOIN (SELECT PAT_ID, count(*) AS n_events FROM ED_IEV_PAT_INFO GROUP BY PAT_ID) u
       ON u.PAT_ID = c.PAT_ID""",
)
def _(wh):
    counted = wh["ED_IEV_PAT_INFO"].groupBy("PAT_ID").agg(F.count(F.lit(1)).alias("n_events"))
    return wh["PATIENT"].join(counted, "PAT_ID", "full_outer").select(
        "PAT_ID", "PAT_MRN_ID", "n_events"
    )


@query(
    "join_one_to_many",
    f"""SELECT a.{CSN}, n.LINE FROM V_SCHED_APPT a
        LEFT JOIN PAT_ENC_APPT_NOTES n ON n.{CSN} = a.{CSN}""",
)
def _(wh):
    notes = wh["PAT_ENC_APPT_NOTES"].select(CSN, "LINE")
    return left_to_many(appt(wh).select(CSN), notes, CSN)


# --- Aggregation, windows, sets -------------------------------------------------------------------


@query(
    "group_min_max",
    """SELECT MAR_ENC_CSN, min(TAKEN_TIME) AS first_time, max(TAKEN_TIME) AS last_time
       FROM MAR_ADMIN_INFO GROUP BY MAR_ENC_CSN""",
)
def _(wh):
    return wh["MAR_ADMIN_INFO"].groupBy("MAR_ENC_CSN").agg(
        F.min("TAKEN_TIME").alias("first_time"), F.max("TAKEN_TIME").alias("last_time")
    )


@query(
    "group_count_distinct",
    """SELECT FSD_ID, count(DISTINCT MEAS_VALUE) AS n_values FROM IP_FLWSHT_MEAS GROUP BY FSD_ID""",
)
def _(wh):
    return wh["IP_FLWSHT_MEAS"].groupBy("FSD_ID").agg(
        F.count_distinct("MEAS_VALUE").alias("n_values")
    )


@query("distinct_rows", "SELECT DISTINCT PAT_ID, CONTACT_DATE FROM V_SCHED_APPT")
def _(wh):
    return appt(wh).select("PAT_ID", "CONTACT_DATE").distinct()


@query("group_without_aggregate", "SELECT FSD_ID, FLO_MEAS_ID FROM IP_FLWSHT_MEAS GROUP BY ALL")
def _(wh):
    return wh["IP_FLWSHT_MEAS"].select("FSD_ID", "FLO_MEAS_ID").dropDuplicates()


@query(
    "max_text_per_line",
    "SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag FROM lineitem GROUP BY ALL",
)
def _(wh):
    return wh["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))


@query(
    "pivot_latest",
    """SELECT user_id, max(ts) FILTER (WHERE event_type = 'view') AS "view",
         max(ts) FILTER (WHERE event_type = 'click') AS click FROM events GROUP BY user_id""",
)
def _(wh):
    wanted = {"view": ("view", "last"), "click": ("click", "last")}
    return milestone_pivot(wh["events"], ["user_id"], "event_type", "ts", wanted)


@query(
    "lag_and_lead",
    f"""SELECT {CSN}, lag(APPT_STATUS_C) OVER w AS before, lead(APPT_STATUS_C) OVER w AS after
        FROM V_SCHED_APPT WINDOW w AS (PARTITION BY PAT_ID, CONTACT_DATE ORDER BY APPT_DTTM, {CSN})""",
)
def _(wh):
    wanted = {"before": previous(F.col("APPT_STATUS_C")), "after": following(F.col("APPT_STATUS_C"))}
    return with_neighbours(
        appt(wh), ["PAT_ID", "CONTACT_DATE"], ["APPT_DTTM", CSN], wanted
    ).select(CSN, *wanted)


@query("sort_rows", f"SELECT {CSN}, APPT_DTTM FROM V_SCHED_APPT ORDER BY APPT_DTTM, {CSN}")
def _(wh):
    return appt(wh).select(CSN, "APPT_DTTM").orderBy("APPT_DTTM", CSN)


@query(
    "top_rows",
    f"""SELECT {CSN} FROM V_SCHED_APPT WHERE CONTACT_DATE BETWEEN DATE '2024-01-02'
          AND DATE '2024-01-03' ORDER BY {CSN} LIMIT 100""",
)
def _(wh):
    days = F.col("CONTACT_DATE").between(F.lit(date(2024, 1, 2)), F.lit(date(2024, 1, 3)))
    return appt(wh).filter(days).select(CSN).orderBy(CSN).limit(100)


@query(
    "union_all",
    f"""SELECT {CSN}, CHECKIN_DTTM AS t FROM F_SCHED_APPT
        UNION ALL SELECT {CSN}, CHECKOUT_DTTM FROM F_SCHED_APPT""",
)
def _(wh):
    stamps = wh["F_SCHED_APPT"]
    return stamps.select(CSN, F.col("CHECKIN_DTTM").alias("t")).unionByName(
        stamps.select(CSN, F.col("CHECKOUT_DTTM").alias("t"))
    )


@query(
    "least_of_values",
    f"""SELECT {CSN}, (SELECT min(v) FROM (VALUES (ROOMED_DTTM), (FIRST_ROOM_ASSIGN_DTTM),
          (ARVL_LIST_REMOVE_DTTM)) x(v)) AS earliest FROM F_SCHED_APPT""",
)
def _(wh):
    earliest = F.least("ROOMED_DTTM", "FIRST_ROOM_ASSIGN_DTTM", "ARVL_LIST_REMOVE_DTTM")
    return wh["F_SCHED_APPT"].select(CSN, earliest.alias("earliest"))


@query(
    "scalar_text",
    """SELECT s_suppkey, left(s_name, 8) AS head, length(rtrim(s_name)) AS n,
         substr(s_name, 3, 4) AS mid, replace(s_name, '#', '^') AS swapped,
         s_name || ' - ' || CAST(s_suppkey AS VARCHAR) AS joined, coalesce(NULL, s_name, '') AS first_one
       FROM supplier""",
)
def _(wh):
    name = F.col("s_name")
    return wh["supplier"].select(
        "s_suppkey",
        clip(name, 8).alias("head"),
        F.length(F.rtrim(name)).cast("long").alias("n"),
        F.substring(name, 3, 4).alias("mid"),
        F.replace(name, F.lit("#"), F.lit("^")).alias("swapped"),
        F.concat(name, F.lit(" - "), F.col("s_suppkey").cast("string")).alias("joined"),
        F.coalesce(F.lit(None), name, F.lit("")).alias("first_one"),
    )


@query(
    "scalar_dates",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) - 3 AS lagged,
         last_day(CAST(CAST(ts AS DATE) + INTERVAL 2 MONTH AS DATE)) AS month_end,
         CAST(date_diff('minute', CAST(CAST(ts AS DATE) AS TIMESTAMP), ts) AS INTEGER) AS minute_of_day
       FROM events""",
)
def _(wh):
    day = F.to_date("ts")
    return wh["events"].select(
        "event_id",
        day.alias("day"),
        F.date_sub(day, 3).alias("lagged"),
        F.last_day(F.add_months(day, 2)).alias("month_end"),
        minutes_between(day.cast("timestamp_ntz"), "ts").alias("minute_of_day"),
    )


# --- Sources, sinks, checks -----------------------------------------------------------------------


@query("source_scan", "SELECT o_orderkey, o_custkey FROM orders")
def _(wh):
    return wh["orders"].select("o_orderkey", "o_custkey")


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL
       HAVING count(*) > 1""",
)
def _(wh):
    return duplicate_keys(wh["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_keys_with_null",
    """SELECT USER_ID, LINE, count(*) AS n_rows FROM MAR_ADMIN_INFO GROUP BY ALL
       HAVING count(*) > 1""",
)
def _(wh):
    return duplicate_keys(wh["MAR_ADMIN_INFO"], ["USER_ID", "LINE"])
