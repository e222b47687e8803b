"""Administrations, milestones, conditions, events and cohort edges."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from visitflow.operators.administrations import (
    attach_treatment_plan,
    infusion_administrations,
    infusion_intervals,
    order_intervals,
)
from visitflow.operators.cohort import (
    expand_cohort,
    in_scope,
    left_to_many,
    patient_day_cohort,
)
from visitflow.operators.conditions import (
    active_condition_list,
    active_conditions_asof,
    element_values,
)
from visitflow.operators.events import (
    open_and_used_slots,
    reconcile_timeline,
    unpivot_stamps,
    visit_timeline,
)
from visitflow.operators.milestones import first_per, last_per, milestone_pivot, with_counts
from visitflow.sources.warehouse import Warehouse


def frame(spark, rows, schema, *times):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def h(clock):
    return datetime(2024, 1, 1, int(clock[:2]), int(clock[3:]))


def given(spark, rows):
    stamped = [(csn, order, f"2024-01-01 {t}", code) for csn, order, t, code in rows]
    schema = "MAR_ENC_CSN long, ORDER_MED_ID long, TAKEN_TIME string, MAR_ACTION_C int"
    return frame(spark, stamped, schema, "TAKEN_TIME")


def intervals(spark, rows):
    out = order_intervals(given(spark, rows)).collect()
    return {(r.MAR_ENC_CSN, r.ORDER_MED_ID): (r.first_time, r.next_time) for r in out}


def test_interval_spans_first_bag_to_last_stop(spark):
    rows = [(1, 1, "09:30", 6), (1, 1, "09:00", 6), (1, 1, "10:00", 8), (1, 1, "11:00", 120),
            (1, 1, "12:00", 99)]
    assert intervals(spark, rows) == {(1, 1): (h("09:00"), h("11:00"))}


def test_interval_without_stop_has_no_end(spark):
    assert intervals(spark, [(1, 1, "09:00", 6)]) == {(1, 1): (h("09:00"), None)}
    assert intervals(spark, [(1, 1, "09:00", 99)]) == {}


def test_reversed_interval_is_kept(spark):
    assert intervals(spark, [(1, 1, "09:00", 8), (1, 1, "10:00", 6)]) == {
        (1, 1): (h("09:00"), h("10:00"))
    }


def test_spans_and_plan_lists(spark):
    orders = order_intervals(
        given(
            spark,
            [
                (1, 1, "09:00", 6), (1, 1, "10:00", 8), (1, 2, "08:00", 6),
                (1, 3, "09:30", 6), (1, 3, "12:00", 120), (2, 4, "09:00", 6),
            ],
        )
    )
    plans = spark.createDataFrame(
        [(1, 70, "A & B", 5), (2, 60, "C", 6), (None, 50, "D", 5)],
        "ORDER_ID long, TREATMENT_PLAN_ID long, PLAN_NAME string, PLAN_PROV_ID long",
    )
    providers = spark.createDataFrame([(5, "P <x>")], "PROV_ID long, PROV_NAME string")
    rows = infusion_intervals(attach_treatment_plan(orders, plans, providers)).collect()
    assert [r.MAR_ENC_CSN for r in rows] == [1]  # encounter 2 has no complete interval
    (row,) = rows
    assert (row.start_time, row.stop_time) == (h("09:00"), h("12:00"))
    assert row.plan_count == 1  # order 2 is incomplete, order 3 has no plan
    assert row.plan_names == "|C|A & B|"  # lists cover every order; no plan sorts first
    assert row.plan_providers == "||P &lt;x&gt;|"


def test_plan_lists_are_whole_and_distinct(spark):
    n = 40
    rows = [(1, o, t, c) for o in range(n) for t, c in (("09:00", 6), ("10:00", 8))]
    plans = spark.createDataFrame(
        [(o, o // 2, f"plan {o // 2}" if o % 5 else None, 1) for o in range(n)],
        "ORDER_ID long, TREATMENT_PLAN_ID long, PLAN_NAME string, PLAN_PROV_ID long",
    )
    providers = spark.createDataFrame([], "PROV_ID long, PROV_NAME string")
    orders = attach_treatment_plan(order_intervals(given(spark, rows)), plans, providers)
    pairs = {(o // 2, f"plan {o // 2}" if o % 5 else None) for o in range(n)}
    ordered = sorted(pairs, key=lambda p: (p[0], p[1] is not None, p[1]))
    whole = "".join((name or "") + "|" for _, name in ordered)
    assert infusion_intervals(orders).first().plan_names == whole


def test_due_and_foreign_administrations_are_dropped(spark):
    admin = frame(
        spark,
        [(1, 1, "2024-01-01 09:00", 6), (1, 1, "2024-01-01 09:00", 100), (1, 2, "2024-01-01 09:00", 6),
         (1, 1, "2024-03-01 09:00", 6), (9, 1, "2024-01-01 09:00", 6), (1, 1, "2024-01-01 09:00", None)],
        "MAR_ENC_CSN long, ORDER_MED_ID long, SCHEDULED_TIME string, MAR_ACTION_C int",
        "SCHEDULED_TIME",
    )
    info = spark.createDataFrame(
        [(1, 1, 0), (2, 2, 0)], "ORDER_MED_ID long, MAR_ADMIN_TYPE_C int, INFUSION_TYPE_C int"
    )
    encounters = spark.createDataFrame(
        [(1, "Z1", "I1", 5)],
        "PAT_ENC_CSN_ID long, PAT_ID string, INPATIENT_DATA_ID string, DEPARTMENT_ID int",
    )
    window = (datetime(2024, 1, 1), datetime(2024, 2, 1))
    kept = infusion_administrations(admin, info, encounters, [5], *window)
    assert kept.count() == 1


def test_milestones(spark):
    df = frame(
        spark,
        [(1, "a", "2024-01-01 09:00"), (1, "a", "2024-01-01 08:00"), (1, "b", "2024-01-01 07:00"),
         (1, "b", "2024-01-01 10:00"), (2, "x", "2024-01-01 09:00"), (3, "a", None),
         (3, "a", "2024-01-01 08:00"), (3, "b", None), (3, "b", "2024-01-01 08:00")],
        "id int, code string, t string",
        "t",
    )
    out = milestone_pivot(df, ["id"], "code", "t", {"a": ("A", "first"), "b": ("B", "last")})
    got = {r.id: (r.A, r.B) for r in out.collect()}
    assert got == {
        1: (h("08:00"), h("10:00")),
        2: (None, None),  # passes the filter, lands in no column
        3: (None, h("08:00")),  # an undated row comes first
    }


def test_first_and_last_per(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, None)], "k int, o int, v string")
    assert sorted(map(tuple, first_per(df, ["k"], ["o"]).collect())) == [(1, 1, "a"), (2, 5, None)]
    assert sorted(map(tuple, last_per(df, ["k"], ["o"]).collect())) == [(1, 3, "c"), (2, 5, None)]


def test_counts_include_null_groups(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "a")], "k int, v string")
    out = with_counts(df, {"n": (["k"], "v"), "m": (["v"], None)})
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, None, 1, 1), (1, "a", 1, 2), (None, "a", 1, 2)], key=str
    )


def conditions(spark, rows):
    return frame(
        spark, rows, "PAT_ID int, LINE int, NAME string, INF_ADD_PL_TIME string, INF_RSV_PL_TIME string",
        "INF_ADD_PL_TIME", "INF_RSV_PL_TIME",
    )


def test_active_conditions(spark):
    days = spark.createDataFrame([(1, date(2024, 1, 2))], "PAT_ID int, appt_date date")
    rows = [
        (1, 1, "same day, later", "2024-01-02 23:00", None),
        (1, 2, "next day", "2024-01-03 00:00", None),
        (1, 3, "resolved", "2024-01-01 00:00", "2024-01-05 00:00"),
        (1, 4, "undated", None, None),
        (2, 5, "other patient", "2024-01-01 00:00", None),
    ]
    found = active_conditions_asof(days, conditions(spark, rows))
    assert [r.LINE for r in found.collect()] == [1]


def test_no_pair_outside_the_result_is_formed(spark):
    """One patient with many days and conditions: the join gives the result's rows and no others."""
    days = [date(2024, 1, 1) + timedelta(days=k) for k in range(60)]
    visits = spark.createDataFrame([(1, d) for d in days] + [(2, days[0]), (None, days[0])], "PAT_ID int, appt_date date")
    rows = [(1, k, f"c{k}", f"{days[k % 60]} 08:00", None) for k in range(90)] + [(None, 1, "no patient", "2024-01-01 00:00", None)]
    found = active_conditions_asof(visits, conditions(spark, rows))
    got = sorted((r.appt_date, r.LINE) for r in found.collect())
    assert got == sorted((d, k) for d in days for k in range(90) if days[k % 60] <= d)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "appt_date" in plan and ">= _added" not in plan and "Generate explode" in plan
    counted = found.groupBy().count().collect()[0][0]
    pairs = found._jdf.queryExecution().toRdd().count()
    assert counted == pairs == len(got)


def test_condition_list_keeps_what_each_day_shows(spark):
    """Cutting conditions per day added must not change any later day's clipped text."""
    days = [date(2024, 1, d) for d in (1, 3, 6)]
    rows = [
        (1, line, f"c{line}", f"2024-01-0{1 + line % 6} 10:00", None) for line in range(200, 0, -1)
    ]
    visits = spark.createDataFrame([(1, d) for d in days], "PAT_ID int, appt_date date")
    out = active_condition_list(visits, conditions(spark, rows), "NAME", "names", 60)
    got = {r.appt_date: r.names for r in out.collect()}
    for d in days:
        active = sorted(line for _, line, *_ in rows if 1 + line % 6 <= d.day)
        assert got[d] == "|".join(f"c{line}" for line in active)[:60]


def test_element_without_values_keeps_a_row(spark):
    encounters = spark.createDataFrame([(1,), (2,)], "PAT_ENC_CSN_ID long")
    data = spark.createDataFrame(
        [(10, "E", "ENCOUNTER", 1), (20, "E", "PATIENT", 2), (30, "F", "ENCOUNTER", 2)],
        "HLV_ID int, ELEMENT_ID string, CONTEXT_NAME string, CONTACT_SERIAL_NUM long",
    )
    values = spark.createDataFrame([(10, "  ", 1)], "HLV_ID int, SMRTDTA_ELEM_VALUE string, LINE int")
    out = element_values(encounters, data, values, "E").collect()
    assert [tuple(r) for r in out] == [(1, None, None)]


def test_cohort_and_expansion(spark):
    appt = frame(
        spark,
        [(1, "a", "2024-01-01 09:00", 5, 1), (2, "a", "2024-01-01 10:00", 7, 1),
         (3, "a", "2024-01-02 09:00", 7, 1), (4, "b", "2024-01-01 09:00", 7, 3),
         (5, "c", "2024-02-01 09:00", 5, 1)],
        "PAT_ENC_CSN_ID long, PAT_ID string, APPT_DTTM string, DEPARTMENT_ID int, PROV_ID int",
        "APPT_DTTM",
    )
    patients = spark.createDataFrame([("a", "M1"), ("a", "M1")], "PAT_ID string, PAT_MRN_ID string")
    window = (datetime(2024, 1, 1), datetime(2024, 1, 31))
    scope = in_scope([5], [3])
    cohort = patient_day_cohort(appt, patients, *window, scope)
    assert sorted((r.PAT_ID, r.PAT_MRN_ID) for r in cohort.collect()) == [("a", "M1"), ("b", None)]
    every = expand_cohort(appt, cohort)
    assert sorted(r.PAT_ENC_CSN_ID for r in every.collect()) == [1, 2, 4]
    scoped = expand_cohort(appt, cohort, scope)
    assert sorted(r.PAT_ENC_CSN_ID for r in scoped.collect()) == [1, 4]


def test_left_to_many_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, r string")
    many = left_to_many(left, right, "k")
    plain = left.join(right, "k", "left")
    assert many.columns == plain.columns
    assert sorted(map(str, many.collect())) == sorted(map(str, plain.collect()))


def test_timeline_and_reconciliation(spark):
    appt = frame(
        spark, [(1, "2024-01-01 09:00", None), (2, "2024-01-01 09:30", "2024-01-01 10:00")],
        "PAT_ENC_CSN_ID long, APPT_DTTM string, CHECKIN_DTTM string", "APPT_DTTM", "CHECKIN_DTTM",
    )
    events = frame(
        spark, [(2, "in", "2024-01-01 10:00"), (1, "x", "2024-01-01 10:00"), (1, "y", None)],
        "PAT_ENC_CSN_ID long, EVENT_DISPLAY_NAME_iev string, EVENT_TIME_iev string", "EVENT_TIME_iev",
    )
    stamps = ("APPT_DTTM", "CHECKIN_DTTM")
    assert unpivot_stamps(appt, stamps).count() == 3  # empty stamps vanish
    assert visit_timeline(events, appt, stamps).count() == 6
    matched = {
        (r.CSN, r.EVENT_DISPLAY_NAME, r.TimeType)
        for r in reconcile_timeline(events, appt, stamps).collect()
    }
    assert matched == {
        (2, "in", "CHECKIN_DTTM"), (1, "x", None), (1, "y", None),
        (1, None, "APPT_DTTM"), (2, None, "APPT_DTTM"),
    }


def test_slots(spark):
    slots = spark.createDataFrame(
        [(1, 1, date(2024, 1, 1)), (None, 0, date(2024, 1, 1)), (None, 0, date(2024, 1, 9)),
         (1, 0, date(2024, 1, 1))],
        "PAT_ENC_CSN_ID long, APPT_NUMBER int, SLOT_DATE date",
    )
    appt = spark.createDataFrame([(1, date(2024, 1, 1))], "PAT_ENC_CSN_ID long, CONTACT_DATE date")
    out = open_and_used_slots(slots, appt.select("PAT_ENC_CSN_ID"), appt)
    assert out.count() == 4  # a used slot that also looks unbooked appears twice


def test_collated_columns_ignore_case_and_blanks(spark):
    """Binary by default; by a collation where one is declared."""
    rows = spark.createDataFrame([(1, "Yes"), (2, "yes "), (3, "YES"), (4, "no"), (5, None)], "id int, v string")

    def found(**options):
        tables = Warehouse(spark, frames={"T": rows, "U": spark.createDataFrame([("yes", "a")], "v string, w string")}, **options)
        table, other = tables["T"], tables["U"]
        equal = {r.id for r in table.filter(F.col("v") == "yes").collect()}
        among = {r.id for r in table.filter(F.col("v").isin("YES", "x")).collect()}
        joined = {r.id for r in table.join(other, table["v"] == other["v"]).collect()}
        return equal, among, joined, table.select("v").distinct().count()

    assert found() == (set(), {3}, set(), 5)
    assert found(collations={t: {"v": "UTF8_LCASE_RTRIM"} for t in "TU"}) == ({1, 2, 3}, {1, 2, 3}, {1, 2, 3}, 3)
    with pytest.raises(KeyError, match="absent"):
        Warehouse(spark, frames={"T": rows}, collations={"T": {"absent": "UTF8_LCASE"}})["T"]
