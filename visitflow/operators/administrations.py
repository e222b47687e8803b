"""Medication administrations, treatment plans and infusion intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow import codes
from visitflow.functions.labels import administration_status, user_label
from visitflow.functions.stamps import stamp_text
from visitflow.functions.text import escape_markup
from visitflow.operators.cohort import in_window

# Display lookups of an administration: table -> (its key, administration column, output name)
LABELS = {
    "ZC_MAR_RSLT": ("RESULT_C", "MAR_ACTION_C", "MAR_ACTION_NAME"),
    "ZC_MED_DURATION_UN": ("MED_DURATION_UN_C", "MAR_DURATION_UNIT_C", "MAR_DURATION_NAME"),
    "ZC_MED_UNIT": ("DISP_QTYUNIT_C", "DOSE_UNIT_C", "DOSE_UNIT_NAME"),
    "ZC_MAR_RSN": ("REASON_C", "REASON_C", "REASON_NAME"),
    "ZC_INFUSION_TYPE": ("INFUSION_TYPE_C", "INFUSION_TYPE_C", "INFUSION_TYPE_NAME"),
    "ZC_MAR_ADMIN_TYPE": ("MAR_ADMIN_TYPE_C", "MAR_ADMIN_TYPE_C", "MAR_ADMIN_TYPE_NAME"),
}


def infusion_administrations(
    admin: DataFrame,
    order_info: DataFrame,
    encounters: DataFrame,
    departments: Sequence,
    start: datetime,
    end: datetime,
) -> DataFrame:
    """Administrations of infusion orders, not merely due, scheduled in the window and in scope.

    The order and encounter joins are inner: rows without either fail the filters anyway.
    """
    orders = order_info.filter(F.col("MAR_ADMIN_TYPE_C") == codes.INFUSION_ORDER_TYPE).select(
        "ORDER_MED_ID", "MAR_ADMIN_TYPE_C", "INFUSION_TYPE_C"
    )
    visits = encounters.filter(F.col("DEPARTMENT_ID").isin(*departments)).select(
        F.col("PAT_ENC_CSN_ID").alias("MAR_ENC_CSN"), "PAT_ID", "INPATIENT_DATA_ID", "DEPARTMENT_ID"
    )
    given = admin.filter(
        in_window("SCHEDULED_TIME", start, end) & (F.col("MAR_ACTION_C") != codes.ACTION_DUE)
    )
    return given.join(visits, "MAR_ENC_CSN").join(orders, "ORDER_MED_ID")


def med_administrations(
    base: DataFrame, tables: Mapping[str, DataFrame], names: Sequence[str] = tuple(LABELS)
) -> DataFrame:
    """Infusion administrations with every display label: results, units, medication, user, patient."""
    out = base
    for table in names:
        key, code, label = LABELS[table]
        lookup = tables[table].select(F.col(key).alias(code), F.col("NAME").alias(label))
        out = out.join(lookup, code, "left")
    employees = tables["CLARITY_EMP"].select(
        F.col("USER_ID").alias("_emp"), F.col("NAME").alias("_emp_name")
    )
    medications = tables["CLARITY_MEDICATION"].select(
        "MEDICATION_ID", F.col("NAME").alias("MEDICATION_NAME")
    )
    out = (
        out.join(employees, out["USER_ID"] == employees["_emp"], "left")
        .join(tables["CLARITY_DEP"].select("DEPARTMENT_ID", "DEPARTMENT_NAME"), "DEPARTMENT_ID", "left")
        .join(tables["ORDER_MED"].select("ORDER_MED_ID", "MEDICATION_ID"), "ORDER_MED_ID", "left")
        .join(medications, "MEDICATION_ID", "left")
        .join(tables["PATIENT"].select("PAT_ID", "PAT_NAME"), "PAT_ID", "left")
    )
    return out.select(
        "DEPARTMENT_ID", "DEPARTMENT_NAME", "MAR_ENC_CSN", "ORDER_MED_ID", "LINE", "EDITED_LINE",
        "SCHEDULED_TIME",
        stamp_text("SCHEDULED_TIME", "us_date", blank=False).alias("MAR_Date"),
        "TAKEN_TIME",
        stamp_text("TAKEN_TIME", "clock", blank=False).alias("HHMMSS"),
        "MAR_ACTION_C", "MAR_ACTION_NAME", "INFUSION_RATE", "MAR_DURATION", "MAR_DURATION_NAME",
        administration_status("DUE_ACTION_C", "MAR_ACTION_NAME").alias("MAR_Status"),
        F.col("SIG").alias("Dose"), "DOSE_UNIT_NAME", "REASON_NAME", "USER_ID",
        user_label("USER_ID", "_emp", "_emp_name").alias("MAR_User"),
        F.col("COMMENTS").alias("MAR_Comments"), "MEDICATION_ID", "MEDICATION_NAME", "PAT_ID",
        "INPATIENT_DATA_ID", "PAT_NAME", "INFUSION_TYPE_NAME", "MAR_ADMIN_TYPE_C",
        "MAR_ADMIN_TYPE_NAME",
    )


def _plan_columns(plan_orders: DataFrame, order: str) -> DataFrame:
    return plan_orders.select(
        F.col("ORDER_ID").alias(order), "TREATMENT_PLAN_ID", "PLAN_NAME", "PLAN_PROV_ID"
    )


def _with_plan_provider(df: DataFrame, providers: DataFrame) -> DataFrame:
    named = providers.select(
        F.col("PROV_ID").alias("PLAN_PROV_ID"), F.col("PROV_NAME").alias("PLAN_PROV_NAME")
    )
    return df.join(named, "PLAN_PROV_ID", "left")


def treatment_plans(
    orders: DataFrame, plan_orders: DataFrame, providers: DataFrame, order: str = "ORDER_MED_ID"
) -> DataFrame:
    """Plan and plan provider of each distinct order; orders without a plan are left out."""
    wanted = orders.select(order).distinct()
    plans = _plan_columns(plan_orders, order).join(wanted, order, "left_semi")
    return _with_plan_provider(plans, providers)


def attach_treatment_plan(
    rows: DataFrame, plan_orders: DataFrame, providers: DataFrame, order: str = "ORDER_MED_ID"
) -> DataFrame:
    """Rows with their order's plan and plan provider, null where the order has no plan."""
    return _with_plan_provider(
        rows.join(_plan_columns(plan_orders, order), order, "left"), providers
    )


def first_action(df: DataFrame, keys, time: str, code: str, wanted, name: str) -> DataFrame:
    """Earliest time per group among rows with a wanted action."""
    return df.filter(F.col(code).isin(*wanted)).groupBy(*keys).agg(F.min(time).alias(name))


def last_action(df: DataFrame, keys, time: str, code: str, wanted, name: str) -> DataFrame:
    return df.filter(F.col(code).isin(*wanted)).groupBy(*keys).agg(F.max(time).alias(name))


def order_intervals(
    admin: DataFrame,
    keys: Sequence[str] = ("MAR_ENC_CSN", "ORDER_MED_ID"),
    time: str = "TAKEN_TIME",
    code: str = "MAR_ACTION_C",
    start_codes: Sequence = (codes.ACTION_NEW_BAG,),
    stop_codes: Sequence = codes.STOP_ACTIONS,
) -> DataFrame:
    """Per order: first start and last stop, as the pair (first_time, next_time) in time order.

    An order has at most these two points, so ordering them needs no window, only one aggregation
    that combines before the shuffle. A stop before the start gives a reversed pair, as recorded.
    With one point only, next_time is null. Administrations are unique by (keys, time).
    """
    started = F.min(F.when(F.col(code).isin(*start_codes), F.col(time)))
    stopped = F.max(F.when(F.col(code).isin(*stop_codes), F.col(time)))
    both = F.col("started").isNotNull() & F.col("stopped").isNotNull()
    return (
        admin.filter(F.col(code).isin(*start_codes, *stop_codes))
        .groupBy(*keys)
        .agg(started.alias("started"), stopped.alias("stopped"))
        .filter(F.col("started").isNotNull() | F.col("stopped").isNotNull())
        .select(
            *keys,
            F.least("started", "stopped").alias("first_time"),
            F.when(both, F.greatest("started", "stopped")).alias("next_time"),
        )
    )


def infusion_intervals(orders: DataFrame, encounter: str = "MAR_ENC_CSN") -> DataFrame:
    """Per encounter with a complete interval: span, plan count, and plan and provider lists.

    `orders` are order intervals with their treatment plan. The lists name each plan once and
    cover every order of the encounter; span and count use only orders with both points. Orders
    are first reduced to one row per plan, and everything comes from a second grouping, whose sets
    combine before the shuffle.
    """
    complete = F.col("next_time").isNotNull()
    per_plan = orders.groupBy(
        encounter, "TREATMENT_PLAN_ID", "PLAN_NAME", "PLAN_PROV_NAME"
    ).agg(
        F.min(F.when(complete, F.col("first_time"))).alias("first_time"),
        F.max("next_time").alias("next_time"),
    )

    plan = F.col("TREATMENT_PLAN_ID")
    interval = F.col("next_time").isNotNull()
    return (
        per_plan.groupBy(encounter)
        .agg(
            F.min("first_time").alias("start_time"),
            F.max("next_time").alias("stop_time"),
            F.size(F.collect_set(F.when(interval, plan))).cast("long").alias("plan_count"),
            _distinct_list(plan, "PLAN_NAME", False).alias("plan_names"),
            _distinct_list(plan, "PLAN_PROV_NAME", True).alias("plan_providers"),
        )
        .filter(F.col("stop_time").isNotNull())
    )


def _distinct_list(plan: Column, value: str, escape: bool) -> Column:
    """Aggregate: each distinct (plan, value) once, in order, null first, each ended by |."""
    pairs = F.array_sort(F.collect_set(F.struct(plan.alias("plan"), F.col(value).alias("value"))))

    def item(pair: Column) -> Column:
        text = F.coalesce(pair.getField("value"), F.lit(""))
        return F.concat(escape_markup(text) if escape else text, F.lit("|"))

    return F.array_join(F.transform(pairs, item), "")
