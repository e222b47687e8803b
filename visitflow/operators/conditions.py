"""Conditions active on a visit day, and smart-data values of an encounter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.functions.text import non_empty
from visitflow.operators.cohort import left_to_many
from visitflow.operators.lists import enumerate_lines
from visitflow.operators.ordered import tally, with_neighbours
from visitflow.session import stored


def unresolved(conditions: DataFrame) -> DataFrame:
    """Conditions that were added and never resolved, with the day they were added."""
    return conditions.filter(
        F.col("INF_ADD_PL_TIME").isNotNull() & F.col("INF_RSV_PL_TIME").isNull()
    ).withColumn("_added", F.to_date("INF_ADD_PL_TIME"))


def active_conditions_asof(
    visits: DataFrame,
    conditions: DataFrame,
    patient: str = "PAT_ID",
    day: str = "appt_date",
) -> DataFrame:
    """Conditions of each (patient, visit day) added on or before that day; one row for each.

    A sweep, so that no other pair is formed: days and conditions of a patient go through one order of
    time, in which a condition comes before the day it was added on. The days before a condition are those that
    it is not active on; from the next one on it is, and those are joined by their number. A patient
    with very many days and conditions is spread over ranges by the order, and over days by the join.
    """
    days = visits.select(patient, day).distinct().filter(F.col(patient).isNotNull() & F.col(day).isNotNull())
    added = unresolved(conditions).filter(F.col(patient).isNotNull())
    carried = F.struct(*[F.col(f"`{c}`") for c in conditions.columns])
    swept = days.select(F.col(patient).alias("_patient"), F.col(day).alias("_at"), F.lit(1).alias("_kind")).unionByName(
        added.select(
            F.col(patient).alias("_patient"), F.col("_added").cast(days.schema[day].dataType).alias("_at"), F.lit(0).alias("_kind"),
            carried.alias("_row"),
        ),
        allowMissingColumns=True,
    )
    is_day = F.col("_kind") == 1
    swept = with_neighbours(swept, ["_patient"], ["_at", "_kind"], {"_days": tally(F.when(is_day, 1))})
    placed = stored(swept, "swept")
    numbered = placed.filter(is_day).select("_patient", "_at", F.col("_days").alias("_number"))
    last = numbered.groupBy("_patient").agg(F.max("_number").alias("_last"))
    opened = placed.filter("_kind = 0").join(last, "_patient").filter(F.col("_days") < F.col("_last"))
    pairs = opened.select("_patient", "_row", F.explode(F.sequence(F.col("_days") + 1, "_last")).alias("_number"))
    others = [F.col(f"_row.`{c}`") for c in conditions.columns if c != patient]
    return pairs.join(numbered, ["_patient", "_number"]).select(
        F.col("_patient").alias(patient), *others, F.col("_at").alias(day)
    )


def active_condition_list(
    visits: DataFrame,
    conditions: DataFrame,
    value: str,
    name: str,
    width: int | None = None,
    patient: str = "PAT_ID",
    day: str = "appt_date",
) -> DataFrame:
    """Active conditions of each visit day as one text, in line order."""
    active = active_conditions_asof(visits, conditions, patient, day)
    return enumerate_lines(
        active, [patient, day], "LINE", value, name, width, trailing=False, unique_lines=True
    )


def element_values(
    encounters: DataFrame,
    data: DataFrame,
    values: DataFrame,
    element: str,
    context: str = "ENCOUNTER",
    encounter: str = "PAT_ENC_CSN_ID",
) -> DataFrame:
    """Non-empty value lines of one smart-data element for the encounters that have it recorded."""
    wanted = encounters.select(F.col(encounter).alias("CONTACT_SERIAL_NUM")).distinct()
    recorded = data.filter(
        (F.col("CONTEXT_NAME") == context) & (F.col("ELEMENT_ID") == element)
    ).select("HLV_ID", "CONTACT_SERIAL_NUM")
    lines = values.filter(non_empty("SMRTDTA_ELEM_VALUE")).select(
        "HLV_ID", "SMRTDTA_ELEM_VALUE", "LINE"
    )
    kept = recorded.join(wanted, "CONTACT_SERIAL_NUM", "left_semi")
    return left_to_many(kept, lines, "HLV_ID").select(
        "CONTACT_SERIAL_NUM", "SMRTDTA_ELEM_VALUE", "LINE"
    )
