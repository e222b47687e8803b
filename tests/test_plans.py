"""The extracts as a whole: staging, key checks, revisions, and what their scans read."""

from datetime import date, datetime

import pytest
from conftest import TEST_DATA
from pyspark.sql import functions as F

from fixtures import registry
from fixtures.queries_extracts import board_report, infusion_report, outpatient_report
from fixtures.views import VIEWS, TestWarehouse
from visitflow.operators.checks import duplicate_keys
from visitflow.operators.cohort import left_to_many
from visitflow.plans import infusion, outpatient, reviews, status_board
from visitflow.sources import contracts
from visitflow.sources.load import conform
from visitflow.sources.staging import verified, written
from visitflow.sources.warehouse import Warehouse

CSN = "PAT_ENC_CSN_ID"


@pytest.fixture(scope="module")
def wh(spark):
    return TestWarehouse(spark, TEST_DATA)


def rows(df):
    return sorted(map(repr, df.collect()))


def test_infusion_staged_and_verified_equals_inline(wh, tmp_path):
    stage = verified(infusion.STAGE_KEYS, written(str(tmp_path), "infusion"))
    staged = infusion.report(
        wh, registry.RUN_DATE, registry.INFUSION_UNITS, registry.LOAD_TS, stage=stage
    )
    assert rows(staged) == rows(infusion_report(wh))
    assert {p.stem for p in tmp_path.glob("*/*.parquet")} == set(infusion.STAGE_KEYS)


def test_outpatient_staged_and_verified_equals_inline(wh, tmp_path):
    stage = verified(outpatient.STAGE_KEYS, written(str(tmp_path), "outpatient"))
    assert rows(outpatient_report(wh, stage=stage)) == rows(outpatient_report(wh))


def test_board_staged_and_verified_equals_inline(wh, tmp_path):
    stage = verified(status_board.STAGE_KEYS, written(str(tmp_path), "board"))
    staged = status_board.report(
        wh, registry.BOARD_RUN_DATE, registry.BOARD_CLINICS, registry.LOAD_TS, registry.ELEMENT,
        stage=stage,
    )
    assert rows(staged) == rows(board_report(wh))


def test_two_extracts_share_a_folder(wh, tmp_path):
    """Runs of two extracts, and a second run of one, keep their stages apart."""
    def stage(name):
        return written(str(tmp_path), name)

    first = infusion.report(
        wh, registry.RUN_DATE, registry.INFUSION_UNITS, registry.LOAD_TS, stage=stage("infusion")
    )
    second = outpatient_report(wh, stage=stage("outpatient"))
    third = infusion.report(wh, registry.RUN_DATE, (0,), registry.LOAD_TS, stage=stage("infusion"))
    assert rows(first) == rows(infusion_report(wh)) and rows(second) == rows(outpatient_report(wh))
    assert rows(third) == rows(infusion_report(wh, (0,)))


def test_extracts_fit_their_contracts(wh):
    extracts = (
        (infusion.table_rows(infusion_report(wh)), contracts.infusion()),
        (outpatient.table_rows(outpatient_report(wh)), contracts.clinics()),
        (status_board.table_rows(board_report(wh)), contracts.status_board()),
    )
    for rows_out, contract in extracts:
        typed = conform(rows_out, contract)
        assert typed.columns == contract.names
        assert typed.count() > 0
        if contract.key:
            assert duplicate_keys(typed, contract.key).count() == 0


def test_one_patient_only(wh):
    patient = infusion_report(wh).select("patient_id").orderBy("patient_id").first()[0]
    one = infusion.report(
        wh, registry.RUN_DATE, registry.INFUSION_UNITS, registry.LOAD_TS, patient=patient
    )
    every = infusion_report(wh).filter(F.col("patient_id") == patient)
    assert rows(one) == rows(every)
    details = reviews.drill_down(one, F.col("Appointment Status") != "canc", ["Appointment ID"])
    assert details.filter("`Appointment Status` = 'canc'").count() == 0


def test_earlier_link_rule_finds_more(wh):
    def links(**options):
        return outpatient_report(wh, with_link=True, **options).filter("next_id IS NOT NULL").count()

    assert links(keep_target=True) > links()


def test_earlier_window(wh):
    early = outpatient_report(wh, back_days=1, forward_months=2, start=datetime(2024, 1, 3))
    assert early.agg(F.min("APPT_DTTM")).first()[0] >= datetime(2024, 1, 3)


def test_board_first_revision(wh):
    plain = status_board.table_rows(board_report(wh))
    first = status_board.table_rows(board_report(wh), first_revision=True)
    assert first.agg(F.max(F.length("APPT_NOTES"))).first()[0] <= 254
    key = ["PAT_ENC_CSN_ID_unhashed", "EVENT_DTTM", "INFECTION_STATUS"]
    renamed = first.withColumn(
        "INFECTION_STATUS", F.replace("INFECTION_STATUS", F.lit(","), F.lit("^"))
    )
    assert rows(renamed.select(key)) == rows(
        plain.withColumn("INFECTION_STATUS", F.substring("INFECTION_STATUS", 1, 254)).select(key)
    )


def test_site_prefix_reaches_headings(wh):
    report = infusion.report(
        wh, registry.RUN_DATE, registry.INFUSION_UNITS, registry.LOAD_TS, site="XYZ"
    )
    assert "T XYZ AMB PATIENT UNDERSTANDING AVS" in infusion.table_rows(report, "XYZ").columns


def test_busy_patient_day_leaves_extracts_unchanged(spark, wh):
    """A third of all visits on one patient: how its days are dealt must not show in any row."""
    appt = wh["V_SCHED_APPT"]
    busy = F.when(F.col(CSN) % 3 == 0, "Z1").otherwise(F.col("PAT_ID"))
    frames = {name: wh[name] for name in VIEWS}
    frames["V_SCHED_APPT"] = appt.withColumn("PAT_ID", busy)
    skewed = Warehouse(spark, frames=frames)
    name, found = "spark.sql.shuffle.partitions", []
    usual = spark.conf.get(name)
    try:
        for parts in (1, 16):
            spark.conf.set(name, parts)
            later = outpatient_report(skewed, with_link=True, keep_target=True)
            found.append((rows(infusion_report(skewed)), rows(later)))
    finally:
        spark.conf.set(name, usual)
    assert found[0] == found[1]


@pytest.fixture(scope="module")
def stored(spark, wh, tmp_path_factory):
    """Source tables as plain parquet, so scans show what is pushed down."""
    folder = tmp_path_factory.mktemp("source")
    for name in (
        "V_SCHED_APPT", "PATIENT", "MAR_ADMIN_INFO", "ORDER_MEDINFO", "PAT_ENC", "PAT_ENC_APPT_NOTES",
        "IP_FLWSHT_REC", "IP_FLWSHT_MEAS", "IP_FLO_GP_DATA",
    ):
        wh[name].write.parquet(f"{folder}/{name}.parquet")
    return Warehouse(spark, folder=str(folder))


def scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and f"{table}.parquet" in line]


def test_scans_are_bounded_by_the_window(stored):
    window = (datetime(2024, 1, 1), datetime(2024, 1, 3))
    visits = infusion.linked_visits(stored, (0, 1), *window)
    found = scans(visits, "V_SCHED_APPT")
    assert len(found) >= 2
    for scan in found:
        assert "GreaterThanOrEqual(APPT_DTTM,2024-01-01T00:00" in scan
        assert "LessThan" in scan.split("PushedFilters")[1]
    # The cohort reads three columns, the linked visits only what the extract exports.
    cohort_columns = "struct<PAT_ID:string,APPT_DTTM:timestamp_ntz,DEPARTMENT_ID:bigint>"
    assert any(cohort_columns in scan for scan in found)
    assert all("PROV_NAME_WID#" not in scan.replace("REFERRING_PROV", "") for scan in found)


def test_window_days_keep_whole_days(stored):
    """A window that ends at noon still links visits to later ones of the same day."""
    noon = (datetime(2024, 1, 1), datetime(2024, 1, 2, 12))
    visits = infusion.linked_visits(stored, (0, 1, 2, 3, 4), *noon)
    appt = stored["V_SCHED_APPT"]
    scoped = appt.filter("DEPARTMENT_ID < 5")
    days = scoped.filter(
        (F.col("APPT_DTTM") >= F.lit("2024-01-01").cast("timestamp_ntz"))
        & (F.col("APPT_DTTM") <= F.lit("2024-01-02 12:00:00").cast("timestamp_ntz"))
    ).select("PAT_ID", "CONTACT_DATE").distinct()
    expected = scoped.join(days, ["PAT_ID", "CONTACT_DATE"], "left_semi").select(CSN)
    assert rows(visits.select(CSN)) == rows(expected)


def test_administration_scan_is_bounded(stored):
    window = (datetime(2024, 1, 1), datetime(2024, 1, 3))
    given = infusion.infusion_administrations(
        stored["MAR_ADMIN_INFO"], stored["ORDER_MEDINFO"], stored["PAT_ENC"], (0, 1), *window
    )
    (scan,) = scans(given, "MAR_ADMIN_INFO")
    assert "GreaterThanOrEqual(SCHEDULED_TIME" in scan and "MAR_ACTION_C" in scan


def test_children_are_read_once(stored):
    """A one-to-many left join stores the reduced children; its plan reads their table no more."""
    child = stored["PAT_ENC_APPT_NOTES"].select(CSN, "LINE")
    both = left_to_many(stored["V_SCHED_APPT"].select(CSN), child, CSN)
    assert scans(both, "PAT_ENC_APPT_NOTES") == [] and len(scans(both, "V_SCHED_APPT")) >= 1


def test_outpatient_measures_are_one_scan(stored):
    visits = stored["PAT_ENC"].select(CSN, "INPATIENT_DATA_ID")
    assert len(scans(outpatient.measures(stored, visits), "IP_FLWSHT_MEAS")) == 1


def test_run_date_is_a_parameter():
    """Same inputs, same rows: no plan reads the clock."""
    import inspect

    for module in (infusion, outpatient, status_board):
        source = inspect.getsource(module)
        assert "current_date" not in source and "now()" not in source
    assert registry.RUN_DATE == date(2024, 1, 2)
