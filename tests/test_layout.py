"""Laid-out copies of the source tables: the same rows, joins without exchange, scans of the window's periods."""

import re
from datetime import datetime
from pathlib import Path

import pytest
from conftest import TEST_DATA
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fixtures import registry
from fixtures.queries_extracts import board_report, infusion_report, outpatient_report
from fixtures.views import TestWarehouse
from visitflow.plans import infusion, outpatient, status_board
from visitflow.sources.layout import LAYOUTS, LaidOut, Layout, lay_out
from visitflow.sources.staging import inline
from visitflow.sources.warehouse import Warehouse

CSN = "PAT_ENC_CSN_ID"
BUCKETS = 8
BY_ENCOUNTER = [name for name, layout in LAYOUTS.items() if layout.key == CSN]


@pytest.fixture(scope="module")
def wh(spark):
    return TestWarehouse(spark, TEST_DATA)


def schema(spark, folder, name):
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}/{name}'")
    return name


@pytest.fixture(scope="module")
def laid(spark, wh, tmp_path_factory):
    return lay_out(wh, schema(spark, tmp_path_factory.mktemp("laid"), "laid"), buckets=BUCKETS)


def rows(df):
    return sorted(map(repr, df.collect()))


def extracts(wh, stage):
    day, ts = registry.RUN_DATE, registry.LOAD_TS
    yield infusion.report(wh, day, registry.INFUSION_UNITS, ts, stage=stage)
    yield outpatient.report(wh, day, registry.CLINICS, ts, registry.CLINIC_PROVIDERS, stage=stage)
    yield status_board.report(
        wh, registry.BOARD_RUN_DATE, registry.BOARD_CLINICS, ts, registry.ELEMENT, stage=stage
    )


@pytest.fixture
def large_tables(spark):
    """Joins as between tables that are too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, usual)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bucketed_scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line and "Bucketed: true" in line]


def moved_tables(df):
    """Tables whose scanned rows are shuffled before they meet any other's, and by what, if that is one column."""
    lines, moved = plan(df).splitlines(), []
    depth = [re.search(r"[A-Za-z(*]", line).start() if re.search(r"[A-Za-z(*]", line) else 0 for line in lines]
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line:
            continue
        for below in range(at + 1, len(lines)):
            if depth[below] <= depth[at] or "Join" in lines[below] or "Union" in lines[below]:
                break
            if found := re.search(r"FileScan parquet \S*?\.laid\.(\w+?)__", lines[below]):
                alone = re.search(r"hashpartitioning\((\w+)#\w+, \d+\)", line)
                moved.append((found[1].upper(), alone and alone[1]))
    return moved


def test_extracts_over_copies_are_the_same(wh, laid):
    for build in (infusion_report, outpatient_report, board_report):
        assert rows(build(laid)) == rows(build(wh))


def test_tables_in_buckets_do_not_move(wh, laid, large_tables):
    for report, tables in zip(
        extracts(laid, inline),
        (
            {"PAT_ENC", "F_SCHED_APPT", "PAT_ENC_APPT", "PAT_ENC_APPT_NOTES", "MAR_ADMIN_INFO"},
            {"PAT_ENC", "F_SCHED_APPT", "PAT_ENC_RSN_VISIT", "PAT_ENC_APPT_NOTES"},
            {"PAT_ENC", "F_SCHED_APPT", "PAT_ENC_APPT_NOTES"},
        ),
        strict=True,
    ):
        names = {re.search(r"\.laid\.(\w+?)__", scan)[1].upper() for scan in bucketed_scans(report)}
        assert tables <= names
        keys = {name: layout.key for name, layout in LAYOUTS.items()}
        assert [pair for pair in moved_tables(report) if keys[pair[0]] == pair[1]] == []


def test_plain_tables_do_move(wh, laid, large_tables):
    """The check above sees an exchange where there is one."""
    both = laid["PAT_ENC"].repartition(BUCKETS + 1, CSN).join(laid["F_SCHED_APPT"].select(CSN), CSN)
    assert ("PAT_ENC", CSN) in moved_tables(both)
    two = laid["PAT_ENC"].select(CSN).join(laid["F_SCHED_APPT"].select(CSN), CSN)
    assert moved_tables(two) == [] and "Exchange" not in plan(two) and len(bucketed_scans(two)) == 2


def test_copies_hold_the_source_rows_and_columns(wh, laid):
    for name in LAYOUTS:
        assert laid[name].columns == wh[name].columns
        assert rows(laid[name]) == rows(wh[name])
    assert laid["CLARITY_DEP"] is wh["CLARITY_DEP"]


def test_other_periods_are_not_read(spark, wh, tmp_path):
    """Files of days outside the window may even be damaged."""
    layouts = {"V_SCHED_APPT": Layout("PAT_ID", "APPT_DTTM", "day")}
    laid = lay_out(wh, schema(spark, tmp_path, "by_day"), layouts, buckets=2)
    window = (datetime(2024, 1, 2), datetime(2024, 1, 3, 12))
    for folder in (tmp_path / "by_day").glob("*/APPT_DTTM_day=*"):
        if folder.name[-10:] not in ("2024-01-02", "2024-01-03"):
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"damaged")
    found = laid.on_days("V_SCHED_APPT", "APPT_DTTM", *window)
    assert rows(found) == rows(wh.on_days("V_SCHED_APPT", "APPT_DTTM", *window)) != []
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        laid["V_SCHED_APPT"].select("APPT_LENGTH").distinct().collect()


def test_months_of_a_window(spark, tmp_path):
    """Rows at the edges of months, and without a time."""
    times = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-31 23:59:59", "2024-02-01 00:00:00", None]
    table = spark.createDataFrame(list(enumerate(times)), "id long, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz")
    )
    source = Warehouse(spark, frames={"visits": table})
    laid = lay_out(source, schema(spark, tmp_path, "months"), {"visits": Layout("id", "t")}, buckets=2)
    assert rows(laid["visits"]) == rows(table)
    for window in (
        (datetime(2023, 12, 31, 8), datetime(2024, 1, 1)),
        (datetime(2024, 1, 31), datetime(2024, 1, 31, 5)),
        (datetime(2024, 1, 1), datetime(2024, 2, 1)),
    ):
        found = rows(laid.on_days("visits", "t", *window))
        assert found == rows(source.on_days("visits", "t", *window)) and len(found) > 0


def test_a_heavy_key_is_left_to_skew_handling(spark, wh, tmp_path):
    """One encounter, or no encounter, with a third of all notes: no bucket is to hold them."""
    notes = wh["PAT_ENC_APPT_NOTES"]
    for number, key in enumerate((F.lit(7), F.lit(None))):
        busy = notes.withColumn(CSN, F.when(F.col("LINE") % 3 == 0, key.cast("long")).otherwise(F.col(CSN)))
        source = Warehouse(spark, frames={"PAT_ENC_APPT_NOTES": busy, "F_SCHED_APPT": wh["F_SCHED_APPT"]})
        layouts = {name: LAYOUTS[name] for name in ("PAT_ENC_APPT_NOTES", "F_SCHED_APPT")}
        laid = lay_out(source, schema(spark, tmp_path, f"heavy_{number}"), layouts, buckets=BUCKETS)
        joined = laid["F_SCHED_APPT"].select(CSN).join(laid["PAT_ENC_APPT_NOTES"], CSN)
        assert rows(joined) == rows(busy.join(wh["F_SCHED_APPT"].select(CSN), CSN))
        copies = {t.tableName.split("__")[0]: t.tableName for t in spark.sql(f"SHOW TABLES IN heavy_{number}").collect() if "__" in t.tableName}
        told = {n: {r[0] for r in spark.sql(f"DESCRIBE EXTENDED heavy_{number}.{t}").collect()} for n, t in copies.items()}
        assert "Num Buckets" not in told["pat_enc_appt_notes"] and "Num Buckets" in told["f_sched_appt"]


def test_empty_table_and_collated_key(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, t timestamp_ntz")
    texts = spark.createDataFrame([("a", 1), ("A", 2), (None, 3)], "id string, n int")
    source = Warehouse(
        spark, frames={"empty": empty, "texts": texts}, collations={"texts": {"id": "UTF8_LCASE"}}
    )
    layouts = {"empty": Layout("id", "t"), "texts": Layout("id")}
    laid = lay_out(source, schema(spark, tmp_path, "small"), layouts, buckets=2)
    assert laid["empty"].count() == 0 and laid["empty"].columns == ["id", "t"]
    assert laid["texts"].filter("id = 'A'").count() == 2


def test_stopped_layout_leaves_the_old_copy(spark, tmp_path):
    good = spark.range(10).withColumn("x", F.lit(1))
    name, layouts = schema(spark, tmp_path, "stopped"), {"numbers": Layout("id")}
    lay_out(Warehouse(spark, frames={"numbers": good}), name, layouts, buckets=2)
    failing = spark.range(20).withColumn("x", F.when(F.col("id") < 19, 1).otherwise(F.raise_error(F.lit("stop")).cast("int")))
    with pytest.raises(PySparkException):
        lay_out(Warehouse(spark, frames={"numbers": failing}), name, layouts, buckets=2)
    kept = LaidOut(Warehouse(spark), name, layouts)
    assert rows(kept["numbers"]) == rows(good)
    again = lay_out(Warehouse(spark, frames={"numbers": spark.range(20)}), name, layouts, buckets=2)
    assert again["numbers"].count() == 20
    assert len(spark.sql(f"SHOW TABLES IN {name}").collect()) == 2 and len(list(Path(tmp_path, "stopped").iterdir())) == 1
