"""Contracts, key checks, loading and flat files."""

import csv
import shutil
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitflow.operators.checks import KeyViolation, assert_unique, duplicate_keys
from visitflow.session import shared_dir, stored
from visitflow.sources import commits, contracts, load
from visitflow.sources.staging import inline, resumable, verified, written
from visitflow.sources.warehouse import Warehouse


def test_contract_sizes():
    assert len(contracts.infusion().columns) == 30
    assert len(contracts.clinics().columns) == 37
    assert len(contracts.clinics(with_private=False).columns) == 35
    assert len(contracts.status_board().columns) == 23
    assert contracts.infusion().key == ("Appointment ID",)
    assert contracts.clinics().key == ("PAT_ENC_CSN_ID_unhashed",)
    assert contracts.status_board().key == ()


def test_site_headings():
    names = contracts.clinics("XYZ").names
    assert "XYZ AMB VITALS SIMPLE" in names and "T XYZ AMB PATIENT UNDERSTANDING AVS" in names


def rows_for(spark, contract, **values):
    """One row of nulls but for the given values, per list entry."""
    size = len(next(iter(values.values())))
    df = spark.range(size).coalesce(1)
    out = []
    for column in contract.columns:
        given = values.get(column.name.replace(" ", "_"), [None] * size)
        cell = F.lit(None)
        for i, item in enumerate(given):
            cell = F.when(F.col("id") == i, F.lit(item)).otherwise(cell)
        out.append(cell.cast(column.type).alias(column.name))
    return df.select(*out)


def test_conform_types_and_order(spark):
    contract = contracts.infusion()
    df = rows_for(spark, contract, Appointment_ID=[1], Load_Dte=["2024-01-01 06:30:40"])
    out = load.conform(df.select(*[f"`{c}`" for c in reversed(df.columns)]), contract)
    assert [(f.name, f.dataType) for f in out.schema] == [
        (c.name, c.type) for c in contract.columns
    ]
    assert out.first()["Load_Dte"] == datetime(2024, 1, 1, 6, 31)


def test_too_wide_text_fails(spark):
    contract = contracts.infusion()
    df = rows_for(spark, contract, Appointment_ID=[1], Visit_Type=["x" * 51])
    with pytest.raises(Exception, match="text exceeds 50 in Visit Type"):
        load.conform(df, contract).collect()


def test_missing_required_value_fails(spark):
    contract = contracts.status_board()
    df = rows_for(spark, contract, PAT_ENC_CSN_ID=["h"])
    with pytest.raises(Exception, match="null in required PAT_ENC_CSN_ID_unhashed"):
        load.conform(df, contract).collect()


def test_unique_check(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1)], "a int, b int")
    assert duplicate_keys(df, ["a", "b"]).count() == 1
    with pytest.raises(KeyViolation):
        assert_unique(df, ["a", "b"])
    with pytest.raises(KeyViolation):
        assert_unique(df, ["a"])
    assert assert_unique(df.distinct(), ["a", "b"]).count() == 2


def test_append_and_reload(spark, tmp_path):
    contract, path = contracts.infusion(), str(tmp_path / "sink")
    first = rows_for(spark, contract, Appointment_ID=[1, 2])
    load.append(first, contract, path)
    load.append(rows_for(spark, contract, Appointment_ID=[3]), contract, path)
    assert spark.read.parquet(path).count() == 3
    load.reload(first, contract, path)
    assert spark.read.parquet(path).count() == 2


def test_repeated_key_is_not_loaded(spark, tmp_path):
    contract, path = contracts.infusion(), tmp_path / "sink"
    with pytest.raises(KeyViolation):
        load.append(rows_for(spark, contract, Appointment_ID=[1, 1]), contract, str(path))
    assert not path.exists()


def test_table_is_recreated_and_loaded(spark):
    contract = contracts.status_board()
    load.create_table(spark, contract, "board_sink")
    row = rows_for(spark, contract, PAT_ENC_CSN_ID_unhashed=[1], PAT_ENC_CSN_ID=["h"])
    load.append_table(row, contract, "board_sink")
    load.append_table(row, contract, "board_sink")
    assert spark.table("board_sink").count() == 2
    load.create_table(spark, contract, "board_sink")
    assert spark.table("board_sink").count() == 0


def test_flat_file_hides_private_column(spark, tmp_path):
    contract = contracts.status_board()
    df = rows_for(
        spark, contract, PAT_ENC_CSN_ID_unhashed=[7], PAT_ENC_CSN_ID=["HASH"], APPT_LENGTH=[15],
        APPT_DTTM=["2024-01-01 09:00:00"], APPT_NOTES=['"a^b|"'],
    )
    flat = load.flat_file(df, contract)
    assert "PAT_ENC_CSN_ID_unhashed" not in flat.columns
    assert all(f.dataType.typeName() == "string" for f in flat.schema)
    row = flat.first()
    assert (row.APPT_LENGTH, row.APPT_DTTM, row.EVENT_DTTM) == ("15", "2024-01-01 09:00:00", "")
    load.write_flat_file(flat, str(tmp_path / "flat"), ["DEPARTMENT_NAME", "APPT_DTTM"])
    text = "".join(p.read_text() for p in (tmp_path / "flat").glob("part-*"))
    assert text.startswith("PAT_ENC_CSN_ID,PAT_MRN_ID") and '"a^b|"' in text


def test_flat_file_can_be_read_by_another_program(spark, tmp_path):
    values = ["SMITH, JOHN", 'say "no"', "two\r\nlines", '"a, b|"', '"in "it" |"', "plain", "", '"', None]
    rows = [(f"{k % 5}", f"{k:02d}", v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "grp string, k string, v string").repartition(4)
    load.write_flat_file(df, str(tmp_path / "flat"), ["grp", "k"])
    parts = sorted((tmp_path / "flat").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert "\0" not in text and text.count("\n") == len(values) + 1
    back = list(csv.reader(text.splitlines()))
    expected = {"two\r\nlines": "two lines", '"a, b|"': "a, b|", '"in "it" |"': 'in "it" |', None: ""}
    assert back[0] == ["grp", "k", "v"]
    assert back[1:] == [[g, k, expected.get(v, v)] for g, k, v in sorted(rows, key=lambda r: r[:2])]


def test_stored_key_refuses_a_second_load(spark, tmp_path):
    contract, path = contracts.infusion(), tmp_path / "sink"
    load.append(rows_for(spark, contract, Appointment_ID=[1, 2]), contract, str(path))
    before = sorted(p.name for p in path.iterdir())
    with pytest.raises(KeyViolation, match="already stored"):
        load.append(rows_for(spark, contract, Appointment_ID=[2, 3]), contract, str(path))
    assert sorted(p.name for p in path.iterdir()) == before
    assert [p.name for p in tmp_path.iterdir()] == ["sink"]  # no staged copy is left
    outside = F.col("`Appointment ID`") > 5
    load.append(rows_for(spark, contract, Appointment_ID=[2]), contract, str(path), within=outside)
    assert spark.read.parquet(str(path)).count() == 3


def test_table_refuses_stored_keys(spark):
    contract = contracts.infusion()
    load.create_table(spark, contract, "infusion_sink")
    row = rows_for(spark, contract, Appointment_ID=[1])
    load.append_table(row, contract, "infusion_sink")
    with pytest.raises(KeyViolation):
        load.append_table(row, contract, "infusion_sink")
    assert spark.table("infusion_sink").count() == 1


def test_stages(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    stage = written(str(tmp_path), "extract")
    kept = stage("pairs", df)
    assert kept.count() == 2 and len(list(tmp_path.glob("extract-*/pairs.parquet"))) == 1
    with pytest.raises(Exception, match="already exists"):
        stage("pairs", df)
    with pytest.raises(KeyViolation):
        verified({"pairs": ("k",)}, inline)("pairs", df)
    assert verified({"other": ("k",)}, inline)("pairs", df) is df


def test_a_stopped_run_resumes(spark, tmp_path):
    """Finished stages are read again, unless what they were made from has changed; success leaves nothing."""
    source, runs = str(tmp_path / "T.parquet"), tmp_path / "runs"
    spark.range(5).write.parquet(source)
    made = []

    def extract(stage, fail):
        def kept(name, df):
            path = list(runs.glob(f"*/{name}.parquet"))
            before = sorted(p.stat().st_mtime_ns for p in path[0].glob("part-*")) if path else None
            out = stage(name, df)
            after = sorted(p.stat().st_mtime_ns for p in next(runs.glob(f"*/{name}.parquet")).glob("part-*"))
            made.append((name, before != after))
            return out

        one = kept("one", spark.read.parquet(source).filter("id > 1"))
        two = kept("two", one.groupBy().count())
        if fail:
            raise Stopped
        return stored(kept("three", two.union(one.groupBy().count())), "helper").collect()

    def run(day, fail=False):
        made.clear()
        with resumable(spark, str(runs), "extract", {"day": day}) as stage:
            return extract(stage, fail)

    shared = set(Path(shared_dir(spark)).iterdir())
    with pytest.raises(Stopped):
        run(1, fail=True)
    assert made == [("one", True), ("two", True)] and len(list(runs.iterdir())) == 1
    with pytest.raises(Stopped):
        run(2, fail=True)  # another day's run keeps its stages apart
    assert made == [("one", True), ("two", True)] and len(list(runs.iterdir())) == 2
    assert [r[0] for r in run(1)] == [3, 3]
    assert made == [("one", False), ("two", False), ("three", True)] and len(list(runs.iterdir())) == 1
    spark.range(9, 11).write.mode("append").parquet(source)
    assert [r[0] for r in run(2)] == [5, 5]
    assert made == [("one", True), ("two", True), ("three", True)] and list(runs.iterdir()) == []
    assert set(Path(shared_dir(spark)).iterdir()) == shared  # nor does what was stored on the way stay


def test_warehouse_sources(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "T.parquet"))
    assert Warehouse(spark, folder=str(tmp_path))["T"].count() == 3
    spark.sql("CREATE DATABASE IF NOT EXISTS src")
    spark.range(4).write.mode("overwrite").saveAsTable("src.T")
    assert Warehouse(spark, schema="src")["T"].count() == 4
    assert Warehouse(spark, frames={"T": spark.range(5)})["T"].count() == 5
    with pytest.raises(KeyError):
        Warehouse(spark)["T"]


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


# --- The commit log -------------------------------------------------------------------------------

VISITS = contracts.Contract(
    "visits",
    (
        contracts.SinkColumn("id", T.LongType(), required=True),
        contracts.SinkColumn("at", T.TimestampNTZType()),
        contracts.SinkColumn("note", T.StringType(), 20),
    ),
    key=("id",),
)


def visits(spark, *rows):
    """Rows (id, day of January 2024 or None, note)."""
    data = [(i, None if d is None else datetime(2024, 1, d, 9), n) for i, d, n in rows]
    return spark.createDataFrame(data, "id long, at timestamp_ntz, note string")


def held(spark, path, **days):
    return sorted((r.id, r["at"] and r["at"].day, r.note) for r in load.rows(spark, VISITS, path, **days).collect())


class Stopped(Exception):
    """The process ended here."""


def stop_after(monkeypatch, n):
    """File operations that change something fail from the n-th on, as if the process had been killed."""
    done = [0]
    for name in ("make", "move", "delete", "write"):
        plain = getattr(commits.Files, name)

        def step(self, *args, _plain=plain):
            done[0] += 1
            if done[0] > n:
                raise Stopped
            return _plain(self, *args)

        monkeypatch.setattr(commits.Files, name, step)


def _append(spark, path):
    load.append(visits(spark, (4, 3, "d"), (5, None, "e")), VISITS, path)


def _reload(spark, path):
    load.reload(visits(spark, (1, 1, "x"), (9, 2, "y")), VISITS, path)


def _refresh(spark, path):
    moved = visits(spark, (2, 2, "moved in"), (3, 3, "stays"), (7, 3, "new"))
    load.refresh(moved, VISITS, path, "at", date(2024, 1, 2), date(2024, 1, 3))


FIRST = [(1, 1, "a"), (2, 1, "b"), (3, 2, "c")]
AFTER = {
    _append: [*FIRST, (4, 3, "d"), (5, None, "e")],
    _reload: [(1, 1, "x"), (9, 2, "y")],
    _refresh: [(1, 1, "a"), (2, 2, "moved in"), (3, 3, "stays"), (7, 3, "new")],
}


def by_day(spark, path):
    load.refresh(visits(spark, *FIRST), VISITS, path, "at", date(2024, 1, 1), date(2024, 1, 4))


def flat(spark, path):
    load.append(visits(spark, *FIRST), VISITS, path)


@pytest.mark.parametrize("begin, change", [(flat, _append), (flat, _reload), (by_day, _append), (by_day, _refresh)])
def test_a_stopped_load_leaves_the_old_or_the_new_rows(spark, tmp_path, monkeypatch, begin, change):
    outcomes, n = [], 0
    begin(spark, str(tmp_path / "first"))
    while True:
        path = str(tmp_path / f"sink{n}")
        shutil.copytree(tmp_path / "first", path)
        with monkeypatch.context() as m:
            stop_after(m, n)
            try:
                change(spark, path)
                ended = True
            except Stopped:
                ended = False
        rows = held(spark, path)
        assert rows in (FIRST, AFTER[change]), n
        outcomes.append(rows == AFTER[change])
        load.vacuum(spark, path)
        assert held(spark, path) == rows
        if not outcomes[-1] and n % 3 == 1:  # what was left behind is no obstacle
            change(spark, path)
            assert held(spark, path) == AFTER[change]
        if ended:
            break
        n += 1
    assert n >= 4 and not outcomes[0] and outcomes[-1] and outcomes == sorted(outcomes)


def test_two_loads_of_one_version_do_not_both_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sink")
    flat(spark, path)
    plain = commits.Log.move_in

    def overtaken(self, *args):
        monkeypatch.setattr(commits.Log, "move_in", plain)
        load.append(visits(spark, (8, 1, "faster")), VISITS, path)
        return plain(self, *args)

    monkeypatch.setattr(commits.Log, "move_in", overtaken)
    with pytest.raises(commits.ConcurrentLoad):
        _append(spark, path)
    expected = [*FIRST, (8, 1, "faster")]
    assert held(spark, path) == expected
    assert spark.read.parquet(path).count() == 4  # the slower load's files are gone


def test_a_folder_without_log_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "sink")
    load.conform(visits(spark, *FIRST), VISITS).write.parquet(path)
    assert held(spark, path) == FIRST
    with pytest.raises(KeyViolation, match="already stored"):
        load.append(visits(spark, (2, 5, "again")), VISITS, path)
    _append(spark, path)
    assert held(spark, path) == AFTER[_append]
    with pytest.raises(KeyViolation, match="already stored"):
        load.append(visits(spark, (2, 5, "again")), VISITS, path)


def test_refreshed_days(spark, tmp_path):
    path = str(tmp_path / "sink")
    days = {"first": date(2024, 1, 2), "last": date(2024, 1, 3)}
    start = [(k, 1 + k % 4, "old") for k in range(20)]
    load.refresh(visits(spark, *start), VISITS, path, "at", date(2024, 1, 1), date(2024, 1, 4))
    load.append(visits(spark, (50, None, "no day")), VISITS, path)

    def files():
        return {f.path: f.day for f in commits.Log(spark, path).newest().files}

    before = files()
    # 4 (day 1) and 50 (no day) move in; 1 and 5 (day 2) are cancelled; 9 moves within the window
    now = [(4, 2, "new"), (50, 3, "new"), (9, 3, "new"), *[(k, 1 + k % 4, "new") for k in (2, 6, 10, 13, 14, 17, 18)]]
    load.refresh(visits(spark, *now), VISITS, path, "at", **days)
    stay = [r for r in start if r[1] not in (2, 3) and r[0] not in {n[0] for n in now}]
    assert held(spark, path) == sorted(stay + now)
    assert held(spark, path, **days) == sorted(r for r in stay + now if r[1] in (2, 3))
    kept = {p for p, d in before.items() if d == "2024-01-04"}
    assert kept and kept <= set(files()) and not (set(before) - kept) & set(files())
    assert held(spark, path, first=date(2024, 1, 4), last=date(2024, 1, 4)) == [r for r in start if r[1] == 4]
    # what left the sink is out of the index, what moved is in it
    asked = visits(spark, (1, 1, ""), (5, 1, ""), (4, 1, ""), (50, 1, ""), (3, 1, ""), (99, 1, ""))
    assert sorted(r.id for r in load.keys_stored(spark, VISITS, path, asked).collect()) == [3, 4, 50]
    load.append(visits(spark, (1, 2, "again")), VISITS, path)
    with pytest.raises(KeyViolation, match="already stored"):
        load.append(visits(spark, (4, 1, "twice")), VISITS, path)
    with pytest.raises(ValueError, match="2024-01-04 is not between"):
        load.refresh(visits(spark, (60, 4, "outside")), VISITS, path, "at", **days)
    with pytest.raises(ValueError, match="laid out by at"):
        load.refresh(visits(spark), VISITS, path, "id", **days)
    load.refresh(visits(spark), VISITS, path, "at", **days)
    assert held(spark, path) == sorted(stay)


def test_an_append_reads_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "sink")
    load.append(visits(spark, *[(k, 1 + k % 9, "old") for k in range(2000)]), VISITS, path)
    new = visits(spark, (5000, 1, ""), (5001, 2, ""), (5002, 2, ""))
    now = commits.Log(spark, path).newest()
    assert len({k.bucket for k in now.keys}) == load.BUCKETS
    wanted = {r[0] for r in new.select(load._bucket(VISITS)).collect()}
    read = load.keys_stored(spark, VISITS, path, new).inputFiles()
    index = [f for f in read if commits.KEYS in f]
    assert {int(commits.partition_value(f, "_bucket")) for f in index} == wanted
    assert not [f for f in read if path in f and commits.KEYS not in f]  # no data file is read
    both = visits(spark, (5000, 1, ""), (7, 2, ""))
    assert [r.id for r in load.keys_stored(spark, VISITS, path, both).collect()] == [7]


def test_vacuum_keeps_what_counts(spark, tmp_path):
    path = tmp_path / "sink"
    by_day(spark, str(path))
    _refresh(spark, str(path))
    (path / "part-stray.parquet").write_text("left by a stopped load")
    load.vacuum(spark, str(path))
    assert not (path / "part-stray.parquet").exists()
    assert [p.name for p in (path / "_log").glob("*.json")] == [f"{2:020d}.json"]
    assert held(spark, str(path)) == AFTER[_refresh]
