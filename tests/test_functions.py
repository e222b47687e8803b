"""Scalar rules, on the edge values where they differ from the obvious Spark function."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from visitflow.functions import labels
from visitflow.functions import text as tx
from visitflow.functions.durations import cycle_time, earliest_after, time_in_room, time_to_room
from visitflow.functions.stamps import (
    minutes_between,
    report_window,
    report_window_columns,
    round_to_minute,
    round_to_second,
    stamp_text,
)
from visitflow.operators.cohort import in_window


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, rounded",
    [
        ("2024-01-01 10:00:29.997", datetime(2024, 1, 1, 10, 0)),
        ("2024-01-01 10:00:30", datetime(2024, 1, 1, 10, 1)),
        ("2024-01-01 23:59:59", datetime(2024, 1, 2)),
        ("2024-03-10 02:29:31", datetime(2024, 3, 10, 2, 30)),  # inside a daylight-saving gap
    ],
)
def test_minute_rounding(spark, text, rounded):
    assert value(spark, round_to_minute(at(text))) == rounded


def test_second_rounding(spark):
    assert value(spark, round_to_second(at("2024-01-01 10:00:00.499"))) == datetime(2024, 1, 1, 10)
    assert value(spark, round_to_second(at("2024-01-01 10:00:00.5"))).second == 1


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2024-01-01 10:00:59", "2024-01-01 10:01:01", 1),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0),
        ("2024-01-01 10:05:00", "2024-01-01 10:00:59", -5),
        ("2024-03-10 01:59:31", "2024-03-10 03:10:00", 71),  # across a daylight-saving change
        ("2024-01-01 23:59:59", "2024-01-03 00:00:00", 1441),
    ],
)
def test_minute_boundaries(spark, start, end, minutes):
    assert value(spark, minutes_between(at(start), at(end))) == minutes


def test_window_defaults():
    run = date(2024, 1, 31)
    assert report_window(run, 1, 2) == (datetime(2024, 1, 30), datetime(2024, 4, 1))
    assert report_window(run, 3, 6) == (datetime(2024, 1, 28), datetime(2024, 8, 1))
    assert report_window(run, 3) == (datetime(2024, 1, 28), datetime(2024, 2, 1))
    assert report_window(date(2023, 12, 5), 1, 2)[1] == datetime(2024, 3, 1)


def test_window_overrides():
    start, end = datetime(2021, 7, 1), datetime(2021, 7, 2, 12)
    assert report_window(date(2024, 1, 1), 1, 2, start=start) == (start, datetime(2024, 4, 1))
    assert report_window(date(2024, 1, 1), 1, 2, end=end) == (datetime(2023, 12, 31), end)


def test_window_columns_agree(spark):
    for day in (date(2024, 1, 31), date(2023, 12, 5), date(2024, 2, 29)):
        for back, months in ((1, 2), (3, 6), (3, None)):
            bounds = report_window_columns(F.lit(day), back, months)
            got = spark.range(1).select(bounds[0].alias("s"), bounds[1].alias("e")).first()
            assert tuple(got) == report_window(day, back, months)


def test_window_end_takes_next_midnight_only(spark):
    _, end = report_window(date(2024, 1, 4), 3)
    times = spark.createDataFrame(
        [("2024-01-05 00:00:00",), ("2024-01-05 00:01:00",)], ["t"]
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    kept = times.filter(in_window("t", datetime(2024, 1, 1), end)).collect()
    assert [r.t for r in kept] == [datetime(2024, 1, 5)]


@pytest.mark.parametrize(
    "style, text",
    [
        ("stamp", "2024-03-09 14:05:07"),
        ("minute", "2024-03-09 14:05"),
        ("us_date", "03/09/2024"),
        ("clock", "14:05:07"),
    ],
)
def test_stamp_styles(spark, style, text):
    assert value(spark, stamp_text(at("2024-03-09 14:05:07.25"), style)) == text
    missing = F.lit(None).cast("timestamp_ntz")
    assert value(spark, stamp_text(missing, style)) == ""
    assert value(spark, stamp_text(missing, style, blank=False)) is None


def test_sanitize(spark):
    assert value(spark, tx.sanitize_list(F.lit("Doe, J|"), 1200)) == "Doe^ J"
    assert value(spark, tx.sanitize_list(F.lit(None).cast("string"), 1200)) == ""
    assert value(spark, tx.sanitize_list(F.lit("a,b"), 1200, strip_last=False)) == "a^b"
    assert value(spark, tx.sanitize_list(F.lit("abcdef|"), 3)) == "abc"


def test_quote_and_clip(spark):
    missing = F.lit(None).cast("string")
    assert value(spark, tx.quote_list(F.lit("a|b|  "), 1000)) == '"a|b|"'
    assert value(spark, tx.quote_list(F.lit("abcdef"), 4)) == '"abc'
    assert value(spark, tx.quote_list(missing, 1000)) == "|"
    assert value(spark, tx.clip_list(F.lit("abc   "), 2)) == "ab"
    assert value(spark, tx.clip_list(missing, 2)) == "|"


@pytest.mark.parametrize("text, kept", [("a", True), ("  ", False), ("", False), (None, None)])
def test_non_empty(spark, text, kept):
    assert value(spark, tx.non_empty(F.lit(text).cast("string"))) is kept


def test_pseudonym(spark):
    expected = hashlib.sha256(b"1234567890").hexdigest().upper()
    assert value(spark, tx.pseudonym(F.lit("123456789012"), 10)) == expected
    assert value(spark, tx.pseudonym(F.lit(1234567890), 18)) == expected
    assert value(spark, tx.pseudonym(F.lit(None).cast("string"), 10)) == ""


def test_escape(spark):
    assert value(spark, tx.escape_markup(F.lit("a & b <c>\r"))) == "a &amp; b &lt;c&gt;&#x0D;"


def test_status_labels(spark):
    got = [value(spark, labels.status_label(F.lit(c))) for c in range(1, 8)]
    assert got == ["sch", "comp", "canc", "no show", "left", "arrived", None]


@pytest.mark.parametrize(
    "due, name, label",
    [
        (None, "Taken", "Taken: "),
        (None, "Missed", "Missed: "),
        (None, "New Bag", "New Bag"),
        (None, None, None),
        (1, "Taken", "Due"),
        (2, "Taken", None),
    ],
)
def test_administration_status(spark, due, name, label):
    column = labels.administration_status(
        F.lit(due).cast("int"), F.lit(name).cast("string")
    )
    assert value(spark, column) == label


@pytest.mark.parametrize(
    "user, emp, name, label",
    [
        (None, None, None, ""),
        ("7", None, None, "Unknown: 7"),
        ("7", "7", None, "No Name: 7"),
        ("7", "7", "Ann", "Ann - 7"),
    ],
)
def test_user_label(spark, user, emp, name, label):
    columns = [F.lit(v).cast("string") for v in (user, emp, name)]
    assert value(spark, labels.user_label(*columns)) == label


def test_face_to_face(spark):
    got = [value(spark, labels.face_to_face(F.lit(c).cast("string"))) for c in ("50", "70", None)]
    assert got == [1, 0, 0]


def test_canonical_code(spark):
    column = labels.canonical_code(F.lit("31010"), ["31010", "31000"], "2100300004")
    assert value(spark, column) == "2100300004"


def day(text):
    return at(f"2024-01-01 {text}") if text else F.lit(None).cast("timestamp_ntz")


def test_roomed(spark):
    early = earliest_after(day("10:00"), day("09:50"), day("09:59"), day(None))
    assert value(spark, early) is None
    assert value(spark, time_to_room(day("10:00"), day("09:50"), day(None))) is None
    late = time_to_room(day("10:00"), day("09:50"), day("10:20"), day("10:10"))
    assert value(spark, late) == 10


@pytest.mark.parametrize(
    "roomed, end, out, minutes",
    [
        ("10:10", "10:50", "10:40", 30),
        ("10:10", "10:30", "10:40", 20),
        ("10:10", None, "10:40", 30),
        ("10:10", "10:30", None, 20),
        ("10:10", "10:00", "10:40", None),  # visit end before rooming and before checkout
        (None, "10:30", "10:40", None),
    ],
)
def test_time_in_room(spark, roomed, end, out, minutes):
    assert value(spark, time_in_room(day(roomed), day(end), day(out))) == minutes


@pytest.mark.parametrize(
    "end, out, minutes",
    [
        ("10:50", "09:50", 50),  # checkout before check-in
        ("10:50", "10:40", 40),
        ("10:30", "10:40", 30),
        ("09:50", "10:40", 40),
        ("09:50", "09:55", None),
        (None, None, None),
    ],
)
def test_cycle_time(spark, end, out, minutes):
    assert value(spark, cycle_time(day("10:00"), day(end), day(out))) == minutes
