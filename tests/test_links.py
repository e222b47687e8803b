"""Same-day links and ordered neighbours, in ordinary and in sliced groups."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from visitflow.operators import ranges as ranges_of
from visitflow.operators.linking import link_next, link_previous
from visitflow.operators.ordered import (
    first_after,
    following,
    last_before,
    position,
    position_from_end,
    previous,
    tally,
    with_neighbours,
)

SCHEMA = "pat int, t timestamp_ntz, csn long, status int, dep int"
START = datetime(2024, 1, 1, 8)


def visits(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def one_day(spark, statuses, deps=None):
    deps = deps or [1] * len(statuses)
    return visits(
        spark,
        [
            (1, START + timedelta(minutes=i), i + 1, s, d)
            for i, (s, d) in enumerate(zip(statuses, deps, strict=True))
        ],
    )


def linked_previous(df):
    out = link_previous(df, ["pat"], ["t", "csn"], "status", {"link": F.col("csn")})
    return {r.csn: r.link for r in out.orderBy("csn").collect()}


def linked_next(df, target=(9,)):
    out = link_next(
        df, ["pat"], ["t", "csn"], "status", "dep", target, ~F.col("dep").isin(*target),
        {"link": F.col("csn")},
    )
    return {r.csn: r.link for r in out.orderBy("csn").collect()}


@pytest.mark.parametrize(
    "statuses, links",
    [
        ([2, 3, 4, 1], [None, 1, 1, 1]),
        ([2, 7, 1], [None, 1, 2]),  # unlisted status does not skip
        ([2, None, 1], [None, 1, 2]),
        ([3, 4, 1], [None, None, None]),
        ([3, 2, 1], [None, None, 2]),
    ],
)
def test_previous(spark, statuses, links):
    assert list(linked_previous(one_day(spark, statuses)).values()) == links


@pytest.mark.parametrize(
    "statuses, deps, links",
    [
        ([2, 3, 2], [1, 9, 9], [3, None, None]),
        ([2, 2, 2], [1, 9, 9], [2, None, None]),
        ([2, 3, 2, 1], [1, 9, 1, 9], [4, None, 4, None]),
        ([2, 3, 4], [1, 9, 9], [None, None, None]),
        ([2, 7, 2], [1, 9, 9], [None, None, None]),  # unlisted status breaks the link
        ([2, 2, 2], [1, 1, 9], [None, 3, None]),
    ],
)
def test_next(spark, statuses, deps, links):
    assert list(linked_next(one_day(spark, statuses, deps)).values()) == links


def test_tie_goes_to_lower_id(spark):
    df = visits(spark, [(1, START, 20, 2, 1), (1, START, 10, 2, 1)])
    assert linked_previous(df) == {10: None, 20: 10}


def test_carried_null_is_not_skipped(spark):
    df = one_day(spark, [2, 2, 2]).withColumn("room", F.when(F.col("csn") == 1, "r1"))
    out = link_previous(df, ["pat"], ["t", "csn"], "status", {"room_before": F.col("room")})
    assert {r.csn: r.room_before for r in out.collect()} == {1: None, 2: "r1", 3: None}


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for csn in range(1500):
        pat = 0 if rng.random() < 0.5 else rng.randrange(1, 40)
        # Few distinct times, so slices must also split ties; some keys and statuses are null.
        t = START + timedelta(minutes=rng.randrange(12))
        status = rng.choice([1, 2, 3, 3, 4, 4, 5, 6, 7, None])
        rows.append((pat if pat != 39 else None, t, csn, status, rng.choice([1, 2, 9])))
    return rows


def brute_previous(rows):
    links = {}
    for group in {r[0] for r in rows}:
        day = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2]))
        for i, row in enumerate(day):
            link = day[i - 1][2] if i else None
            if i and day[i - 1][3] in (3, 4, 5):
                active = [r[2] for r in day[:i] if r[3] in (1, 2, 6)]
                link = active[-1] if active else None
            links[row[2]] = link
    return links


def brute_next(rows, target=(9,)):
    links = {}
    for group in {r[0] for r in rows}:
        day = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2]))
        for i, row in enumerate(day):
            link = None
            if i + 1 < len(day) and row[4] not in target and day[i + 1][4] in target:
                if day[i + 1][3] in (1, 2, 3, 4, 5, 6):
                    later = [r[2] for r in day[i + 1 :] if r[4] in target and r[3] in (1, 2, 6)]
                    link = later[0] if later else None
            links[row[2]] = link
    return links


@pytest.fixture
def ranges(spark):
    """Sets the number of ranges that rows are dealt into."""
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, n)
    spark.conf.set(name, usual)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ranges_never_change_links(spark, ranges, seed, parts):
    ranges(parts)
    rows = random_rows(seed)
    df = visits(spark, rows)
    assert linked_previous(df) == brute_previous(rows)
    assert linked_next(df) == brute_next(rows)


def test_every_neighbour_kind_agrees(spark, ranges):
    df = visits(spark, random_rows(3))
    wanted = {
        "a": previous(F.col("status")),
        "b": following(F.col("status")),
        "c": last_before(F.when(F.col("dep") == 9, F.col("csn"))),
        "d": first_after(F.when(F.col("dep") == 9, F.col("csn"))),
        "e": position(),
        "f": position_from_end(),
    }
    found = []
    for parts in (1, 30):
        ranges(parts)
        found.append(with_neighbours(df, ["pat"], ["t", "csn"], wanted))
    assert found[0].columns == found[1].columns
    assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect()))


def test_one_group_is_spread_over_many_windows(spark, ranges):
    """One patient-day holds all rows, and still no window sees more than a few ranges' share."""
    ranges(10)
    df = visits(spark, [(0, START, csn, 2, 1) for csn in range(3000)])
    n = F.count(F.lit(1)).alias("n")
    cuts = ranges_of.borders(df, ["pat", "t", "csn"], 10)
    dealt = ranges_of.with_range(df, ["pat", "t", "csn"], cuts, "part").groupBy("part").agg(n)
    sizes = [r.n for r in dealt.collect()]
    assert len(sizes) >= 8 and max(sizes) < 900
    numbered = with_neighbours(df, ["pat"], ["t", "csn"], {"n": position()})
    assert sorted((r.csn, r.n) for r in numbered.collect()) == [(k, k + 1) for k in range(3000)]


@pytest.mark.parametrize("together", [2, 32])
def test_ranges_follow_the_order(spark, monkeypatch, together):
    """Nulls, ties and many borders; a row's range grows with its columns, and no range is much larger than others."""
    monkeypatch.setattr(ranges_of, "TOGETHER", together)
    rows = [r[:3] for r in random_rows(5)]
    df = spark.createDataFrame(rows, "pat int, t timestamp_ntz, csn long")
    cuts = ranges_of.borders(df, ["pat", "t", "csn"], 30)
    assert 20 <= len(cuts) <= 29
    found = ranges_of.with_range(df, ["pat", "t", "csn"], cuts, "part").sort("pat", "t", "csn").collect()
    parts = [r.part for r in found]
    assert parts == sorted(parts) and set(parts) == set(range(len(cuts) + 1))
    assert max(parts.count(p) for p in set(parts)) < 5 * len(rows) / 30
    assert ranges_of.borders(df.limit(0), ["pat"], 5) == [] and ranges_of.borders(df, ["pat"], 1) == []


def test_tally_counts_up_to_each_row(spark, ranges):
    rows = random_rows(6)
    wanted = {"n": tally(F.when(F.col("dep") == 9, 1))}
    for parts in (1, 25):
        ranges(parts)
        found = with_neighbours(visits(spark, rows), ["pat"], ["t", "csn"], wanted).collect()
        for r in found:
            mine = [x for x in rows if x[0] == r.pat and x[4] == 9 and (x[1], x[2]) <= (r.t, r.csn)]
            assert r.n == len(mine)


def test_no_job_beside_the_borders(spark):
    """Building the plan reads the ordered columns once and stores nothing."""
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup(None))
    linked = link_previous(visits(spark, random_rows(7)), ["pat"], ["t", "csn"], "status", {"link": F.col("csn")})
    assert len(status.getJobIdsForGroup(None)) - before <= 4
    assert "parquet" not in linked._jdf.queryExecution().optimizedPlan().toString()


def test_empty_input(spark):
    assert linked_previous(visits(spark, [])) == {}
