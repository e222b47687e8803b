"""Ordered lists: delimiters, nulls, escaping, width, and large groups."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from visitflow.operators.lists import (
    attach_lines,
    enumerate_distinct,
    enumerate_lines,
    measure_history,
)


def lines(spark, rows):
    return spark.createDataFrame(rows, "id long, line int, text string")


def folded(df, width=None, **options):
    out = enumerate_lines(df, ["id"], "line", "text", "items", width, **options)
    return {r.id: r["items"] for r in out.collect()}


def test_order_and_null_line(spark):
    df = lines(spark, [(1, 2, "b"), (1, 1, None), (1, 3, "c")])
    assert folded(df) == {1: "|b|c|"}
    assert folded(df, trailing=False) == {1: "|b|c"}
    assert folded(df, trailing=False, nulls="skip") == {1: "b|c"}


def test_only_null_lines(spark):
    df = lines(spark, [(1, 1, None), (1, 2, None)])
    assert folded(df) == {1: "||"}
    assert folded(df, trailing=False, nulls="skip") == {1: None}


def test_escaping(spark):
    df = lines(spark, [(1, 1, "a & b <c>")])
    assert folded(df) == {1: "a &amp; b &lt;c&gt;|"}
    assert folded(df, escape=False) == {1: "a & b <c>|"}


def test_repeated_line_keeps_greatest(spark):
    df = lines(spark, [(1, 1, "a"), (1, 1, "z"), (1, 2, "b")])
    assert folded(df) == {1: "z|b|"}


def test_parent_without_lines(spark):
    parents = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    kept = attach_lines(parents, lines(spark, [(1, 1, "a")]), "id")
    assert sorted((r.id, r.line, r.text) for r in kept.collect()) == [(1, 1, "a"), (2, None, None)]
    assert folded(kept) == {1: "a|", 2: "|"}


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("trailing", [True, False])
@pytest.mark.parametrize("width", [1, 2, 7, 50, 1200, None])
def test_clipped_list_equals_clip_of_whole_list(spark, width, trailing, unique):
    rng = random.Random(width or 0)
    rows, whole = [], {}
    for group in range(6):
        texts = [rng.choice([None, "", "a", "b  ", "<x&", "long " * 9]) for _ in range(60)]
        rows += [(group, i, t) for i, t in enumerate(texts)]
        items = [
            (t or "").replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") for t in texts
        ]
        whole[group] = "|".join(items) + ("|" if trailing else "")
    rng.shuffle(rows)
    got = folded(lines(spark, rows), width, trailing=trailing, unique_lines=unique)
    assert got == {g: text[:width] for g, text in whole.items()}


def test_long_list_is_whole_and_folded_by_slices(spark):
    """One parent with a third of all lines: the first level groups by slice, the text is whole."""
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.col("id").alias("line"),
        F.col("id").cast("string").alias("text"),
    )
    out = enumerate_lines(df, ["id"], "line", "text", "items", unique_lines=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "_slice" in plan
    assert folded(df.filter("id = 0"), unique_lines=True) == {
        0: "".join(f"{k}|" for k in range(0, 60_000, 3))
    }


@pytest.mark.parametrize("trailing", [True, False])
@pytest.mark.parametrize("width", [7, 1200, None])
@pytest.mark.parametrize("kind", ["int", "string", "string collate UTF8_LCASE"])
def test_huge_lists_are_the_same_lists(spark, kind, width, trailing):
    """Parents with many lines, the null key among them, are folded apart; each list is there once and whole."""
    df = spark.range(0, 6_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, None)
        .when(F.col("id") % 3 == 1, F.lit("10"))
        .otherwise(F.col("id").cast("string"))
        .cast(kind)
        .alias("id"),
        F.col("id").cast("int").alias("line"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("<"), "id")).alias("text"),
    )
    out = enumerate_lines(df, ["id"], "line", "text", "items", width, trailing=trailing, huge=True)
    got = [(r.id, r["items"]) for r in out.collect()]
    assert len(got) == len({k for k, _ in got}) == 2 + 2_000 and dict(got) == folded(df, width, trailing=trailing)
    assert out._jdf.queryExecution().analyzed().toString().count("Union") == (kind in ("int", "string"))


def test_huge_lists_of_keys_that_differ_in_case(spark):
    """Keys that a collation takes for one have different hashes and must not be folded apart."""
    df = spark.range(0, 3_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "A").otherwise("a").cast("string collate UTF8_LCASE").alias("id"),
        F.col("id").cast("int").alias("line"),
        F.col("id").cast("string").alias("text"),
    )
    out = enumerate_lines(df, ["id"], "line", "text", "items", huge=True)
    assert [r["items"] for r in out.collect()] == ["".join(f"{k}|" for k in range(3_000))]


#: A list of 96 MB and 10,000 short ones, from lines to a Parquet file.
BUSY_PARENT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
import __spark_entry__
conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1",
        "spark.sql.shuffle.partitions": "8", "spark.local.dir": f"{sys.argv[2]}/local"}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
times = F.when(F.col("id") % 3 == 0, F.lit(300)).otherwise(F.lit(32))
docs = spark.range(0, 15_000, 1, 8).select(
    F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), times).alias("text"))
docs.write.parquet(f"{sys.argv[2]}/documents.parquet")
lists = __spark_entry__.queries()["list_lines_busy_parent"](spark, sys.argv[2])
lists.write.parquet(f"{sys.argv[2]}/lists")
found = spark.read.parquet(f"{sys.argv[2]}/lists").agg(F.count("*"), F.max(F.octet_length("items"))).first()
print("FOUND", *found)
"""


def test_long_list_is_written_in_a_small_heap(tmp_path):
    """The heap is about ten times the list; copies of a list at every step needed more."""
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 1g pyspark-shell", "PYSPARK_PYTHON": sys.executable}
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-B", "-c", BUSY_PARENT, repo, str(tmp_path)], env=env, capture_output=True, text=True, timeout=240)
    assert f"FOUND 10001 {5_000 * (300 * 64 + 1)}" in done.stdout, done.stderr[-3000:]


def test_lists_leave_session_settings_alone(spark):
    before = dict(spark.sparkContext.getConf().getAll()) | {
        r.key: r.value for r in spark.sql("SET").collect()
    }
    folded(lines(spark, [(1, 1, "a")]), 2000)
    assert before == dict(spark.sparkContext.getConf().getAll()) | {
        r.key: r.value for r in spark.sql("SET").collect()
    }


def test_distinct_list(spark):
    df = spark.createDataFrame(
        [(1, 7, "b"), (1, 7, "b"), (1, 3, "z"), (1, None, None)], "id int, plan int, name string"
    )
    out = enumerate_distinct(df, ["id"], ["plan"], "name", "items")
    assert out.first()["items"] == "|z|b|"


def test_parallel_lists(spark):
    df = spark.createDataFrame(
        [
            (1, "room", "2024-01-01 09:00:10", "R1"),
            (1, "room", "2024-01-01 08:00:20", None),
            (1, "room", "2024-01-01 08:00:20", "B"),
            (1, "track", "2024-01-01 07:00:00", "T"),
            (2, "other", "2024-01-01 07:00:00", "x"),
        ],
        "id int, m string, t string, v string",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    names = {"room": ("rooms", "room_times"), "track": ("tracks", "track_times")}
    out = measure_history(df, ["id"], "t", "v", "m", names)
    got = {r.id: r.asDict() for r in out.collect()}
    # The greatest of several values at one time counts; a missing one competes as NA.
    assert got[1]["rooms"] == "NA|R1"
    assert got[1]["room_times"] == "2024-01-01 08:00|2024-01-01 09:00"
    assert (got[1]["tracks"], got[1]["track_times"]) == ("T", "2024-01-01 07:00")
    assert got[2]["rooms"] is None and got[2]["tracks"] is None
