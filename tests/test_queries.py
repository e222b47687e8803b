"""Every registered query against its SQL twin, and the shape of its plan."""

import duckdb
import pytest
from conftest import TEST_DATA

import __spark_entry__ as entry_point
from fixtures import registry
from fixtures.views import RAW, VIEWS, TestWarehouse, oracle

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
# The only results with one global order.
ORDERED = {
    "sort_rows", "top_rows", "event_notes", "provider_notes", "timestamp_review", "plan_check",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in RAW:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{TEST_DATA}/{table}.parquet'"
        )
    return connection


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([columns[i] for i in order]), sorted(
        tuple(repr(row[i]) for i in order) for row in rows
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, TEST_DATA)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "EvalPython", "InPandas"):
        assert node not in plan
    if name not in ORDERED:
        assert "SinglePartition" not in plan.replace("IdentityBroadcastMode", "")
    got = normalised(result.columns, result.collect())
    cursor = duck.execute(ORACLES[name])
    assert got == normalised([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_derived_table_is_the_same_on_both_engines(spark, duck, name):
    frame = TestWarehouse(spark, TEST_DATA)[name]
    cursor = duck.execute(oracle(f"SELECT * FROM {name}"))
    columns = [c[0] for c in cursor.description]
    assert normalised(frame.columns, frame.collect()) == normalised(columns, cursor.fetchall())


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
