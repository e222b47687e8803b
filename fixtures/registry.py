"""Registered queries: a Spark callable and, where SQL can express it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from fixtures.views import TestWarehouse, oracle

# Scope and run used by the registered queries; parameters in production.
RUN_DATE = date(2024, 1, 2)
BOARD_RUN_DATE = date(2024, 1, 4)
LOAD_TS = datetime(2024, 1, 2, 6, 30, 40)
INFUSION_UNITS = (0, 1, 2, 3, 4)
CLINICS = (5, 6, 7, 8, 9)
CLINIC_PROVIDERS = (3,)
BOARD_CLINICS = (5, 6, 7, 8, 9, 10, 11)
ELEMENT = "FLOW#1"

_BUILDERS: dict[str, Callable[[TestWarehouse], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name; `sql` may mention any raw or derived table."""

    def register(build: Callable[[TestWarehouse], DataFrame]):
        if name in _BUILDERS:
            raise ValueError(f"query {name} is registered twice")
        _BUILDERS[name] = build
        if sql is not None:
            _SQL[name] = oracle(sql)
        return build

    return register


_OPEN: dict[tuple[str, str], TestWarehouse] = {}


def _warehouse(spark: SparkSession, sf_dir: str) -> TestWarehouse:
    """One set of table definitions per application and folder; no data is kept."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN or _OPEN[key].spark is not spark:
        _OPEN[key] = TestWarehouse(spark, sf_dir)
    return _OPEN[key]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, sf_dir: build(_warehouse(spark, sf_dir))

    return {name: runner(build) for name, build in _BUILDERS.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
