"""Query registry shared by the driver contract, the tests and the benchmark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan and, where plain SQL can express it, its check."""

    def wrap(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
