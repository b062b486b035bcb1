"""Small constant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def fixed_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A constant table inside the plan: no Python worker and no job is needed to read it."""

    def literal(value) -> str:
        return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else f"{value!r}D"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
