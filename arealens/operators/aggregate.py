"""Weighted category counts per area and period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.constants import (
    ANNUAL_COLUMNS,
    AREA,
    CATEGORIES,
    COUNT_COLUMNS,
    MONTHLY_COLUMNS,
    POPULATION,
    RATE_MULTIPLIER,
    YEAR,
    count_col,
    rate_col,
)
from arealens.functions.rates import safe_rate
from arealens.functions.text import number_column

WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def count_by_group(
    incidents: DataFrame, keys: list[str], category: str = "offense_group", weight: str | None = "incident_count"
) -> DataFrame:
    """Seven category counts and their total per key in one map-side-combined aggregation.

    Rows with a NULL key are dropped, a NULL category counts as unknown, a NULL weight as 1.
    """
    n = F.lit(1).cast("long")
    if weight and weight in incidents.columns:
        kind = dict(incidents.dtypes)[weight]
        whole = F.col(weight).cast("long") if kind in WHOLE_TYPES else number_column(incidents, weight).try_cast("long")
        n = F.coalesce(whole, n)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = incidents.where(present).select(
        *keys, F.coalesce(F.col(category), F.lit("unknown")).alias("_category"), n.alias("_n")
    )
    per_category = keyed.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("_category") == c, F.col("_n")).otherwise(F.lit(0))).alias(count_col(c)) for c in CATEGORIES]
    )
    total = reduce(lambda a, b: a + b, [F.col(count_col(c)) for c in CATEGORIES])
    return per_category.withColumn(count_col("total"), total).select(*keys, *COUNT_COLUMNS)


def add_rates(df: DataFrame, multiplier: float = RATE_MULTIPLIER, population: str = POPULATION) -> DataFrame:
    """Total and category rates against any population column."""
    return df.withColumns(
        {
            rate_col(base): safe_rate(F.col(count_col(base)), F.col(population), multiplier)
            for base in ["total", *CATEGORIES]
        }
    )


def _universe(population: DataFrame, counted: DataFrame, include_population_only: bool) -> DataFrame:
    known = population.select(AREA, YEAR, POPULATION).distinct()
    areas = counted.select(AREA, YEAR).distinct()
    if include_population_only:
        areas = areas.unionByName(known.select(AREA, YEAR)).distinct()
    return areas.join(known, [AREA, YEAR], "left")


def _filled(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in COUNT_COLUMNS})


def annual_aggregates(
    incidents: DataFrame,
    population: DataFrame,
    multiplier: float = RATE_MULTIPLIER,
    include_population_only: bool = False,
) -> DataFrame:
    """Counts and rates per area and year.

    ``incidents`` needs zcta, occurred_year, offense_group and optionally incident_count.
    The universe is the areas with incidents, optionally joined by all population areas.
    """
    counts = count_by_group(incidents, [AREA, "occurred_year"]).withColumnRenamed("occurred_year", YEAR)
    known = population.select(AREA, YEAR, POPULATION).distinct()
    if include_population_only:
        joined = _universe(population, counts, True).join(counts, [AREA, YEAR], "left")
    else:
        joined = counts.join(known, [AREA, YEAR], "left")
    return add_rates(_filled(joined), multiplier).select(*ANNUAL_COLUMNS)


def monthly_aggregates(
    incidents: DataFrame,
    population: DataFrame,
    multiplier: float = RATE_MULTIPLIER,
    include_population_only: bool = False,
) -> DataFrame:
    """Twelve dense months per area and year against the annual population.

    Incidents are counted once; the months of an area and year, twelve at most, are gathered and spread again.
    """
    counts = count_by_group(incidents, [AREA, "occurred_year", "occurred_month"]).withColumnRenamed("occurred_year", YEAR)
    named = F.col("occurred_month").isNotNull()
    months = F.map_from_entries(F.collect_list(F.when(named, F.struct("occurred_month", F.struct(*COUNT_COLUMNS)))))
    areas = counts.groupBy(AREA, YEAR).agg(months.alias("_months"))
    known = population.select(AREA, YEAR, POPULATION).distinct()
    if include_population_only:
        every = areas.select(AREA, YEAR).unionByName(known.select(AREA, YEAR)).distinct()
        areas = every.join(areas, [AREA, YEAR], "left")
    spread = areas.join(known, [AREA, YEAR], "left").select(
        AREA, YEAR, POPULATION, "_months", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    )
    cell = F.col("_months")[F.col("month")]
    joined = spread.select(AREA, YEAR, POPULATION, "month", *[cell[c].alias(c) for c in COUNT_COLUMNS])
    return add_rates(_filled(joined), multiplier).select(*MONTHLY_COLUMNS)
