"""Direct-coverage gap report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.constants import AREA, POPULATION
from arealens.functions.rates import percent
from arealens.functions.text import pad_key
from arealens.operators.crosswalk import top_state
from arealens.operators.ranking import priority_rank

HIGH_POPULATION = 50_000


def directly_observed(observed: DataFrame) -> DataFrame:
    """Distinct areas with complete direct observation (a missing status counts as observed)."""
    return observed.where(F.coalesce("coverage_status", F.lit("observed")) == "observed").select(AREA).distinct()


def gap_base(universe: DataFrame, observed: DataFrame) -> DataFrame:
    flagged = directly_observed(observed).withColumn("_seen", F.lit(True))
    return universe.select(AREA, POPULATION).join(flagged, AREA, "left").withColumn(
        "observed", F.coalesce("_seen", F.lit(False))
    ).drop("_seen")


def gap_totals(universe: DataFrame, observed: DataFrame) -> DataFrame:
    """One row of totals. Missing populated areas subtract observed *populated* areas only."""
    base = gap_base(universe, observed)
    pop, seen = F.col(POPULATION), F.col("observed")
    populated = F.coalesce(pop > 0, F.lit(False))
    people = F.when(populated, pop).otherwise(F.lit(0))
    partial = observed.agg(
        F.count_distinct(F.when(F.col("coverage_status") == "partial_observed", F.col(AREA))).alias("x")
    ).scalar()
    sums = base.agg(
        F.count(F.lit(1)).alias("universe_rows"),
        F.count_if(populated).alias("populated_rows"),
        F.count_if(seen).alias("observed_rows"),
        F.count_if(~seen).alias("missing_rows"),
        F.count_if(populated & ~seen).alias("missing_populated_rows"),
        F.sum(people).alias(POPULATION),
        F.sum(F.when(seen, people).otherwise(F.lit(0))).alias("observed_population"),
        F.sum(F.when(~seen, people).otherwise(F.lit(0))).alias("missing_population"),
    )
    return sums.withColumns(
        {
            "partial_rows": partial,
            "population_coverage_pct": F.round(percent(F.col("observed_population"), F.col(POPULATION)), 1),
        }
    )


def gaps_by_state(universe: DataFrame, observed: DataFrame, crosswalk: DataFrame, top: int | None = None) -> DataFrame:
    """Coverage per state over populated areas, optionally the ``top`` states by missing population."""
    base = gap_base(universe.where(F.col(POPULATION) > 0), observed).join(top_state(crosswalk), AREA, "left")
    pop, seen = F.col(POPULATION), F.col("observed")
    sums = base.groupBy(F.coalesce("state_code", F.lit("??")).alias("state_code")).agg(
        F.count(F.lit(1)).alias("zctas"),
        F.count_if(seen).alias("observed_zctas"),
        F.count_if(~seen).alias("missing_zctas"),
        F.sum(pop).alias("population"),
        F.sum(F.when(seen, pop).otherwise(F.lit(0))).alias("observed_population"),
        F.sum(F.when(~seen, pop).otherwise(F.lit(0))).alias("missing_population"),
    )
    rated = sums.withColumns(
        {
            "zcta_coverage_pct": F.round(percent(F.col("observed_zctas"), F.col("zctas")), 1),
            "population_coverage_pct": F.round(percent(F.col("observed_population"), F.col("population")), 1),
        }
    )
    return rated if top is None else rated.orderBy(F.desc("missing_population"), "state_code").limit(top)


def target_queue(
    universe: DataFrame, observed: DataFrame, crosswalk: DataFrame, min_population: int = HIGH_POPULATION
) -> DataFrame:
    """Every large area without direct observation, ranked by population."""
    large = universe.where(F.col(POPULATION) >= min_population).select(AREA, POPULATION)
    missing = large.join(directly_observed(observed), AREA, "left_anti")
    # Distinct names of one area's counties.
    counties = (
        crosswalk.select(AREA, "county_name")
        .distinct()
        .groupBy(AREA)
        .agg(F.array_join(F.sort_array(F.collect_list("county_name")), "; ").alias("county_names"))
    )
    listed = missing.join(top_state(crosswalk), AREA, "left").join(counties, AREA, "left").select(
        pad_key(F.col(AREA)).alias(AREA),
        F.coalesce("state_code", F.lit("??")).alias("state_code"),
        F.coalesce("county_names", F.lit("")).alias("county_names"),
        F.col(POPULATION).cast("long").alias(POPULATION),
    )
    return priority_rank(listed, POPULATION, AREA)


def target_totals(universe: DataFrame, observed: DataFrame, min_population: int = HIGH_POPULATION) -> DataFrame:
    base = gap_base(universe.where(F.col(POPULATION) >= min_population), observed)
    pop, seen = F.col(POPULATION), F.col("observed")
    sums = base.agg(
        F.count(F.lit(1)).alias("target_rows"),
        F.count_if(seen).alias("covered_rows"),
        F.count_if(~seen).alias("missing_rows"),
        F.coalesce(F.sum(pop), F.lit(0)).alias("target_population"),
        F.coalesce(F.sum(F.when(seen, pop)), F.lit(0)).alias("covered_population"),
        F.coalesce(F.sum(F.when(~seen, pop)), F.lit(0)).alias("missing_population"),
    )
    return sums.withColumns(
        {
            "area_coverage_pct": F.round(percent(F.col("covered_rows"), F.col("target_rows")), 1),
            "population_coverage_pct": F.round(percent(F.col("covered_population"), F.col("target_population")), 1),
        }
    )
