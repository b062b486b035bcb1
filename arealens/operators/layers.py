"""County-observed layer, modelled baseline and the coverage cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.constants import (
    AREA,
    BASELINE_PROPERTY_RATE,
    BASELINE_SCOPE,
    BASELINE_VIOLENT_RATE,
    COUNTY_SCOPE,
    OVERALL_LABEL,
    OVERALL_SCORE,
    POPULATION,
    YEAR,
    count_col,
    label_col,
    percentile_col,
    rate_col,
    score_col,
    winsorized_col,
    z_col,
)
from arealens.functions.rates import (
    county_coverage_score,
    county_grade,
    modeled_coverage_score,
    modeled_grade,
)
from arealens.functions.text import append_note
from arealens.operators.scores import build_index, uniform_index

MODELED = ["violent", "property", "total"]
UNMODELED = ["drug", "public_order", "weapons", "other"]
#: They describe a row and enter no other column.
COUNTY_TEXTS = ["county_fips", "county_name", "county_components"]


def county_quality(indexed: DataFrame, source: str, note: str) -> DataFrame:
    """Overwrite the quality columns of an allocated layer."""
    return indexed.withColumns(
        {
            "coverage_status": F.lit(COUNTY_SCOPE),
            "data_source_type": F.lit("observed"),
            "source_names": F.lit(source),
            "source_count": F.coalesce(F.col("county_count"), F.lit(1)).cast("long"),
            "assigned_incident_count": F.lit(0).cast("long"),
            "spatial_incident_count": F.lit(0).cast("long"),
            "is_modeled": F.lit(False),
            "observed_level": F.lit("county"),
            "allocation_method": F.lit("zip_county_rate_allocation"),
            "data_coverage_score": county_coverage_score(F.col(POPULATION)),
            "confidence_grade": county_grade(F.col(POPULATION), F.col("county_count")),
            "score_notes": append_note(F.col("score_notes"), note, whole_note=False),
        }
    )


def county_layer(allocated: DataFrame, source: str, note: str, columns: list[str] | None = None) -> DataFrame:
    """Index over allocated annual rows, graded as county-observed.

    The index stores its rows between its steps, behind which the planner cannot see what is wanted: of the texts that list
    an area's counties, those not among ``columns`` (default: all columns of the index) are not stored either.
    """
    if columns is None:
        return county_quality(build_index(allocated), source, note)
    unread = [c for c in COUNTY_TEXTS if c not in columns]
    return county_quality(build_index(allocated.drop(*unread)), source, note).select(*columns)


def modeled_annual(
    population: DataFrame,
    violent_rate: float = BASELINE_VIOLENT_RATE,
    property_rate: float = BASELINE_PROPERTY_RATE,
    scope: str = BASELINE_SCOPE,
) -> DataFrame:
    """Uniform rates applied to every populated area; other categories stay NULL."""
    pop = F.when(F.col(POPULATION).cast("double") > 0, F.col(POPULATION).cast("double"))
    modeled = population.withColumns(
        {
            "comparison_scope": F.lit(scope),
            "comparison_scope_value": F.lit(""),
            count_col("violent"): F.rint(pop * F.lit(float(violent_rate)) / F.lit(1000.0)).cast("long"),
            count_col("property"): F.rint(pop * F.lit(float(property_rate)) / F.lit(1000.0)).cast("long"),
        }
    )
    total = F.coalesce(F.col(count_col("violent")), F.lit(0)) + F.coalesce(F.col(count_col("property")), F.lit(0))
    return modeled.withColumns(
        {
            count_col("total"): total.cast("long"),
            **{count_col(c): F.lit(None).cast("long") for c in [*UNMODELED, "unknown"]},
        }
    )


def neutralize_scores(
    indexed: DataFrame,
    violent_rate: float = BASELINE_VIOLENT_RATE,
    property_rate: float = BASELINE_PROPERTY_RATE,
) -> DataFrame:
    """Replace ranks within a uniform model by neutral values where there is population."""
    populated = F.coalesce(F.col(POPULATION).cast("double") > 0, F.lit(False))
    rates = {"violent": violent_rate, "property": property_rate, "total": violent_rate + property_rate}
    fixed: dict[str, float] = {}
    for base, rate in rates.items():
        fixed[rate_col(base)] = rate
        fixed[winsorized_col(base)] = rate
    fixed |= {score_col(b): 50.0 for b in MODELED} | {OVERALL_SCORE: 50.0}
    fixed |= {percentile_col(b): 0.5 for b in MODELED} | {"overall_percentile": 0.5, "percentile_rank": 0.5}
    fixed |= {z_col(b): 0.0 for b in [*MODELED, *UNMODELED]}
    fixed |= {c: 100.0 for c in ("violent_index", "property_index", "total_index", "composite_index")}
    updates = {c: F.when(populated, F.lit(float(v))) for c, v in fixed.items()}
    for base in UNMODELED:
        for name in (score_col(base), percentile_col(base), rate_col(base), winsorized_col(base)):
            updates[name] = F.lit(None).cast("double")
        updates[label_col(base)] = F.lit("unavailable")
    updates[rate_col("unknown")] = F.lit(None).cast("double")
    for name in [*[label_col(b) for b in MODELED], OVERALL_LABEL]:
        updates[name] = F.when(populated, "average").otherwise("unavailable")
    return indexed.withColumns({c: e for c, e in updates.items() if c in indexed.columns})


def modeled_layer(
    population: DataFrame,
    source: str,
    note: str,
    violent_rate: float = BASELINE_VIOLENT_RATE,
    property_rate: float = BASELINE_PROPERTY_RATE,
    scope: str = BASELINE_SCOPE,
) -> DataFrame:
    """National baseline index for every area with a population value."""
    known = population.where(F.col(POPULATION).isNotNull()).select(AREA, YEAR, POPULATION)
    indexed = uniform_index(modeled_annual(known, violent_rate, property_rate, scope))
    return neutralize_scores(indexed, violent_rate, property_rate).withColumns(
        {
            "coverage_status": F.lit("national_modeled"),
            "data_source_type": F.lit("modeled"),
            "source_names": F.lit(source),
            "source_count": F.lit(1).cast("long"),
            "assigned_incident_count": F.lit(0).cast("long"),
            "spatial_incident_count": F.lit(0).cast("long"),
            "is_modeled": F.lit(True),
            "data_coverage_score": modeled_coverage_score(F.col(POPULATION)),
            "confidence_grade": modeled_grade(F.col(POPULATION)),
            "score_notes": append_note(F.col("score_notes"), note, whole_note=False),
        }
    )


def national_coverage(population: DataFrame, by_area: DataFrame, county_index: DataFrame, county_source: str, county_note: str, missing_note: str) -> DataFrame:
    """Direct observation, else county observation, else model, for every population area."""
    direct = by_area.select(AREA, YEAR, "assigned_count", "spatial_count", "source_count", "source_names")
    county = county_index.where(F.col("coverage_status") == COUNTY_SCOPE).select(
        AREA,
        YEAR,
        F.coalesce(F.col("county_count"), F.lit(1)).cast("long").alias("_county_count"),
        F.coalesce(F.col("source_names"), F.lit(county_source)).alias("_county_names"),
    )
    joined = population.select(AREA, YEAR, POPULATION).join(direct, [AREA, YEAR], "left").join(county, [AREA, YEAR], "left")
    assigned = F.coalesce(F.col("assigned_count"), F.lit(0)).cast("long")
    observed = assigned > 0
    by_county = F.col("_county_count").isNotNull() & ~observed
    status = F.when(observed, "observed").when(by_county, COUNTY_SCOPE).otherwise("national_modeled")
    return joined.select(
        AREA,
        YEAR,
        POPULATION,
        F.when(by_county, F.col("_county_count")).otherwise(F.coalesce(F.col("source_count"), F.lit(0))).cast("long").alias("source_count"),
        F.when(by_county, F.col("_county_names")).otherwise(F.coalesce(F.col("source_names"), F.lit(""))).alias("source_names"),
        assigned.alias("assigned_incident_count"),
        F.coalesce(F.col("spatial_count"), F.lit(0)).cast("long").alias("spatial_incident_count"),
        status.alias("coverage_status"),
        F.when(observed | by_county, "observed").otherwise("modeled").alias("data_source_type"),
        F.when(observed, F.lit(None)).when(by_county, county_note).otherwise(missing_note).alias("coverage_notes"),
    )
