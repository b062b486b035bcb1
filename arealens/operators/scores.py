"""Rates to comparable scores: winsorise, rank, standardise, combine, label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.constants import (
    AREA,
    BASES,
    INDEX_COLUMNS,
    INDEX_MEAN,
    INDEX_STD,
    OVERALL_LABEL,
    OVERALL_SCORE,
    OVERALL_WEIGHTS,
    SCOPE_COLUMNS,
    SCORED,
    WINSOR_LOWER,
    WINSOR_UPPER,
    label_col,
    percentile_col,
    rate_col,
    score_col,
    winsorized_col,
    z_col,
)
from arealens.functions.rates import (
    composite_z,
    index_value,
    logistic_score,
    missing_score_note,
    round_half_even,
    score_label,
    weighted_score,
)
from arealens.operators.aggregate import add_rates
from arealens.operators.materialize import materialize
from arealens.operators.ranking import attach_outcomes, fixed_domain_percentiles, value_outcomes


def winsorize(
    df: DataFrame, columns: dict[str, str], groups: list[str], lower: float = WINSOR_LOWER, upper: float = WINSOR_UPPER
) -> DataFrame:
    """Clip columns to group quantiles; ``columns`` maps inputs to output names."""
    names, df = list(columns), materialize(df, "rows")
    outcomes = value_outcomes(df, names, groups, lower, upper)
    return attach_outcomes(df, outcomes, names, groups, {"w": [columns[c] for c in names]})


def percentile_ranks(df: DataFrame, columns: dict[str, str], groups: list[str]) -> DataFrame:
    """Average-rank percentiles in [0, 1] within each group."""
    names, df = list(columns), materialize(df, "rows")
    outcomes = value_outcomes(df, names, groups)
    return attach_outcomes(df, outcomes, names, groups, {"p": [columns[c] for c in names]})


def percentile_scores(
    df: DataFrame, columns: dict[str, tuple[str, str]], groups: list[str], digits: int = 1
) -> DataFrame:
    """Percentile and 0..100 score per column; ``columns`` maps an input to both output names."""
    ranked = percentile_ranks(df, {c: p for c, (p, _) in columns.items()}, groups)
    return ranked.withColumns(
        {score: round_half_even(F.col(p) * F.lit(100.0), digits) for p, score in columns.values()}
    )


def z_scores(df: DataFrame, columns: dict[str, str], groups: list[str]) -> DataFrame:
    """Population z-scores within each group, 0 where the group does not vary."""
    names, df = list(columns), materialize(df, "rows")
    outcomes = value_outcomes(df, names, groups)
    return attach_outcomes(df, outcomes, names, groups, {"z": [columns[c] for c in names]})


def logistic_scores(df: DataFrame, z_columns: list[str], digits: int = 1) -> DataFrame:
    return df.withColumns(
        {c.replace("_z_score", "_logistic_score_0_100"): logistic_score(F.col(c), digits) for c in z_columns}
    )


def overall_score(
    df: DataFrame, weights: dict[str, float] | None = None, renormalize: bool = True, digits: int = 1
) -> DataFrame:
    """Weighted composite of the category scores and the note on missing ones."""
    weights = weights or OVERALL_WEIGHTS
    scores = {c: F.col(score_col(c)) for c in SCORED}
    return df.withColumns(
        {
            OVERALL_SCORE: round_half_even(weighted_score(scores, weights, renormalize), digits),
            "score_notes": missing_score_note(scores, weights),
        }
    )


def internal_indexes(df: DataFrame, mean: float = INDEX_MEAN, std: float = INDEX_STD, weights: dict | None = None) -> DataFrame:
    z = {b: F.col(z_col(b)) for b in BASES}
    return df.withColumns(
        {
            "violent_index": index_value(z["violent"], mean, std),
            "property_index": index_value(z["property"], mean, std),
            "total_index": index_value(z["total"], mean, std),
            "composite_index": index_value(composite_z(z, weights), mean, std),
        }
    )


def add_labels(df: DataFrame) -> DataFrame:
    labels = {label_col(b): score_label(F.col(score_col(b))) for b in BASES}
    labels[OVERALL_LABEL] = score_label(F.col(OVERALL_SCORE))
    return df.withColumns(labels)


def apply_scope(annual: DataFrame, scope: str, area_states: DataFrame | None = None, state: str = "state_fips") -> DataFrame:
    """``state`` compares areas within their state (``unknown`` without one); any other scope is one group."""
    if scope != "state":
        return annual.withColumn("comparison_scope", F.lit(scope)).withColumn("comparison_scope_value", F.lit(""))
    per_area = area_states.groupBy(AREA).agg(F.min(F.col(state).cast("string")).alias("_state"))
    return (
        annual.join(per_area, AREA, "left")
        .withColumn("comparison_scope", F.lit("state"))
        .withColumn("comparison_scope_value", F.coalesce("_state", F.lit("unknown")))
        .drop("_state")
    )


def score_rates(
    df: DataFrame,
    lower: float = WINSOR_LOWER,
    upper: float = WINSOR_UPPER,
    groups: list[str] | None = None,
    digits: int = 1,
) -> DataFrame:
    """Winsorised rates, percentiles, scores and z-scores for all seven rates.

    One histogram per group serves the quantiles, the ranks of the clipped values and
    their moments, and one lookup brings everything back to the rows.
    """
    groups = groups or SCOPE_COLUMNS
    rates = [rate_col(b) for b in BASES]
    df = materialize(df, "rates")
    outcomes = value_outcomes(df, rates, groups, lower, upper)
    scored = attach_outcomes(
        df,
        outcomes,
        rates,
        groups,
        {
            "w": [winsorized_col(b) for b in BASES],
            "p": [percentile_col(b) for b in BASES],
            "z": [z_col(b) for b in BASES],
        },
    )
    return scored.withColumns(
        {score_col(b): round_half_even(F.col(percentile_col(b)) * F.lit(100.0), digits) for b in BASES}
    )


def add_overall_percentile(df: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Percentile of the composite, which has one decimal between 0 and 100."""
    ranked = fixed_domain_percentiles(df, OVERALL_SCORE, "overall_percentile", groups or SCOPE_COLUMNS)
    return ranked.withColumn("percentile_rank", F.col("overall_percentile"))


def ensure_index_columns(df: DataFrame) -> DataFrame:
    """Default missing descriptive columns and derive the observed level from the status."""
    text = ["observed_level", "county_fips", "county_name", "county_components", "allocation_method"]
    filled = {
        c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in text
    }
    filled["county_count"] = (
        F.coalesce(F.col("county_count").try_cast("long"), F.lit(0)) if "county_count" in df.columns else F.lit(0).cast("long")
    )
    out = df.withColumns(filled)
    if "coverage_status" in df.columns:
        level = (
            F.when(F.trim("observed_level") != "", F.col("observed_level"))
            .when(F.col("coverage_status") == "observed", "zcta")
            .when(F.col("coverage_status") == "partial_observed", "zcta_partial")
            .otherwise(F.col("observed_level"))
        )
        out = out.withColumn("observed_level", level)
    return out


def build_index(
    annual: DataFrame,
    ratios: DataFrame | None = None,
    by_area: DataFrame | None = None,
    weights: dict[str, float] | None = None,
    lower: float = WINSOR_LOWER,
    upper: float = WINSOR_UPPER,
    renormalize: bool = True,
) -> DataFrame:
    """Annual counts with scope columns to the full index.

    ``ratios`` (per year) and ``by_area`` (per area and year) come from
    :mod:`arealens.operators.quality`; without them the coverage parts are zero.
    """
    scoped = annual.withColumn("comparison_scope_value", F.coalesce("comparison_scope_value", F.lit("")))
    scored = internal_indexes(score_rates(add_rates(scoped), lower, upper))
    return complete_index(add_overall_percentile(overall_score(scored, weights, renormalize)), ratios, by_area)


def complete_index(scored: DataFrame, ratios: DataFrame | None = None, by_area: DataFrame | None = None) -> DataFrame:
    """Scored rows to the full index: labels, coverage, descriptive columns."""
    from arealens.operators.quality import apply_quality

    graded = ensure_index_columns(apply_quality(add_labels(scored), ratios, by_area))
    return graded.select(*INDEX_COLUMNS, F.current_timestamp().cast("timestamp_ntz").alias("created_at"))


def uniform_index(annual: DataFrame) -> DataFrame:
    """The index of areas that all share the same rates, without any ranking: middle scores where there is a rate."""
    rated = add_rates(annual.withColumn("comparison_scope_value", F.coalesce("comparison_scope_value", F.lit(""))))
    flat = {}
    for b in BASES:
        known = F.col(rate_col(b)).isNotNull()
        flat |= {winsorized_col(b): F.col(rate_col(b)), percentile_col(b): F.when(known, 0.5), z_col(b): F.when(known, 0.0), score_col(b): F.when(known, 50.0)}
    scored = overall_score(internal_indexes(rated.withColumns(flat)))
    middle = F.when(F.col(OVERALL_SCORE).isNotNull(), 0.5)
    return complete_index(scored.withColumns({"overall_percentile": middle, "percentile_rank": middle}))
