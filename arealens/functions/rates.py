"""Rates, score transforms, labels and grades as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealens.constants import (
    COMPOSITE_WEIGHTS,
    INDEX_MEAN,
    INDEX_STD,
    RATE_MULTIPLIER,
)


def safe_rate(count: Column, population: Column, multiplier: float = RATE_MULTIPLIER) -> Column:
    """count / population x multiplier; NULL unless the population is positive."""
    pop = F.when(population.cast("double") > 0, population.cast("double"))
    return count.cast("double") / pop * F.lit(float(multiplier))


def round_half_even(value: Column, digits: int = 0) -> Column:
    factor = float(10**digits)
    return F.rint(value * F.lit(factor)) / F.lit(factor)


def round_half_up(value: Column, digits: int) -> Column:
    """Half-up with a machine-epsilon nudge, as score consumers round."""
    factor = float(10**digits)
    return F.floor((value + F.lit(2.220446049250313e-16)) * F.lit(factor) + F.lit(0.5)).cast("double") / F.lit(factor)


def round_decimal(value: Column, digits: int) -> Column:
    """What ``round`` gives for a double, without its decimal number per value unless that could decide."""
    factor = float(10**digits)
    scaled = value * F.lit(factor)
    whole = F.rint(scaled)
    # Below 2^43 the product is off by less than 1/1024, as is the decimal that is rounded; -0 becomes 0.
    clear = (F.abs(scaled) < F.lit(float(2**43))) & (F.abs(F.abs(scaled - whole) - F.lit(0.5)) > F.lit(1 / 256))
    return F.when(clear, whole / F.lit(factor) + F.lit(0.0)).otherwise(F.round(value, digits))


def score_label(score: Column) -> Column:
    return (
        F.when(score.isNull() | F.isnan(score), "unavailable")
        .when(score < 20, "very_low")
        .when(score < 40, "low")
        .when(score < 60, "average")
        .when(score < 80, "high")
        .otherwise("very_high")
    )


def logistic_score(z: Column, digits: int = 1) -> Column:
    return round_half_even(F.lit(100.0) / (F.lit(1.0) + F.exp(-z)), digits)


def index_value(z: Column, mean: float = INDEX_MEAN, std: float = INDEX_STD) -> Column:
    return F.lit(float(mean)) + F.lit(float(std)) * z


def composite_z(z_of: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    weights = weights or COMPOSITE_WEIGHTS
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * z_of[base] for base, w in weights.items()])


def weighted_score(scores: dict[str, Column], weights: dict[str, float], renormalize: bool = True) -> Column:
    """Weighted mean over the scores present; zero-weight categories are ignored."""
    used = [(c, float(w)) for c, w in ((k, weights.get(k, 0.0)) for k in scores) if w > 0]
    if not used:
        return F.lit(None).cast("double")
    total = reduce(lambda a, b: a + b, [F.coalesce(scores[c] * F.lit(w), F.lit(0.0)) for c, w in used])
    available = reduce(
        lambda a, b: a + b, [F.when(scores[c].isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in used]
    )
    divisor = available if renormalize else F.lit(float(sum(weights.values())))
    return F.when(available > 0, total / F.when(divisor > 0, divisor))


def missing_score_note(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """Which weighted categories had no score, in order; a fixed note if none had one."""
    used = [c for c in scores if weights.get(c, 0.0) > 0]
    missing = F.array_compact(F.array(*[F.when(scores[c].isNull(), F.lit(c)) for c in used]))
    return (
        F.when(F.size(missing) == len(used), "overall_score_unavailable_no_category_scores")
        .when(F.size(missing) > 0, F.concat(F.lit("renormalized_missing_categories:"), F.array_join(missing, ",")))
    )


def coverage_score(
    assigned_rate: Column, spatial_share: Column, classified_rate: Column, dated_rate: Column, population: Column
) -> Column:
    value = (
        F.lit(0.35) * assigned_rate
        + F.lit(0.25) * spatial_share
        + F.lit(0.20) * classified_rate
        + F.lit(0.10) * dated_rate
        + F.lit(0.10) * population.isNotNull().cast("double")
    )
    return round_half_even(value, 3)


def confidence_grade(
    status: Column, population: Column, total: Column, spatial_share: Column, coverage: Column
) -> Column:
    pop = population.cast("double")
    n = F.coalesce(total, F.lit(0))
    share = F.coalesce(spatial_share, F.lit(0.0))
    cov = F.coalesce(coverage, F.lit(0.0))
    return (
        F.when(F.coalesce(status, F.lit("")) == "partial_observed", "D")
        .when(pop.isNull() | (pop < 100), "D")
        .when((share >= 0.90) & (cov >= 0.85) & (n >= 20) & (pop >= 1000), "A")
        .when(n < 5, "C")
        .when((share >= 0.70) & (cov >= 0.70) & (pop >= 500), "B")
        .when(cov >= 0.50, "C")
        .otherwise("D")
    )


def county_coverage_score(population: Column) -> Column:
    pop = F.coalesce(population.cast("double"), F.lit(0.0))
    return F.when(pop <= 0, 0.0).when(pop < 500, 0.55).otherwise(0.75)


def county_grade(population: Column, county_count: Column) -> Column:
    pop = F.coalesce(population.cast("double"), F.lit(0.0))
    return (
        F.when(pop <= 0, "D").when(pop < 500, "C").when(F.coalesce(county_count, F.lit(0)) == 1, "B").otherwise("C")
    )


def modeled_coverage_score(population: Column) -> Column:
    return F.when(population.cast("double") >= 500, 0.35).otherwise(0.20)


def modeled_grade(population: Column) -> Column:
    return F.when(population.cast("double") >= 500, "C").otherwise("D")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole.cast("double") > 0, F.lit(100.0) * part.cast("double") / whole.cast("double")).otherwise(0.0)
