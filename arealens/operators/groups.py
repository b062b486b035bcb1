"""Profiles of arbitrary groups of areas, many groups at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import (
    AREA,
    COUNT_COLUMNS,
    OVERALL_SCORE,
    POPULATION,
    SCORED,
    SCORE_COLUMNS_OUT,
    YEAR,
    count_col,
    rate_col,
)
from arealens.functions.rates import round_half_up, score_label
from arealens.functions.text import pad_key
from arealens.operators.skew import hottest_keys, lookup_join

STATUS_COLUMNS = ["coverage_status", "data_source_type", "confidence_grade"]


def latest_records(records: DataFrame, order: str) -> DataFrame:
    """One record per padded area key, the last by ``order``."""
    keyed = records.where(F.col(AREA).isNotNull()).withColumn(AREA, pad_key(F.col(AREA)))
    others = [c for c in keyed.columns if c not in (AREA, order)]
    best = keyed.groupBy(AREA).agg(F.max(F.struct(order, *others)).alias("_r"))
    return best.select(AREA, *[f"_r.{c}" for c in [order, *others]])


def requested_members(requests: DataFrame, records: DataFrame, group: str = "group_id") -> DataFrame:
    """Distinct requested areas per group joined to the one record they have, plus ``found``.

    ``records`` has one row per area. A popular area may be in most groups, so the join is
    the skew-safe lookup.
    """
    wanted = requests.where(F.col(AREA).isNotNull()).select(group, pad_key(F.col(AREA)).alias(AREA)).distinct()
    hot = hottest_keys(wanted, [AREA])
    return lookup_join(wanted, records.withColumn("found", F.lit(True)), [AREA], hot).withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def missing_members(members: DataFrame, group: str = "group_id") -> DataFrame:
    return members.where(~F.col("found")).select(group, AREA)


def weighted_average(value: Column, weight: Column) -> Column:
    """Mean weighted over positive weights; without any, the plain mean."""
    v = value.cast("double")
    w = F.when((weight.cast("double") > 0) & v.isNotNull(), weight.cast("double"))
    return F.coalesce(F.try_divide(F.sum(v * w), F.sum(w)), F.avg(F.when(w.isNull(), v)))


def group_profile(members: DataFrame, group: str = "group_id") -> DataFrame:
    """Counts summed, rates from the sums, scores averaged by population, one row per group."""
    found = F.col("found")
    pop = F.coalesce(F.sum(F.col(POPULATION)), F.lit(0))
    years = F.when(F.min(YEAR) == F.max(YEAR), F.min(YEAR))
    status = F.col("coverage_status")
    sums = members.groupBy(group).agg(
        F.count(F.lit(1)).alias("requested_zip_count"),
        F.count_if(found).alias("found_zip_count"),
        F.count_if(~found).alias("missing_zip_count"),
        years.alias(YEAR),
        pop.alias(POPULATION),
        *[F.sum(c).alias(c) for c in COUNT_COLUMNS],
        *[weighted_average(F.col(s), F.col(POPULATION)).alias(s) for s in SCORE_COLUMNS_OUT],
        F.count_if(found & (status == "observed")).alias("direct_observed_zip_count"),
        F.count_if(found & (status == "county_observed_allocated")).alias("county_observed_zip_count"),
        F.count_if(found & (status == "national_modeled")).alias("modeled_zip_count"),
    )
    people = F.when(F.col(POPULATION) > 0, F.col(POPULATION).cast("double"))
    rates = {
        rate_col(b): round_half_up(F.col(count_col(b)).cast("double") / people * F.lit(1000.0), 3)
        for b in ["total", *SCORED, "unknown"]
    }
    labels = {s.replace("_0_100", "_label"): score_label(F.col(s)) for s in SCORE_COLUMNS_OUT}
    scores = {s: round_half_up(F.col(s), 1) for s in SCORE_COLUMNS_OUT}
    observed = F.col("direct_observed_zip_count") + F.col("county_observed_zip_count")
    return sums.withColumns({**rates, **labels}).withColumns({**scores, "observed_zip_count": observed})


def group_histograms(members: DataFrame, group: str = "group_id") -> DataFrame:
    """Found members per group, status kind and value (``unavailable`` where missing)."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("kind"), F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unavailable")).alias("value"))
            for c in STATUS_COLUMNS
        ]
    )
    long = members.where("found").select(group, F.explode(cells).alias("_c"))
    return long.groupBy(group, "_c.kind", "_c.value").agg(F.count(F.lit(1)).alias("zip_count"))


def group_sources(members: DataFrame, group: str = "group_id") -> DataFrame:
    """Distinct source names per group, one row each."""
    names = members.where("found").select(group, F.explode(F.split("source_names", r"\|")).alias("_n"))
    return names.select(group, F.trim("_n").alias("source_name")).where(F.col("source_name") != "").distinct()


__all__ = [
    "OVERALL_SCORE", "group_histograms", "group_profile", "group_sources", "latest_records", "missing_members",
    "requested_members", "weighted_average",
]
