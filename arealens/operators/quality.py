"""Coverage measures, grading and the data-quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import (
    AREA,
    LOW_COUNT_THRESHOLD,
    PARTIAL_MIN_INCIDENTS,
    PARTIAL_POPULATION,
    POPULATION,
    YEAR,
    count_col,
)
from arealens.functions.rates import confidence_grade, coverage_score, round_half_even
from arealens.functions.text import append_note
from arealens.operators.assign import join_assignments, one_assignment_per_id
from arealens.operators.materialize import materialize


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def counted_incidents(incidents: DataFrame, assignments: DataFrame) -> DataFrame:
    """Counted incidents with their area and what coverage is measured by; feeds both measures below."""
    flags = incidents.withColumns(
        {"known": F.col("offense_group") != "unknown", "dated": F.col("occurred_date").isNotNull()}
    )
    return join_assignments(flags, assignments, ["occurred_year", "source_name", "known", "dated"])


def coverage_ratios(counted: DataFrame) -> DataFrame:
    """Incident-weighted assigned, spatial, classified and dated shares per year."""
    n = F.col("incident_count")

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(F.lit(0)))

    sums = (
        counted.where(F.col("occurred_year").isNotNull())
        .groupBy(F.col("occurred_year").alias(YEAR))
        .agg(
            F.sum(n).alias("incident_total"),
            total(F.col("zcta").isNotNull()).alias("_assigned"),
            total(F.col("assignment_method") == "spatial_join").alias("_spatial"),
            total(F.col("known")).alias("_classified"),
            total(F.col("dated")).alias("_with_date"),
        )
    )
    whole = F.col("incident_total")
    return sums.select(
        YEAR,
        "incident_total",
        _share(F.col("_assigned"), whole).alias("zcta_assignment_rate"),
        _share(F.col("_spatial"), whole).alias("spatial_assignment_rate"),
        _share(F.col("_classified"), whole).alias("offense_classification_rate"),
        _share(F.col("_with_date"), whole).alias("date_completeness_rate"),
    )


def area_coverage(counted: DataFrame) -> DataFrame:
    """Assigned and spatial counts and the contributing sources per area and year."""
    joined = counted.where(F.col("zcta").isNotNull() & F.col("occurred_year").isNotNull())
    n = F.col("incident_count")
    # Summed per source first, so that only distinct sources are gathered per area.
    per_source = joined.groupBy(F.col("zcta").alias(AREA), F.col("occurred_year").alias(YEAR), "source_name").agg(
        F.sum(n).alias("_n"), F.sum(F.when(F.col("assignment_method") == "spatial_join", n).otherwise(F.lit(0))).alias("_s")
    )
    sums = per_source.groupBy(AREA, YEAR).agg(
        F.sum("_n").alias("assigned_count"),
        F.sum("_s").alias("spatial_count"),
        F.count("source_name").alias("source_count"),
        F.array_join(F.sort_array(F.collect_list("source_name")), "|").alias("source_names"),
    )
    return sums.withColumn("spatial_assignment_share", _share(F.col("spatial_count"), F.col("assigned_count")))


def apply_quality(
    df: DataFrame,
    ratios: DataFrame | None = None,
    by_area: DataFrame | None = None,
    low_count: int = LOW_COUNT_THRESHOLD,
    partial_population: int = PARTIAL_POPULATION,
    partial_incidents: int = PARTIAL_MIN_INCIDENTS,
) -> DataFrame:
    """Coverage columns, status, score notes and confidence grade."""
    rate_names = [
        "zcta_assignment_rate", "spatial_assignment_rate", "offense_classification_rate", "date_completeness_rate",
    ]
    if by_area is not None:
        quality = by_area.select(
            AREA, YEAR, "assigned_count", "spatial_count", "source_count", "source_names", "spatial_assignment_share"
        )
        df = df.join(quality, [AREA, YEAR], "left")
    else:
        df = df.withColumns(
            {
                "assigned_count": F.lit(None).cast("long"),
                "spatial_count": F.lit(None).cast("long"),
                "source_count": F.lit(None).cast("long"),
                "source_names": F.lit(None).cast("string"),
                "spatial_assignment_share": F.lit(None).cast("double"),
            }
        )
    if ratios is not None:
        # One row per calendar year.
        df = df.join(F.broadcast(ratios.select(YEAR, *rate_names)), YEAR, "left")
        df = df.withColumns({r: F.coalesce(F.col(r), F.lit(0.0)) for r in rate_names})
    else:
        df = df.withColumns({r: F.lit(0.0) for r in rate_names})

    assigned = F.coalesce(F.col("assigned_count"), F.lit(0)).cast("long")
    pop = F.col(POPULATION).cast("double")
    partial = (assigned > 0) & (F.coalesce(pop, F.lit(0.0)) >= float(partial_population)) & (assigned < partial_incidents)
    status = F.when(partial, "partial_observed").when(assigned > 0, "observed").otherwise("national_modeled")
    share = F.coalesce(F.col("spatial_assignment_share"), F.col("spatial_assignment_rate"))
    out = df.withColumns(
        {
            "assigned_incident_count": assigned,
            "spatial_incident_count": F.coalesce(F.col("spatial_count"), F.lit(0)).cast("long"),
            "source_count": F.coalesce(F.col("source_count"), F.lit(0)).cast("long"),
            "source_names": F.coalesce(F.col("source_names"), F.lit("")),
            "coverage_status": status,
            "data_source_type": F.when(assigned > 0, "observed").otherwise("modeled"),
            "is_modeled": F.lit(False),
            "spatial_assignment_share": share,
            "data_coverage_score": coverage_score(
                F.col("zcta_assignment_rate"),
                share,
                F.col("offense_classification_rate"),
                F.col("date_completeness_rate"),
                F.col(POPULATION),
            ),
        }
    )
    total = F.col(count_col("total"))
    notes = append_note(F.col("score_notes"), "low_incident_count", F.coalesce(total, F.lit(0)) < low_count)
    out = out.withColumn("score_notes", notes)
    notes = append_note(
        F.col("score_notes"),
        "partial_observed_high_population_low_incident_count",
        F.col("coverage_status") == "partial_observed",
    )
    out = out.withColumn("score_notes", notes).withColumn(
        "confidence_grade",
        confidence_grade(
            F.col("coverage_status"),
            F.col(POPULATION),
            total,
            F.col("spatial_assignment_share"),
            F.col("data_coverage_score"),
        ),
    )
    return out.drop("assigned_count", "spatial_count", *rate_names)


# --- report -------------------------------------------------------------------


def value_counts(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("null")).alias(column)).agg(F.count(F.lit(1)).alias(name))


def weighted_value_counts(df: DataFrame, column: str, weight: str = "incident_count", name: str = "incident_total") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("null")).alias(column)).agg(
        F.sum(F.coalesce(F.col(weight), F.lit(1))).alias(name)
    )


def key_counts(df: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    """Row counts per key combination; combinations with a NULL are left out."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _rate(part: Column, whole: Column) -> Column:
    return round_half_even(_share(part, whole), 4)


MEASURES = {
    "date_completeness_rate": "dated",
    "coordinate_completeness_rate": "located",
    "zip_completeness_rate": "keyed",
    "zcta_assignment_rate": "assigned",
    "spatial_assignment_rate": "spatial",
    "offense_classification_rate": "classified",
}


def placed_incidents(incidents: DataFrame, assignments: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Incidents counted per id, ``extra`` columns and flags (``weight`` incidents in ``rows`` rows), with what their assignment says.

    Everything the completeness measures and the report count is in these rows.
    """
    n = F.coalesce(F.col("incident_count"), F.lit(1))
    flags = {
        "dated": F.col("occurred_date").isNotNull(),
        "located": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
        "keyed": F.col("zcta_from_zip").isNotNull(),
        "classified": F.col("offense_group") != "unknown",
    }
    counted = (
        incidents.select("incident_id", *(extra or []), n.alias("weight"), *[c.alias(f) for f, c in flags.items()])
        .groupBy("incident_id", *(extra or []), *flags)
        .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows"))
    )
    joined = counted.join(one_assignment_per_id(assignments), "incident_id", "left")
    return joined.withColumns({"assigned": F.col("zcta").isNotNull(), "spatial": F.col("assignment_method") == "spatial_join"}).drop("zcta")


def _measured() -> list[Column]:
    """Weighted sums of every flag, and of all rows."""
    sums = [F.sum(F.when(F.col(f), F.col("weight")).otherwise(F.lit(0))).alias(f) for f in MEASURES.values()]
    return [F.sum("rows").alias("rows"), F.sum("weight").alias("weight"), *sums]


def _cells(values: dict[str, Column], section: str | None = None) -> Column:
    """An array of (section,) metric and value."""
    head = [F.lit(section).alias("section")] if section else []
    return F.array(*[F.struct(*head, F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()])


def _population_rate(annual: DataFrame) -> DataFrame:
    return annual.agg(_rate(F.count(POPULATION), F.count(F.lit(1))).alias("rate"))


def completeness(incidents: DataFrame, assignments: DataFrame, annual: DataFrame) -> DataFrame:
    """The seven completeness rates as (metric, value) rows; one pass over each table."""
    sums = placed_incidents(incidents, assignments).agg(*_measured())
    rates = sums.select(F.explode(_cells({m: _rate(F.col(f), F.col("weight")) for m, f in MEASURES.items()})).alias("c"))
    people = _population_rate(annual).select(F.explode(_cells({"population_coverage_rate": F.col("rate")})).alias("c"))
    return rates.unionByName(people).select("c.metric", "c.value")


def duplicate_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per id, and their share."""
    per_id = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"))
    sums = per_id.agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("distinct_count"))
    extra = F.col("row_count") - F.col("distinct_count")
    return sums.select(
        "row_count", extra.alias("duplicate_incident_id_count"), _rate(extra, F.col("row_count")).alias("duplicate_rate")
    )


def top_records(df: DataFrame, column: str, limit: int = 20, tie: list[str] | None = None) -> DataFrame:
    """The highest values, NULL last, ties by key."""
    shown = [c for c in [AREA, YEAR, column, POPULATION, count_col("total"), "confidence_grade"] if c in df.columns]
    ties = [c for c in (tie or [AREA, YEAR]) if c in df.columns]
    return df.select(*shown).orderBy(F.col(column).desc_nulls_last(), *ties).limit(limit)


def _grouped(df: DataFrame, sets: list[list[str]], columns: list[str], values: list[Column]) -> DataFrame:
    """All grouping sets in one pass; ``grouping`` tells them apart by their position in ``sets``."""
    width = len(columns)
    number = [sum(1 << (width - 1 - columns.index(c)) for c in columns if c not in keys) for keys in sets]
    grouping = F.element_at(F.create_map(*[F.lit(v) for pair in ((n, i) for i, n in enumerate(number)) for v in pair]), F.grouping_id().cast("int"))
    return df.groupingSets(sets, *columns).agg(grouping.alias("grouping"), *values)


def _section(name: str, keys: list[str], value: str, missing: str | None = None) -> Column:
    """One report row; where a key is NULL it reads ``missing``, or the row is left out."""
    texts = [F.col(k).cast("string") for k in keys]
    metric = F.concat_ws("|", *[F.coalesce(t, F.lit(missing)) if missing else t for t in texts])
    row = F.array(F.struct(F.lit(name).alias("section"), metric.alias("metric"), F.col(value).cast("double").alias("value")))
    return row if missing else F.when(reduce(lambda a, b: a & b, [t.isNotNull() for t in texts]), row)


def quality_report(incidents: DataFrame, assignments: DataFrame, annual: DataFrame, index: DataFrame) -> DataFrame:
    """The whole report as (section, metric, value) rows.

    Each table is read once: what is counted of incidents is stored per id, and counted for all sections by
    grouping sets; the columns that the report shows of the other tables are stored too.
    """
    assigned = materialize(assignments.select("incident_id", "zcta", "assignment_method"), "assigned")
    placed = materialize(placed_incidents(incidents, assigned, ["source_name", "occurred_year", "offense_group"]), "placed")
    areas = materialize(annual.select(AREA, YEAR, POPULATION, "total_rate_per_1000", "violent_rate_per_1000"), "areas")
    graded = ["comparison_scope", "data_source_type", "is_modeled", "confidence_grade"]
    scores = materialize(index.select(AREA, YEAR, *graded, "overall_incident_score_0_100"), "scores")

    facts = _grouped(
        placed,
        [[], ["assignment_method"], ["offense_group"], ["source_name", "occurred_year"]],
        ["assignment_method", "offense_group", "source_name", "occurred_year"],
        _measured(),
    )
    methods, groups = ["assignment_method"], ["offense_group"]
    rates = _cells({m: _rate(F.col(f), F.col("weight")) for m, f in MEASURES.items()}, "completeness")
    of_facts = F.when(F.col("grouping") == 0, rates)
    of_facts = of_facts.when(F.col("grouping") == 1, _section("assignment_method_incident_counts", methods, "weight", "null"))
    of_facts = of_facts.when(
        F.col("grouping") == 2,
        F.concat(_section("offense_group_counts", groups, "rows", "null"), _section("offense_group_incident_counts", groups, "weight", "null")),
    ).otherwise(_section("year_coverage", ["source_name", "occurred_year"], "rows"))
    sums = _grouped(scores, [graded[:3], graded[3:], [graded[0], graded[3]]], graded, [F.count(F.lit(1)).alias("rows")])
    of_scores = F.when(F.col("grouping") == 0, _section("index_scope_counts", graded[:3], "rows"))
    of_scores = of_scores.when(F.col("grouping") == 1, _section("confidence_grade_counts", graded[3:], "rows", "null"))
    of_scores = of_scores.otherwise(_section("confidence_grade_counts_by_scope", [graded[0], graded[3]], "rows"))
    per_id = placed.groupBy("incident_id").agg(F.sum("rows").alias("rows")).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("ids"))
    extra = F.coalesce(F.col("rows") - F.col("ids"), F.lit(0))
    copies = {"duplicate_incident_id_count": extra, "duplicate_rate": _rate(extra, F.coalesce("rows", F.lit(0)))}
    parts = [
        facts.select(F.explode(of_facts).alias("r")),
        sums.select(F.explode(of_scores).alias("r")),
        _population_rate(areas).select(F.explode(_cells({"population_coverage_rate": F.col("rate")}, "completeness")).alias("r")),
        per_id.select(F.explode(_cells(copies, "duplicates")).alias("r")),
        value_counts(assigned, "assignment_method").select(F.explode(_section("assignment_method_counts", methods, "row_count")).alias("r")),
    ]
    for name, df, column in (
        ("top_total_rate_outliers", areas, "total_rate_per_1000"),
        ("top_violent_rate_outliers", areas, "violent_rate_per_1000"),
        ("top_overall_scores", scores, "overall_incident_score_0_100"),
    ):
        metric = F.concat_ws("|", F.col(AREA), F.col(YEAR).cast("string"))
        parts.append(top_records(df, column).select(F.struct(F.lit(name).alias("section"), metric.alias("metric"), F.col(column).cast("double").alias("value")).alias("r")))
    return reduce(lambda a, b: a.unionByName(b), parts).select("r.section", "r.metric", "r.value")
