"""Scores, indexes, grades and the layers built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.constants import (
    BASES,
    OVERALL_LABEL,
    OVERALL_SCORE,
    POPULATION,
    label_col,
    percentile_col,
    rate_col,
    score_col,
    winsorized_col,
    z_col,
)
from arealens.functions.rates import round_decimal
from arealens.operators.crosswalk import allocate_counties, allocated_annual, county_annual, county_population, normalize_weights
from arealens.operators.layers import county_layer, modeled_annual, modeled_layer, national_coverage
from arealens.operators.materialize import materialize
from arealens.operators.quality import apply_quality, area_coverage, counted_incidents, coverage_ratios
from arealens.operators.scores import (
    add_labels,
    add_overall_percentile,
    apply_scope,
    build_index,
    internal_indexes,
    logistic_scores,
    overall_score,
    percentile_scores,
    score_rates,
    winsorize,
    z_scores,
)
from arealens.plans.area_queries import AREA_COVERAGE, DATED, RATIOS
from arealens.plans.bindings import (
    each_line_year,
    agency_offenses,
    brand_states,
    line_incidents,
    part_annual,
    part_assignments,
    part_crosswalk,
    part_population,
    scoped_annual,
    undated_lines,
)
from arealens.plans.checks import (
    ASSIGN,
    BASE,
    INC,
    LABELS,
    POP,
    clipped,
    percentile,
    percentile_name,
    score_name,
    scored,
    z_score,
)
from arealens.plans.registry import query, table

KEYS, GROUPS = ["zcta", "year"], ["year"]


def _rounded(df, columns, digits):
    return df.withColumns({c: round_decimal(F.col(c), digits) for c in columns})


@query("winsorized", f"""{BASE}, {clipped('year')}
SELECT zcta, year, {", ".join(f"round(w_{b}, 9) AS {b}_rate_winsorized_per_1000" for b in BASES)} FROM win""")
def winsorized(spark, folder):
    columns = {rate_col(b): winsorized_col(b) for b in BASES}
    out = winsorize(part_annual(spark, folder), columns, GROUPS)
    return _rounded(out.select(*KEYS, *columns.values()), columns.values(), 9)


@query("percentile_scores", f"""{BASE},
rnk AS (SELECT *, {", ".join(f"{percentile(f'{b}_rate_per_1000', 'year')} AS p_{b}" for b in BASES)} FROM ann)
SELECT zcta, year, {", ".join(f"round(p_{b}, 9) AS {percentile_name(b)}, round_even(p_{b} * 100 * 10, 0) / 10 AS {score_name(b)}" for b in BASES)} FROM rnk""")
def percentiles(spark, folder):
    columns = {rate_col(b): (percentile_col(b), score_col(b)) for b in BASES}
    out = percentile_scores(part_annual(spark, folder), columns, GROUPS)
    names = [n for pair in columns.values() for n in pair]
    return _rounded(out.select(*KEYS, *names), [percentile_col(b) for b in BASES], 9)


@query("z_scores", f"""{BASE},
zs AS (SELECT zcta, year, {", ".join(f"{z_score(f'{b}_rate_per_1000', 'year')} AS z_{b}" for b in BASES)} FROM ann)
SELECT zcta, year, {", ".join(f"round(z_{b}, 6) AS {b}_z_score, round(100 / (1 + exp(-round(z_{b}, 6))), 3) AS {b}_logistic_score_0_100" for b in BASES)} FROM zs""")
def standardised(spark, folder):
    columns = {rate_col(b): z_col(b) for b in BASES}
    out = _rounded(z_scores(part_annual(spark, folder), columns, GROUPS).select(*KEYS, *columns.values()), columns.values(), 6)
    logistic = logistic_scores(out, list(columns.values()), digits=3)
    return _rounded(logistic, [c for c in logistic.columns if "logistic" in c], 3)


def _scored(spark, folder):
    return overall_score(internal_indexes(score_rates(scoped_annual(spark, folder))))


@query("overall_score", f"""{BASE}, {scored()}
SELECT zcta, year, {", ".join(score_name(b) for b in BASES)}, overall_incident_score_0_100, score_notes FROM ovr""")
def composite(spark, folder):
    return _scored(spark, folder).select(*KEYS, *[score_col(b) for b in BASES], OVERALL_SCORE, "score_notes")


@query("internal_index", f"""{BASE}, {scored()}
SELECT zcta, year, round(100 + 15 * z_violent, 5) AS violent_index, round(100 + 15 * z_property, 5) AS property_index,
  round(100 + 15 * z_total, 5) AS total_index, round(100 + 15 * (0.6 * z_violent + 0.35 * z_property + 0.05 * z_total), 5) AS composite_index FROM ovr""")
def indexes(spark, folder):
    names = ["violent_index", "property_index", "total_index", "composite_index"]
    return _rounded(_scored(spark, folder).select(*KEYS, *names), names, 5)


@query("overall_percentile", f"""{BASE}, {scored()}
SELECT zcta, year, round({percentile('overall_incident_score_0_100', 'year')}, 9) AS overall_percentile FROM ovr""")
def overall_rank(spark, folder):
    out = add_overall_percentile(_scored(spark, folder)).select(*KEYS, "overall_percentile")
    return _rounded(out, ["overall_percentile"], 9)


@query("labels", f"""{BASE}, {scored()} SELECT zcta, year, overall_incident_score_0_100, {LABELS} FROM ovr""")
def labels(spark, folder):
    return add_labels(_scored(spark, folder)).select(*KEYS, OVERALL_SCORE, *[label_col(b) for b in BASES], OVERALL_LABEL)


def _index_cells(group: str) -> str:
    return ", ".join(
        f"round({b}_rate_per_1000, 9) AS {b}_rate_per_1000, round(w_{b}, 9) AS {b}_rate_winsorized_per_1000, {score_name(b)}, "
        f"round(p_{b}, 9) AS {percentile_name(b)}, round(z_{b}, 6) AS {b}_z_score"
        for b in BASES
    ) + f", overall_incident_score_0_100, round({percentile('overall_incident_score_0_100', group)}, 9) AS overall_percentile"


INDEX_NAMES = [n for b in BASES for n in (rate_col(b), winsorized_col(b), score_col(b), percentile_col(b), z_col(b))] + [
    OVERALL_SCORE, "overall_percentile",
]


def _index_view(df, extra):
    out = df.select(*KEYS, *extra, *INDEX_NAMES)
    fine = [n for n in INDEX_NAMES if n.endswith(("per_1000", "percentile"))]
    return _rounded(_rounded(out, fine, 9), [z_col(b) for b in BASES], 6)


@query("scope_state_index", f"""{BASE.replace("ann AS (", "ann0 AS (")},
st AS (SELECT CAST(p_partkey AS VARCHAR) AS zcta, CASE WHEN p_brand = 'Brand#7' THEN 'unknown' ELSE p_brand END AS v FROM part),
ann AS (SELECT a.*, coalesce(s.v, 'unknown') AS comparison_scope_value FROM ann0 a LEFT JOIN st s USING (zcta)), {scored('year, comparison_scope_value')}
SELECT zcta, year, comparison_scope_value, {_index_cells('year, comparison_scope_value')} FROM ovr""")
def scope_state_index(spark, folder):
    scoped = apply_scope(part_annual(spark, folder), "state", brand_states(spark, folder))
    return _index_view(build_index(scoped), ["comparison_scope_value"])


GRADED_COLUMNS = [
    "coverage_status", "data_source_type", "source_names", "source_count", "assigned_incident_count", "spatial_incident_count",
    "observed_level", "county_count", "data_coverage_score", "confidence_grade", "score_notes", "is_modeled",
]


#: From scored rows (ovr), coverage (cov) and yearly ratios (rat) to the graded index.
GRADED = """q AS (SELECT o.zcta, o.year, o.population_total, o.total_incident_count, o.overall_incident_score_0_100, o.score_notes AS n0,
    coalesce(c.assigned_count, 0) AS a, coalesce(c.spatial_count, 0) AS s, coalesce(c.source_count, 0) AS source_count,
    coalesce(c.source_names, '') AS source_names, coalesce(c.spatial_assignment_share, r.spatial_assignment_rate) AS share,
    0.35 * r.zcta_assignment_rate AS t1, r.offense_classification_rate AS oc, r.date_completeness_rate AS dc
  FROM ovr o LEFT JOIN cov c USING (zcta, year) LEFT JOIN rat r USING (year)),
g AS (SELECT *, round_even((t1 + 0.25::DOUBLE * share + 0.20::DOUBLE * oc + 0.10::DOUBLE * dc + 0.10::DOUBLE * CASE WHEN population_total IS NULL THEN 0 ELSE 1 END) * 1000, 0) / 1000 AS cvr FROM q)
SELECT zcta, year, overall_incident_score_0_100,
  CASE WHEN a > 0 THEN 'observed' ELSE 'national_modeled' END AS coverage_status, CASE WHEN a > 0 THEN 'observed' ELSE 'modeled' END AS data_source_type,
  source_names, source_count, a AS assigned_incident_count, s AS spatial_incident_count, CASE WHEN a > 0 THEN 'zcta' ELSE '' END AS observed_level,
  CAST(0 AS BIGINT) AS county_count, cvr AS data_coverage_score,
  CASE WHEN population_total IS NULL OR population_total < 100 THEN 'D'
       WHEN share >= 0.9 AND cvr >= 0.85 AND total_incident_count >= 20 AND population_total >= 1000 THEN 'A'
       WHEN total_incident_count < 5 THEN 'C' WHEN share >= 0.7 AND cvr >= 0.7 AND population_total >= 500 THEN 'B' WHEN cvr >= 0.5 THEN 'C' ELSE 'D' END AS confidence_grade,
  CASE WHEN total_incident_count < 5 THEN CASE WHEN n0 IS NULL THEN 'low_incident_count' ELSE n0 || '; low_incident_count' END ELSE n0 END AS score_notes,
  false AS is_modeled
FROM g"""


@query("graded_index", f"{BASE}, {ASSIGN}, {DATED}, {RATIOS}, {AREA_COVERAGE}, {scored()}, {GRADED}")
def graded_index(spark, folder):
    counted = materialize(counted_incidents(undated_lines(spark, folder), part_assignments(spark, folder)), "counted")
    index = build_index(scoped_annual(spark, folder), coverage_ratios(counted), area_coverage(counted))
    return index.select(*KEYS, OVERALL_SCORE, *GRADED_COLUMNS)


@query("partial_observed", f"""{BASE},
big AS (SELECT zcta, year, population_total * 40 AS population_total, total_incident_count FROM ann)
SELECT zcta, year, CASE WHEN population_total >= 50000 AND total_incident_count < 20 THEN 'partial_observed' ELSE 'observed' END AS coverage_status,
  CASE WHEN population_total >= 50000 AND total_incident_count < 20 THEN
    CASE WHEN total_incident_count < 5 THEN 'low_incident_count; ' ELSE '' END || 'partial_observed_high_population_low_incident_count'
    WHEN total_incident_count < 5 THEN 'low_incident_count' END AS score_notes
FROM big""")
def partial_observed(spark, folder):
    annual = part_annual(spark, folder).withColumn(POPULATION, F.col(POPULATION) * 40).withColumn("score_notes", F.lit(None).cast("string"))
    every = line_incidents(spark, folder).select("incident_id", "zcta", F.lit("spatial_join").alias("assignment_method"))
    seen = annual.select(
        "zcta", "year", F.col("total_incident_count").alias("assigned_count"), F.col("total_incident_count").alias("spatial_count"),
        F.lit(1).alias("source_count"), F.lit("lines").alias("source_names"), F.lit(1.0).alias("spatial_assignment_share"),
    )
    ratios = coverage_ratios(counted_incidents(undated_lines(spark, folder), every))
    return apply_quality(annual, ratios, seen).select(*KEYS, "coverage_status", "score_notes")


# --- crosswalk and layers -------------------------------------------------------

RAW_CROSSWALK = """rx AS (
  SELECT CAST(l_partkey AS VARCHAR) AS zcta, CAST(l_suppkey AS VARCHAR) AS county_fips, any_value(s_name) AS county_name,
    'N' || CAST(any_value(s_nationkey) AS VARCHAR) AS state_code, coalesce(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END), 0) AS w0
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""

CROSSWALK = f"""{RAW_CROSSWALK},
fx AS (SELECT *, CASE WHEN w0 > 0 THEN w0 ELSE 1.0::DOUBLE / count(*) OVER (PARTITION BY zcta) END AS w1 FROM rx),
xw AS (SELECT zcta, county_fips, county_name, state_code, w1 / sum(w1) OVER (PARTITION BY zcta) AS allocation_weight FROM fx)"""

COUNTY_POP = """cpop AS (
  SELECT county_fips, county_name, state_code, '' AS state_name, year, CAST(round_even(coalesce(sum(population_total * allocation_weight), 0), 0) AS BIGINT) AS population_total
  FROM xw JOIN pop USING (zcta) GROUP BY 1, 2, 3, 4, 5)"""

COUNTY_ANN = """off AS (
  SELECT CASE WHEN l_suppkey % 9 = 5 THEN 'X' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS county_fips, year(l_shipdate) AS year, CASE WHEN l_quantity < 49 THEN l_quantity ELSE 0 END AS v,
    l_linenumber * 2 AS p, CASE l_returnflag WHEN 'A' THEN '8' WHEN 'N' THEN '10' ELSE '11' END AS tn, l_linenumber < 6 AS labelled
  FROM lineitem),
cagg AS (SELECT county_fips, CAST(year AS INTEGER) AS year, CAST(sum(v) AS BIGINT) AS violent_incident_count, CAST(sum(p) AS BIGINT) AS property_incident_count,
    CAST(sum(v) + sum(p) AS BIGINT) AS total_incident_count, count(*) FILTER (labelled) AS agency_count, count(*) FILTER (tn = '8') AS city_agency_count,
    count(*) FILTER (tn = '10') AS county_agency_count, string_agg(DISTINCT 'Table ' || tn, '|' ORDER BY 'Table ' || tn) AS source_names
  FROM off GROUP BY 1, 2),
cann AS (SELECT a.*, p.population_total, s.s_name AS county_name, 'N' || CAST(s.s_nationkey AS VARCHAR) AS state_code,
    CASE WHEN p.population_total > 0 THEN a.total_incident_count::DOUBLE / p.population_total * 1000 END AS total_rate_per_1000,
    CASE WHEN p.population_total > 0 THEN a.violent_incident_count::DOUBLE / p.population_total * 1000 END AS violent_rate_per_1000,
    CASE WHEN p.population_total > 0 THEN a.property_incident_count::DOUBLE / p.population_total * 1000 END AS property_rate_per_1000
  FROM cagg a LEFT JOIN cpop p USING (county_fips, year) JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = ltrim(a.county_fips, 'X'))"""

ALLOCATION = """al0 AS (
  SELECT x.zcta, p.year, x.county_fips, c.county_name, c.state_code, x.allocation_weight AS w0, p.population_total AS zpop, c.population_total AS cp,
    c.total_rate_per_1000 AS tr, c.violent_rate_per_1000 AS vr, c.property_rate_per_1000 AS pr
  FROM xw x JOIN pop p USING (zcta) JOIN cann c ON c.county_fips = x.county_fips AND c.year = p.year WHERE p.population_total > 0),
alc AS (SELECT *, w0 / sum(w0) OVER (PARTITION BY zcta, year) AS w FROM al0)"""

ALLOCATED = """aln AS (
  SELECT zcta, year, any_value(zpop) AS population_total, CAST(round_even(sum(zpop * w * tr / 1000), 0) AS BIGINT) AS total_incident_count,
    CAST(round_even(sum(zpop * w * vr / 1000), 0) AS BIGINT) AS violent_incident_count, CAST(round_even(sum(zpop * w * pr / 1000), 0) AS BIGINT) AS property_incident_count,
    count(DISTINCT county_fips) AS county_count, string_agg(county_fips, '|' ORDER BY county_fips) AS county_fips,
    string_agg(county_name, '|' ORDER BY county_name) AS county_name, list({'f': county_fips, 'w': round(w, 6)} ORDER BY county_fips) AS parts
  FROM alc GROUP BY zcta, year)"""

COUNTY_STACK = f"WITH {INC}, {POP}, {CROSSWALK}, {COUNTY_POP}, {COUNTY_ANN}, {ALLOCATION}, {ALLOCATED}"


def _crosswalk(spark, folder):
    return normalize_weights(
        part_crosswalk(spark, folder), "zcta", ["county_fips", "county_name", "state_code", "state_name"], "allocation_weight"
    )


def _county_annual(spark, folder, crosswalk):
    people = county_population(crosswalk, part_population(spark, folder))
    return county_annual(agency_offenses(spark, folder), people)


def _allocation(spark, folder, by_county=True):
    # Read by both the county populations and the allocation, in one plan: both start from the same shuffle of links by area,
    # which runs once, and the populations need no other.
    crosswalk = _crosswalk(spark, folder)
    return allocate_counties(crosswalk, part_population(spark, folder), _county_annual(spark, folder, crosswalk), by_county)


def _allocated(spark, folder):
    return allocated_annual(_allocation(spark, folder, by_county=False), part_population(spark, folder))


@query("crosswalk_weights", f"WITH {CROSSWALK} SELECT zcta, county_fips, state_code, round(allocation_weight, 12) AS allocation_weight FROM xw")
def crosswalk_weights(spark, folder):
    out = _crosswalk(spark, folder).select("zcta", "county_fips", "state_code", "allocation_weight")
    return _rounded(out, ["allocation_weight"], 12)


@query("county_population", f"WITH {INC}, {POP}, {CROSSWALK}, {COUNTY_POP} SELECT * FROM cpop")
def county_people(spark, folder):
    return county_population(_crosswalk(spark, folder), part_population(spark, folder))


COUNTY_NAMES = ["county_fips", "year", "population_total", "total_incident_count", "violent_incident_count", "property_incident_count",
                "agency_count", "city_agency_count", "county_agency_count", "source_names"]


@query("county_annual", f"""WITH {INC}, {POP}, {CROSSWALK}, {COUNTY_POP}, {COUNTY_ANN}
SELECT {", ".join(COUNTY_NAMES)}, round(total_rate_per_1000, 6) AS total_rate_per_1000, round(violent_rate_per_1000, 6) AS violent_rate_per_1000 FROM cann""")
def county_rollup(spark, folder):
    out = _county_annual(spark, folder, _crosswalk(spark, folder)).select(*COUNTY_NAMES, "total_rate_per_1000", "violent_rate_per_1000")
    return _rounded(out, ["total_rate_per_1000", "violent_rate_per_1000"], 6)


@query("county_allocation", f"""{COUNTY_STACK}
SELECT zcta, year, county_fips, round(w, 12) AS allocation_weight, zpop AS zcta_population_total, cp AS county_population_total,
  round(zpop * w * tr / 1000, 6) AS allocated_total_incident_count, round(zpop * w * vr / 1000, 6) AS allocated_violent_incident_count FROM alc""")
def county_allocation(spark, folder):
    out = _allocation(spark, folder).select(
        "zcta", "year", "county_fips", "allocation_weight", "zcta_population_total", "county_population_total",
        "allocated_total_incident_count", "allocated_violent_incident_count",
    )
    return _rounded(_rounded(out, ["allocation_weight"], 12), ["allocated_total_incident_count", "allocated_violent_incident_count"], 6)


@query("allocated_annual", f"""{COUNTY_STACK}
SELECT zcta, year, population_total, total_incident_count, violent_incident_count, property_incident_count, CAST(NULL AS BIGINT) AS drug_incident_count,
  county_count, county_fips, county_name, parts[1].f AS first_county, CAST(len(parts) AS BIGINT) AS component_count,
  'county_observed_allocated' AS comparison_scope FROM aln""")
def allocated_counts(spark, folder):
    parts = F.from_json("county_components", "array<struct<county_fips:string,county_name:string,weight:double>>")
    return _allocated(spark, folder).select(
        "zcta", "year", "population_total", "total_incident_count", "violent_incident_count", "property_incident_count", "drug_incident_count",
        "county_count", "county_fips", "county_name", parts[0]["county_fips"].alias("first_county"),
        F.size(parts).cast("long").alias("component_count"), "comparison_scope",
    )


COUNTY_INDEX = f"""{COUNTY_STACK},
ann AS (SELECT zcta, year, population_total, county_count, total_incident_count, total_incident_count::DOUBLE / population_total * 1000 AS total_rate_per_1000,
    violent_incident_count::DOUBLE / population_total * 1000 AS violent_rate_per_1000, property_incident_count::DOUBLE / population_total * 1000 AS property_rate_per_1000,
    CAST(NULL AS DOUBLE) AS drug_rate_per_1000, CAST(NULL AS DOUBLE) AS public_order_rate_per_1000, CAST(NULL AS DOUBLE) AS weapons_rate_per_1000,
    CAST(NULL AS DOUBLE) AS other_rate_per_1000 FROM aln)"""

LAYER_NOTE = "county rates allocated to areas"


@query("county_layer", f"""{COUNTY_INDEX}, {scored()}
SELECT zcta, year, total_incident_score_0_100, violent_score_0_100, property_score_0_100, overall_incident_score_0_100,
  'county_observed_allocated' AS coverage_status, county_count AS source_count, CASE WHEN population_total < 500 THEN 0.55::DOUBLE ELSE 0.75 END AS data_coverage_score,
  CASE WHEN population_total < 500 THEN 'C' WHEN county_count = 1 THEN 'B' ELSE 'C' END AS confidence_grade,
  concat_ws('; ', score_notes, CASE WHEN total_incident_count < 5 THEN 'low_incident_count' END, '{LAYER_NOTE}') AS score_notes FROM ovr""")
def county_observed(spark, folder):
    return county_layer(_allocated(spark, folder), "agency_tables", LAYER_NOTE, [
        *KEYS, "total_incident_score_0_100", "violent_score_0_100", "property_score_0_100", OVERALL_SCORE,
        "coverage_status", "source_count", "data_coverage_score", "confidence_grade", "score_notes",
    ])


@query("modeled_baseline", f"""
WITH {POP}, m AS (SELECT *, CASE WHEN population_total > 0 THEN CAST(round_even(population_total * 3.708::DOUBLE / 1000, 0) AS BIGINT) END AS v,
    CASE WHEN population_total > 0 THEN CAST(round_even(population_total * 18.351::DOUBLE / 1000, 0) AS BIGINT) END AS p FROM pop)
SELECT zcta, year, population_total, 'national_modeled_baseline' AS comparison_scope, v AS violent_incident_count, p AS property_incident_count,
  coalesce(v, 0) + coalesce(p, 0) AS total_incident_count, CAST(NULL AS BIGINT) AS weapons_incident_count FROM m""")
def modeled_counts(spark, folder):
    return modeled_annual(part_population(spark, folder)).select(
        "zcta", "year", "population_total", "comparison_scope", "violent_incident_count", "property_incident_count",
        "total_incident_count", "weapons_incident_count",
    )


MODEL_NOTE = "uniform national rates"


@query("neutralized", f"""
WITH {POP}, m AS (SELECT *, population_total > 0 AS ok FROM pop WHERE population_total IS NOT NULL)
SELECT zcta, year, CASE WHEN ok THEN 3.708::DOUBLE END AS violent_rate_per_1000, CASE WHEN ok THEN 3.708::DOUBLE + 18.351::DOUBLE END AS total_rate_per_1000,
  CASE WHEN ok THEN 50.0::DOUBLE END AS overall_incident_score_0_100, CASE WHEN ok THEN 0.5::DOUBLE END AS percentile_rank, CASE WHEN ok THEN 0.0::DOUBLE END AS drug_z_score,
  CASE WHEN ok THEN 100.0::DOUBLE END AS composite_index, CAST(NULL AS DOUBLE) AS drug_score_0_100, CASE WHEN ok THEN 'average' ELSE 'unavailable' END AS overall_incident_score_label,
  'unavailable' AS drug_score_label, 'national_modeled' AS coverage_status, true AS is_modeled,
  CASE WHEN population_total >= 500 THEN 0.35::DOUBLE ELSE 0.2 END AS data_coverage_score, CASE WHEN population_total >= 500 THEN 'C' ELSE 'D' END AS confidence_grade,
  concat_ws('; ', CASE WHEN ok THEN 'renormalized_missing_categories:drug,public_order,weapons,other' ELSE 'overall_score_unavailable_no_category_scores' END,
    CASE WHEN NOT ok OR round_even(population_total * 3.708::DOUBLE / 1000, 0) + round_even(population_total * 18.351::DOUBLE / 1000, 0) < 5 THEN 'low_incident_count' END, '{MODEL_NOTE}') AS score_notes
FROM m""")
def neutral_layer(spark, folder):
    return modeled_layer(part_population(spark, folder), "baseline", MODEL_NOTE).select(
        *KEYS, "violent_rate_per_1000", "total_rate_per_1000", OVERALL_SCORE, "percentile_rank", "drug_z_score", "composite_index",
        "drug_score_0_100", OVERALL_LABEL, "drug_score_label", "coverage_status", "is_modeled", "data_coverage_score",
        "confidence_grade", "score_notes",
    )


@query("national_coverage", f"""WITH {INC}, {POP}, {ASSIGN}, {AREA_COVERAGE},
cty AS (SELECT CAST(p_partkey AS VARCHAR) AS zcta, CASE WHEN p_size > 5 THEN CAST(p_size AS BIGINT) ELSE 1 END AS k FROM part WHERE p_size < 30)
SELECT p.zcta, p.year, p.population_total,
  CAST(CASE WHEN c.assigned_count IS NOT NULL THEN c.source_count WHEN t.k IS NOT NULL THEN t.k ELSE 0 END AS BIGINT) AS source_count,
  CASE WHEN c.assigned_count IS NOT NULL THEN c.source_names WHEN t.k IS NOT NULL THEN 'tables' ELSE '' END AS source_names,
  coalesce(c.assigned_count, 0) AS assigned_incident_count, coalesce(c.spatial_count, 0) AS spatial_incident_count,
  CASE WHEN c.assigned_count IS NOT NULL THEN 'observed' WHEN t.k IS NOT NULL THEN 'county_observed_allocated' ELSE 'national_modeled' END AS coverage_status,
  CASE WHEN c.assigned_count IS NOT NULL OR t.k IS NOT NULL THEN 'observed' ELSE 'modeled' END AS data_source_type,
  CASE WHEN c.assigned_count IS NOT NULL THEN NULL WHEN t.k IS NOT NULL THEN 'from counties' ELSE 'no source' END AS coverage_notes
FROM pop p LEFT JOIN cov c USING (zcta, year) LEFT JOIN cty t USING (zcta)""")
def coverage_cascade(spark, folder):
    by_area = area_coverage(counted_incidents(undated_lines(spark, folder), part_assignments(spark, folder)))
    county = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("zcta"), F.when(F.col("p_size") > 5, F.col("p_size")).alias("county_count"),
        F.lit(None).cast("string").alias("source_names"),
        F.when(F.col("p_size") < 30, "county_observed_allocated").otherwise("national_modeled").alias("coverage_status"),
    )
    county = each_line_year(spark, folder, county)
    return national_coverage(part_population(spark, folder), by_area, county, "tables", "from counties", "no source")

