"""Polygons, assignment, counts and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.constants import COUNT_COLUMNS, RATE_COLUMNS
from arealens.functions.geo import bounding_box, centroid, edges_from_wkt, rings_from_wkt, signed_area
from arealens.operators.aggregate import add_rates, annual_aggregates, count_by_group, monthly_aggregates
from arealens.operators.assign import (
    assign_areas,
    assignment_summary,
    attach_located,
    join_assignments,
    locate_points,
)
from arealens.operators.quality import area_coverage, counted_incidents, coverage_ratios
from arealens.operators.scores import apply_scope
from arealens.plans.bindings import (
    brand_states,
    event_points,
    line_incidents,
    part_annual,
    part_assignments,
    part_population,
    supplier_polygons,
    undated_lines,
)
from arealens.plans.checks import ASSIGN, BASE, CATS, COUNTS, INC, POINTS, POP, SHAPES, WITHIN, counts, rates
from arealens.plans.registry import query
from arealens.sources.tables import geometry_summary, normalize_geometries


@query("polygon_prep", f"""
WITH {SHAPES}
SELECT zcta, CAST(CASE kind WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS rings, CAST(CASE kind WHEN 0 THEN 4 WHEN 1 THEN 8 ELSE 3 END AS BIGINT) AS edges,
  CASE kind WHEN 0 THEN 1::DOUBLE WHEN 1 THEN 0.75 ELSE 0.3885 END AS area,
  round(CASE kind WHEN 2 THEN y + 0.259 ELSE y + 0.5 END, 6) AS centroid_lat, round(CASE kind WHEN 2 THEN x + 2 / 3.0 ELSE x + 0.5 END, 6) AS centroid_lon,
  x AS min_lon, x + 1 AS max_lon, y AS min_lat, CASE kind WHEN 2 THEN round(y + 0.777, 3) ELSE y + 1 END AS max_lat
FROM shp""")
def polygon_prep(spark, folder):
    edges = edges_from_wkt(F.col("geom_wkt"))
    shaped = supplier_polygons(spark, folder).select("zcta", edges.alias("e"), rings_from_wkt(F.col("geom_wkt")).alias("r"))
    lat, lon = centroid(F.col("e"))
    return shaped.select(
        "zcta",
        F.size("r").cast("long").alias("rings"),
        F.size("e").cast("long").alias("edges"),
        F.round(F.abs(signed_area(F.col("e"))), 6).alias("area"),
        F.round(lat, 6).alias("centroid_lat"),
        F.round(lon, 6).alias("centroid_lon"),
        *[expr.alias(name) for name, expr in bounding_box(F.col("e")).items()],
    )


@query("geometry_table", f"""
WITH {SHAPES},
k AS (SELECT *, 10000 + CAST(zcta AS INTEGER) % 60 AS key, row_number() OVER (PARTITION BY CAST(zcta AS INTEGER) % 60 ORDER BY zcta DESC) AS rn FROM shp)
SELECT CAST(key AS VARCHAR) AS zcta, 'G' || zcta AS geoid, state_fips, CAST(zcta AS INTEGER) * 10.0::DOUBLE AS land_area,
  CAST(2020 AS INTEGER) AS source_year FROM k WHERE rn = 1""")
def geometry_table(spark, folder):
    features = supplier_polygons(spark, folder).selectExpr(
        "zcta AS _order",
        "map('GEOID20', concat('G', zcta), 'ZCTA5CE20', cast(10000 + cast(zcta AS int) % 60 AS string), 'STATEFP20', state_fips, "
        "'ALAND20', cast(cast(zcta AS int) * 10 AS string)) AS properties",
        "geom_wkt",
    )
    table = normalize_geometries(features, "suppliers", 2020, order=F.col("_order"))
    return table.select("zcta", "geoid", "state_fips", "land_area", "source_year")


@query("geometry_quality", """
SELECT count(*) AS row_count, count(*) FILTER (s_suppkey % 10 = 1) AS empty_geometry_count,
  count(*) FILTER (s_suppkey % 10 IN (2, 3)) AS invalid_geometry_count, count(*) FILTER (s_suppkey % 10 = 0) AS missing_geometry_count
FROM supplier""")
def geometry_quality(spark, folder):
    shapes = supplier_polygons(spark, folder).withColumn("k", F.col("zcta").cast("int") % 10)
    broken = F.expr("""CASE k WHEN 0 THEN NULL WHEN 1 THEN 'POLYGON EMPTY'
        WHEN 2 THEN 'POLYGON ((0 0, 1 1, 1 0, 0 1, 0 0))' WHEN 3 THEN 'POLYGON ((0 0, 1 0, 1 1))' ELSE geom_wkt END""")
    return geometry_summary(shapes.select("zcta", broken.alias("geom_wkt")), "zcta")


LOCATED = f"""loc AS (SELECT p.incident_id, min(s.zcta) AS zcta FROM pts p JOIN shp s ON {WITHIN} GROUP BY p.incident_id)"""


@query("spatial_join", f"""
WITH {SHAPES}, {POINTS}, {LOCATED}
SELECT p.incident_id, l.zcta AS area FROM pts p LEFT JOIN loc l USING (incident_id)""")
def spatial_join(spark, folder):
    points = event_points(spark, folder).select("incident_id", "longitude", "latitude")
    located = locate_points(points, supplier_polygons(spark, folder), "longitude", "latitude", cell=1.0)
    return attach_located(points, located, "longitude", "latitude", {"area": "area"}).select("incident_id", "area")


ASSIGNED = f"""
WITH {SHAPES}, {POINTS},
v AS (SELECT *, lat IS NOT NULL AND NOT (lat = 0 AND lon = 0) AS valid,
    CASE upper(st) WHEN 'CA' THEN lat BETWEEN 32.4 AND 42.1 AND lon BETWEEN -124.6 AND -114.0
         WHEN 'NV' THEN lat BETWEEN 35.0 AND 42.1 AND lon BETWEEN -120.1 AND -114.0 ELSE true END AS in_state FROM pts),
u AS (SELECT *, valid AND coalesce(in_state, false) AS usable, CASE upper(st) WHEN 'CA' THEN '06' WHEN 'NV' THEN '32' END AS expected FROM v),
loc AS (SELECT p.incident_id, min(s.zcta) AS zcta FROM u p JOIN shp s ON p.usable AND {WITHIN} GROUP BY p.incident_id),
j AS (SELECT u.*, l.zcta AS spot, s1.state_fips AS spot_state, k.state_fips AS key_state,
        u.zkey IS NOT NULL AND NOT u.usable AND l.zcta IS NULL AS tries_key, k.state_fips IS NOT NULL AS key_ok
      FROM u LEFT JOIN loc l USING (incident_id) LEFT JOIN shp s1 ON s1.zcta = l.zcta LEFT JOIN shp k ON k.zcta = u.zkey),
m AS (SELECT *, CASE WHEN spot IS NOT NULL THEN 'spatial_join' WHEN tries_key AND key_ok THEN 'zip_fallback' ELSE 'unassigned' END AS first_method FROM j),
c AS (SELECT *, CASE first_method WHEN 'spatial_join' THEN coalesce(spot_state <> expected, false)
                      WHEN 'zip_fallback' THEN coalesce(key_state <> expected, false) ELSE false END AS clash FROM m),
res AS (SELECT incident_id,
  CASE WHEN clash THEN NULL WHEN first_method = 'spatial_join' THEN spot WHEN first_method = 'zip_fallback' THEN zkey END AS zcta,
  CASE WHEN clash THEN 'unassigned' ELSE first_method END AS assignment_method,
  CASE WHEN clash OR first_method = 'unassigned' THEN 'none' WHEN first_method = 'spatial_join' THEN 'high' ELSE 'medium' END AS assignment_confidence,
  CASE WHEN clash AND first_method = 'spatial_join' THEN 'valid_coordinates_outside_expected_state'
       WHEN clash THEN 'zip_fallback_outside_expected_state'
       WHEN first_method = 'spatial_join' THEN NULL WHEN first_method = 'zip_fallback' THEN 'missing_or_invalid_coordinates_used_zip'
       WHEN tries_key THEN 'zip_fallback_without_loaded_zcta_geometry'
       WHEN valid AND NOT usable THEN 'valid_coordinates_outside_expected_state'
       WHEN usable THEN 'valid_coordinates_outside_loaded_zctas' ELSE 'missing_coordinates_and_zip' END AS assignment_notes
FROM c)"""


def _assigned(spark, folder):
    return assign_areas(event_points(spark, folder), supplier_polygons(spark, folder), cell=1.0)


@query("assignment_table", f"{ASSIGNED} SELECT * FROM res")
def assignment_table(spark, folder):
    return _assigned(spark, folder).drop("assigned_at")


@query("assignment_summary", f"{ASSIGNED} SELECT assignment_method, count(*) AS incident_rows FROM res GROUP BY 1")
def assignment_totals(spark, folder):
    return assignment_summary(_assigned(spark, folder))


@query("assigned_counts", f"""
WITH {INC}, {ASSIGN}
SELECT assigned_zcta AS zcta, year AS occurred_year, {counts()} FROM inc JOIN one USING (incident_id)
WHERE assigned_zcta IS NOT NULL GROUP BY 1, 2""")
def assigned_counts(spark, folder):
    incidents = line_incidents(spark, folder).drop("zcta")
    joined = join_assignments(incidents, part_assignments(spark, folder), ["occurred_year", "offense_group"])
    return count_by_group(joined, ["zcta", "occurred_year"])


@query("annual_counts", f"{BASE} SELECT zcta, year, population_total, {COUNTS} FROM ann")
def annual_counts(spark, folder):
    return part_annual(spark, folder).select("zcta", "year", "population_total", *COUNT_COLUMNS)


@query("annual_with_empty", f"""
WITH {INC}, {POP},
cnt AS (SELECT zcta, year, {counts()} FROM inc GROUP BY zcta, year),
uni AS (SELECT zcta, year FROM pop UNION SELECT zcta, year FROM cnt),
ann AS (SELECT u.zcta, u.year, p.population_total, {", ".join(f"coalesce(c.{c}, 0) AS {c}" for c in ["total_incident_count", *[f"{x}_incident_count" for x in CATS]])}
        FROM uni u LEFT JOIN cnt c USING (zcta, year) LEFT JOIN pop p USING (zcta, year))
SELECT *, {rates()} FROM ann""")
def annual_with_empty(spark, folder):
    return part_annual(spark, folder, include_population_only=True)


@query("monthly_counts", f"""
WITH {INC}, {POP},
cnt AS (SELECT zcta, year, month, {counts()} FROM inc GROUP BY zcta, year, month),
spine AS (SELECT a.zcta, a.year, CAST(m AS INTEGER) AS month FROM (SELECT DISTINCT zcta, year FROM cnt) a, range(1, 13) AS t(m)),
ann AS (SELECT s.month, s.zcta, s.year, p.population_total, {", ".join(f"coalesce(c.{c}, 0) AS {c}" for c in ["total_incident_count", *[f"{x}_incident_count" for x in CATS]])}
        FROM spine s LEFT JOIN cnt c USING (zcta, year, month) LEFT JOIN pop p USING (zcta, year))
SELECT *, {rates()} FROM ann""")
def monthly_counts(spark, folder):
    return monthly_aggregates(line_incidents(spark, folder), part_population(spark, folder))


@query("safe_rates", f"""{BASE},
pc AS (SELECT zcta, year, {COUNTS}, population_total // 2 AS population_total FROM ann)
SELECT zcta, year, population_total AS adults, {rates()} FROM pc""")
def safe_rates(spark, folder):
    halved = part_annual(spark, folder).select("zcta", "year", *COUNT_COLUMNS, F.expr("population_total div 2").alias("adults"))
    return add_rates(halved, population="adults").select("zcta", "year", "adults", *RATE_COLUMNS)


@query("area_scope", f"""{BASE},
st AS (SELECT CAST(p_partkey AS VARCHAR) AS zcta, CASE WHEN p_brand = 'Brand#7' THEN 'unknown' ELSE p_brand END AS v FROM part)
SELECT zcta, year, 'state' AS comparison_scope, coalesce(v, 'unknown') AS comparison_scope_value FROM ann LEFT JOIN st USING (zcta)""")
def area_scope(spark, folder):
    scoped = apply_scope(part_annual(spark, folder), "state", brand_states(spark, folder))
    return scoped.select("zcta", "year", "comparison_scope", "comparison_scope_value")


DATED = """inc2 AS (SELECT *, month > 1 AS dated FROM inc)"""

RATIOS = """rat AS (
  SELECT year, CAST(sum(n) AS BIGINT) AS incident_total,
    sum(CASE WHEN assigned_zcta IS NOT NULL THEN n ELSE 0 END) / sum(n)::DOUBLE AS zcta_assignment_rate,
    sum(CASE WHEN method = 'spatial_join' THEN n ELSE 0 END) / sum(n)::DOUBLE AS spatial_assignment_rate,
    sum(CASE WHEN cat <> 'unknown' THEN n ELSE 0 END) / sum(n)::DOUBLE AS offense_classification_rate,
    sum(CASE WHEN dated THEN n ELSE 0 END) / sum(n)::DOUBLE AS date_completeness_rate
  FROM inc2 LEFT JOIN one USING (incident_id) GROUP BY year)"""

AREA_COVERAGE = """cov AS (
  SELECT assigned_zcta AS zcta, year, CAST(sum(n) AS BIGINT) AS assigned_count,
    CAST(sum(CASE WHEN method = 'spatial_join' THEN n ELSE 0 END) AS BIGINT) AS spatial_count,
    count(DISTINCT source_name) AS source_count, string_agg(DISTINCT source_name, '|' ORDER BY source_name) AS source_names,
    sum(CASE WHEN method = 'spatial_join' THEN n ELSE 0 END) / sum(n)::DOUBLE AS spatial_assignment_share
  FROM inc JOIN one USING (incident_id) WHERE assigned_zcta IS NOT NULL GROUP BY 1, 2)"""


@query("coverage_ratios", f"WITH {INC}, {ASSIGN}, {DATED}, {RATIOS} SELECT * FROM rat")
def year_ratios(spark, folder):
    return coverage_ratios(counted_incidents(undated_lines(spark, folder), part_assignments(spark, folder)))


@query("area_coverage", f"WITH {INC}, {ASSIGN}, {AREA_COVERAGE} SELECT * FROM cov")
def coverage_by_area(spark, folder):
    return area_coverage(counted_incidents(undated_lines(spark, folder), part_assignments(spark, folder)))

