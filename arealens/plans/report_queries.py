"""Name resolution, gap and quality reports, group profiles, published records and writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.constants import COUNT_COLUMNS, SCORED, rate_col, score_col
from arealens.operators.agencies import (
    agency_name_keys,
    county_names,
    name_lookup,
    primary_county,
    resolve_county_lists,
    resolve_rows,
    unambiguous_names,
)
from arealens.operators.crosswalk import normalize_crosswalk, state_fips_by_area, top_state
from arealens.operators.gaps import gap_totals, gaps_by_state, target_queue, target_totals
from arealens.operators.groups import (
    group_histograms,
    group_profile,
    group_sources,
    latest_records,
    missing_members,
    requested_members,
)
from arealens.operators.materialize import materialize
from arealens.operators.quality import (
    completeness,
    duplicate_metrics,
    key_counts,
    quality_report,
    top_records,
    value_counts,
    weighted_value_counts,
)
from arealens.plans.bindings import (
    line_incidents,
    part_annual,
    part_assignments,
    part_crosswalk,
    scratch,
    supplier_polygons,
    undated_lines,
)
from arealens.plans.checks import ASSIGN, BASE, INC, SHAPES, digest_sql
from arealens.plans.registry import query, table
from arealens.sinks.bundle import (
    area_documents,
    coverage_projection,
    default_scopes,
    geojson_features,
    manifest,
    publishable,
    status_histogram,
    write_documents,
)
from arealens.sinks.slices import append_slices, read_slices, replace_slices
from arealens.sinks.writers import append_aligned, consumer_view, export_table, replace_sources

# --- crosswalk files and names --------------------------------------------------

LINKS = """lk AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS land, sum(l_linenumber) AS water FROM lineitem GROUP BY 1, 2)"""


@query("weight_choice", f"""
WITH {LINKS},
k AS (SELECT lpad(CAST(10000 + l_partkey AS VARCHAR), 5, '0') AS zcta, lpad(CAST(l_suppkey * 91 AS VARCHAR), 5, '0') AS county_fips,
     CASE WHEN l_suppkey % 7 = 0 THEN 0 ELSE land END AS w FROM lk),
f AS (SELECT *, CASE WHEN w > 0 THEN w ELSE 1.0::DOUBLE / count(*) OVER (PARTITION BY zcta) END AS w1 FROM k)
SELECT zcta, county_fips, CASE substr(county_fips, 1, 2) WHEN '06' THEN 'CA' WHEN '01' THEN 'AL' WHEN '02' THEN 'AK' WHEN '04' THEN 'AZ' WHEN '05' THEN 'AR' WHEN '08' THEN 'CO' WHEN '09' THEN 'CT' ELSE '' END AS state_code,
  round(w1 / sum(w1) OVER (PARTITION BY zcta), 12) AS allocation_weight FROM f""")
def weight_choice(spark, folder):
    raw = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("land"), F.sum("l_linenumber").alias("water")
    ).selectExpr(
        "concat('Z ', 10000 + l_partkey) AS GEOID_ZCTA5_20", "cast(l_suppkey * 91 AS string) AS GEOID_COUNTY_20",
        "CASE WHEN l_suppkey % 7 = 0 THEN 'x' ELSE cast(land AS string) END AS AREALAND_PART", "cast(water AS string) AS AREAWATER_PART",
    )
    return normalize_crosswalk(raw, "links").select(
        "zcta", "county_fips", "state_code", F.round("allocation_weight", 12).alias("allocation_weight")
    )


@query("water_weights", f"""
WITH {LINKS}, f AS (SELECT l_partkey, l_suppkey * 91 AS c, water AS w FROM lk)
SELECT CAST(10000 + l_partkey AS VARCHAR) AS zcta, lpad(CAST(c AS VARCHAR), 5, '0') AS county_fips,
  round(w / sum(w) OVER (PARTITION BY l_partkey)::DOUBLE, 12) AS allocation_weight FROM f""")
def water_weights(spark, folder):
    raw = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_linenumber").alias("water")).selectExpr(
        "10000 + l_partkey AS zip", "l_suppkey * 91 AS county", "0 AS AREALAND_PART", "water AS AREAWATER_PART",
    )
    return normalize_crosswalk(raw, "links").select("zcta", "county_fips", F.round("allocation_weight", 12).alias("allocation_weight"))


TOP_STATE = """xs AS (
  SELECT CAST(l_partkey AS VARCHAR) AS zcta, 'N' || CAST(s_nationkey AS VARCHAR) AS state_code, s_name AS county_name,
    sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS w
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, l_suppkey, s_nationkey, s_name),
top AS (SELECT zcta, state_code FROM (SELECT *, row_number() OVER (PARTITION BY zcta ORDER BY w DESC NULLS LAST, state_code) AS rn FROM xs) WHERE rn = 1)"""


@query("top_state", f"WITH {TOP_STATE} SELECT zcta, state_code FROM top")
def heaviest_state(spark, folder):
    return top_state(part_crosswalk(spark, folder))


@query("state_fips_by_area", f"""
WITH {TOP_STATE.replace("'N' || CAST(s_nationkey AS VARCHAR)", "['AL', 'CA', 'ZZ', 'NY', 'TX'][CAST(s_nationkey % 5 AS INT) + 1]")}
SELECT zcta, CASE state_code WHEN 'AL' THEN '01' WHEN 'CA' THEN '06' WHEN 'NY' THEN '36' ELSE '48' END AS state_fips FROM top WHERE state_code <> 'ZZ'""")
def area_state_fips(spark, folder):
    codes = F.expr("element_at(array('AL', 'CA', 'ZZ', 'NY', 'TX'), cast(substring(state_code, 2) AS int) % 5 + 1)")
    return state_fips_by_area(part_crosswalk(spark, folder).withColumn("state_code", codes))


def _supplier_counties(spark, folder):
    """Suppliers as counties of their nation; names repeat across nations."""
    return table(spark, folder, "supplier").selectExpr(
        "concat('N', s_nationkey) AS state_code", "cast(s_suppkey AS string) AS county_fips",
        "concat('St. Ring', s_suppkey % 7, ' County') AS county_name",
    )


COUNTY_KEYS = """ck AS (
  SELECT 'N' || CAST(s_nationkey AS VARCHAR) AS state_code, 'saint ring' || CAST(s_suppkey % 7 AS VARCHAR) AS name_key,
    max(CAST(s_suppkey AS VARCHAR)) AS county_fips, 'St. Ring' || CAST(s_suppkey % 7 AS VARCHAR) || ' County' AS county_name
  FROM supplier GROUP BY 1, 2, 4)"""


@query("county_lists", f"""
WITH {COUNTY_KEYS},
rq AS (SELECT DISTINCT c_custkey, 'N' || CAST(c_nationkey AS VARCHAR) AS state_code, 'saint ring' || CAST(k AS VARCHAR) AS name_key
  FROM customer, unnest([c_custkey % 7, c_custkey % 5, c_custkey % 3]) AS u(k)),
hit AS (SELECT r.c_custkey, c.county_fips, c.county_name FROM rq r JOIN ck c USING (state_code, name_key)),
agg AS (SELECT c_custkey, string_agg(county_fips, '|' ORDER BY county_fips) AS county_fips, string_agg(county_name, '|' ORDER BY county_fips) AS county_name FROM hit GROUP BY 1)
SELECT c.c_custkey, a.county_fips, a.county_name FROM customer c LEFT JOIN agg a USING (c_custkey)""")
def county_lists(spark, folder):
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey", "concat('N', c_nationkey) AS state_code",
        "concat('St Ring', c_custkey % 7, ' Parish; ring', ' and Saint Ring', c_custkey % 5, '/ ST. RING', c_custkey % 3, ' county,') AS counties",
    )
    return resolve_county_lists(rows, county_names(_supplier_counties(spark, folder)), "c_custkey").select(
        "c_custkey", "county_fips", "county_name"
    )


def _agencies(spark, folder):
    """Customers as agencies that name one to three supplier counties."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey", "concat('N', c_nationkey) AS state_code", "concat('Unit n', c_custkey % 40, 'x Police Department') AS agency_name",
        "CASE c_custkey % 4 WHEN 0 THEN cast(c_custkey % 90 AS string) WHEN 1 THEN concat(c_custkey % 90, '|', c_custkey % 37) "
        "WHEN 2 THEN concat(c_custkey % 37, '|', c_custkey % 90, '|', c_custkey % 11) END AS county_fips",
        "CASE c_custkey % 4 WHEN 0 THEN concat('c', c_custkey % 90) WHEN 1 THEN concat('c', c_custkey % 90, '|c', c_custkey % 37) "
        "WHEN 2 THEN concat('c', c_custkey % 37, '|c', c_custkey % 90, '|c', c_custkey % 11) END AS county_name",
    )


def _people(spark, folder):
    return table(spark, folder, "supplier").selectExpr(
        "cast(s_suppkey AS string) AS county_fips", "CASE WHEN s_suppkey % 8 = 0 THEN 0 ELSE cast(s_acctbal AS bigint) + 1000 END AS population_total"
    )


PRIMARY = """ag AS (SELECT c_custkey, 'N' || CAST(c_nationkey AS VARCHAR) AS state_code, 'unit n' || CAST(c_custkey % 40 AS VARCHAR) || 'x' AS name_key,
   CASE c_custkey % 4 WHEN 0 THEN [c_custkey % 90] WHEN 1 THEN [c_custkey % 90, c_custkey % 37] WHEN 2 THEN [c_custkey % 37, c_custkey % 90, c_custkey % 11] END AS l FROM customer),
each AS (SELECT c_custkey, state_code, name_key, l, CAST(unnest(l) AS VARCHAR) AS f FROM ag WHERE l IS NOT NULL),
rk AS (SELECT e.*, CASE WHEN s_suppkey % 8 = 0 THEN 0 ELSE CAST(trunc(s_acctbal) AS BIGINT) + 1000 END AS pop FROM each e LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = e.f),
pri AS (SELECT c_custkey, state_code, name_key, f AS county_fips, 'c' || f AS county_name,
    CASE WHEN len(l) > 1 THEN 'multi_county_agency:' || array_to_string(l, '|') || ';primary_county_by_population' END AS lookup_notes
  FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY pop DESC NULLS LAST, f DESC) AS rn FROM rk WHERE len(l) = 1 OR pop > 0) WHERE rn = 1)"""


@query("primary_county", f"WITH {PRIMARY} SELECT c_custkey, county_fips, county_name, lookup_notes FROM pri")
def main_county(spark, folder):
    return primary_county(_agencies(spark, folder), _people(spark, folder), "c_custkey")


UNIQUE = """uq AS (SELECT state_code, name_key, min(county_fips) AS county_fips, min(county_name) AS county_name, count(*) AS match_count,
    string_agg(DISTINCT lookup_notes, ';' ORDER BY lookup_notes) AS lookup_notes
  FROM pri GROUP BY 1, 2 HAVING count(DISTINCT county_fips) = 1)"""


@query("unique_keys", f"WITH {PRIMARY}, {UNIQUE} SELECT * FROM uq")
def unique_keys(spark, folder):
    agencies = _agencies(spark, folder)
    chosen = primary_county(agencies, _people(spark, folder), "c_custkey")
    return unambiguous_names(agency_name_keys(agencies, "c_custkey").join(chosen, "c_custkey"))


@query("name_county_resolution", f"""
WITH {PRIMARY}, {UNIQUE}, {COUNTY_KEYS},
r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '8' WHEN 'F' THEN '10' ELSE '9' END AS tn, 'N' || CAST(o_custkey % 25 AS VARCHAR) AS state_code, o_custkey % 50 AS k FROM orders),
j AS (SELECT r.*, CASE WHEN tn = '10' THEN c.county_fips ELSE u.county_fips END AS fips, CASE WHEN tn = '10' THEN c.county_name ELSE u.county_name END AS cname,
    u.match_count AS mc, CASE WHEN tn <> '10' THEN u.lookup_notes END AS ln, CASE tn WHEN '8' THEN 'city' WHEN '10' THEN 'county' ELSE 'agency' END AS kind
  FROM r LEFT JOIN ck c ON tn = '10' AND c.state_code = r.state_code AND c.name_key = 'saint ring' || CAST(k % 9 AS VARCHAR)
         LEFT JOIN uq u ON tn <> '10' AND u.state_code = r.state_code AND u.name_key = 'unit n' || CAST(k AS VARCHAR) || 'x')
SELECT o_orderkey, fips AS county_fips, cname AS county_name,
  CASE WHEN fips IS NULL THEN CASE kind WHEN 'county' THEN 'unmatched_county_name' WHEN 'city' THEN 'unmatched_city' ELSE 'unmatched_agency_name' END
       WHEN kind = 'county' THEN 'county_name'
       ELSE CASE kind WHEN 'city' THEN 'agency_city_lookup' ELSE 'agency_name_lookup' END ||
            CASE WHEN ln IS NOT NULL THEN '_primary_county' WHEN mc = 1 THEN '' ELSE '_ambiguous_same_county' END END AS mapping_method,
  CASE WHEN fips IS NULL THEN kind || '_not_found:' || CASE kind WHEN 'county' THEN 'St Ring' || CAST(k % 9 AS VARCHAR) ELSE 'Unit n' || CAST(k AS VARCHAR) || 'x' END ELSE ln END AS mapping_notes
FROM j""")
def name_county_resolution(spark, folder):
    agencies, people = _agencies(spark, folder), _people(spark, folder)
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CASE o_orderstatus WHEN 'O' THEN '8' WHEN 'F' THEN '10' ELSE '9' END AS table_number",
        "concat('N', o_custkey % 25) AS state_code", "concat('Unit n', o_custkey % 50, 'x') AS agency_label",
        "concat('St Ring', (o_custkey % 50) % 9) AS county_label",
    )
    places = name_lookup(agencies, people, "c_custkey", places_only=True)
    named = name_lookup(agencies, people, "c_custkey")
    resolved = resolve_rows(rows, county_names(_supplier_counties(spark, folder)), places, named)
    return resolved.select("o_orderkey", "county_fips", "county_name", "mapping_method", "mapping_notes")


# --- gaps -----------------------------------------------------------------------

UNIVERSE = """uni AS (SELECT CAST(p_partkey AS VARCHAR) AS zcta, CAST(CASE WHEN p_size = 50 THEN 0 ELSE p_size * 2000 END AS BIGINT) AS population_total FROM part),
ob AS (SELECT CAST(l_partkey AS VARCHAR) AS zcta, CASE WHEN l_quantity < 2 THEN 'observed' WHEN l_quantity < 3 THEN NULL ELSE 'partial_observed' END AS coverage_status
       FROM lineitem),
seen AS (SELECT DISTINCT zcta FROM ob WHERE coalesce(coverage_status, 'observed') = 'observed'),
b AS (SELECT u.*, s.zcta IS NOT NULL AS seen, u.population_total > 0 AS ok FROM uni u LEFT JOIN seen s USING (zcta))"""


def _universe(spark, folder):
    return table(spark, folder, "part").selectExpr(
        "cast(p_partkey AS string) AS zcta", "cast(CASE WHEN p_size = 50 THEN 0 ELSE p_size * 2000 END AS bigint) AS population_total"
    )


def _observed(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(
        "cast(l_partkey AS string) AS zcta",
        "CASE WHEN l_quantity < 2 THEN 'observed' WHEN l_quantity < 3 THEN NULL ELSE 'partial_observed' END AS coverage_status",
    )


@query("gap_totals", f"""WITH {UNIVERSE}
SELECT count(*) AS universe_rows, count(*) FILTER (ok) AS populated_rows, count(*) FILTER (seen) AS observed_rows,
  (SELECT count(DISTINCT zcta) FROM ob WHERE coverage_status = 'partial_observed') AS partial_rows, count(*) FILTER (NOT seen) AS missing_rows,
  count(*) FILTER (ok AND NOT seen) AS missing_populated_rows, CAST(sum(population_total) FILTER (ok) AS BIGINT) AS population_total,
  CAST(sum(population_total) FILTER (ok AND seen) AS BIGINT) AS observed_population, CAST(sum(population_total) FILTER (ok AND NOT seen) AS BIGINT) AS missing_population,
  round(100.0 * sum(population_total) FILTER (ok AND seen) / sum(population_total) FILTER (ok), 1) AS population_coverage_pct
FROM b""")
def totals_of_gaps(spark, folder):
    return gap_totals(_universe(spark, folder), _observed(spark, folder))


@query("gap_by_state", f"""WITH {UNIVERSE}, {TOP_STATE}
SELECT coalesce(state_code, '??') AS state_code, count(*) AS zctas, count(*) FILTER (seen) AS observed_zctas, count(*) FILTER (NOT seen) AS missing_zctas,
  CAST(sum(population_total) AS BIGINT) AS population, CAST(coalesce(sum(population_total) FILTER (seen), 0) AS BIGINT) AS observed_population,
  CAST(coalesce(sum(population_total) FILTER (NOT seen), 0) AS BIGINT) AS missing_population,
  round(100.0 * count(*) FILTER (seen) / count(*), 1) AS zcta_coverage_pct,
  round(100.0 * coalesce(sum(population_total) FILTER (seen), 0) / sum(population_total), 1) AS population_coverage_pct
FROM b LEFT JOIN top USING (zcta) WHERE ok GROUP BY 1 ORDER BY missing_population DESC, state_code LIMIT 20""")
def state_gaps(spark, folder):
    return gaps_by_state(_universe(spark, folder), _observed(spark, folder), part_crosswalk(spark, folder), top=20)


@query("target_queue", f"""WITH {UNIVERSE}, {TOP_STATE},
cn AS (SELECT zcta, string_agg(DISTINCT county_name, '; ' ORDER BY county_name) AS county_names FROM xs GROUP BY zcta),
q AS (SELECT right(CASE WHEN length(b.zcta) < 5 THEN '00000' || b.zcta ELSE b.zcta END, greatest(5, length(b.zcta))::INT) AS zcta, coalesce(state_code, '??') AS state_code,
   coalesce(county_names, '') AS county_names, population_total FROM b LEFT JOIN top USING (zcta) LEFT JOIN cn USING (zcta) WHERE population_total >= 50000 AND NOT seen)
SELECT CAST(row_number() OVER (ORDER BY population_total DESC, zcta) AS INTEGER) AS priority_rank, * FROM q""")
def queue(spark, folder):
    return target_queue(_universe(spark, folder), _observed(spark, folder), part_crosswalk(spark, folder))


@query("target_totals", f"""WITH {UNIVERSE}
SELECT count(*) AS target_rows, count(*) FILTER (seen) AS covered_rows, count(*) FILTER (NOT seen) AS missing_rows,
  CAST(sum(population_total) AS BIGINT) AS target_population, CAST(coalesce(sum(population_total) FILTER (seen), 0) AS BIGINT) AS covered_population,
  CAST(coalesce(sum(population_total) FILTER (NOT seen), 0) AS BIGINT) AS missing_population,
  round(100.0 * count(*) FILTER (seen) / count(*), 1) AS area_coverage_pct,
  round(100.0 * coalesce(sum(population_total) FILTER (seen), 0) / sum(population_total), 1) AS population_coverage_pct
FROM b WHERE population_total >= 50000""")
def totals_of_targets(spark, folder):
    return target_totals(_universe(spark, folder), _observed(spark, folder))


# --- quality ----------------------------------------------------------------------


@query("value_counts", "SELECT coalesce(CASE WHEN l_tax >= 0.02 THEN l_returnflag END, 'null') AS flag, count(*) AS row_count FROM lineitem GROUP BY 1")
def counted_values(spark, folder):
    return value_counts(table(spark, folder, "lineitem").withColumn("flag", F.expr("CASE WHEN l_tax >= 0.02D THEN l_returnflag END")), "flag")


@query("weighted_counts", f"WITH {INC} SELECT CASE WHEN cat = 'unknown' THEN 'null' ELSE cat END AS offense_group, CAST(sum(n) AS BIGINT) AS incident_total FROM inc GROUP BY 1")
def counted_weights(spark, folder):
    return weighted_value_counts(line_incidents(spark, folder), "offense_group")


COMPLETE = f"""{BASE}, {ASSIGN},
m AS (SELECT sum(n)::DOUBLE AS t, sum(n) FILTER (month > 1) AS d, sum(n) FILTER (n > 5 AND n < 40) AS c, sum(n) FILTER (year <> 1997) AS z,
    sum(n) FILTER (cat <> 'unknown') AS k, sum(n) FILTER (assigned_zcta IS NOT NULL) AS a, sum(n) FILTER (method = 'spatial_join') AS s FROM inc LEFT JOIN one USING (incident_id)),
p AS (SELECT count(population_total) / count(*)::DOUBLE AS r FROM ann),
cells AS (SELECT unnest(['date_completeness_rate', 'coordinate_completeness_rate', 'zip_completeness_rate', 'zcta_assignment_rate', 'spatial_assignment_rate',
    'offense_classification_rate', 'population_coverage_rate']) AS metric, unnest([d / t, c / t, z / t, a / t, s / t, k / t, r]) AS v FROM m, p)"""


@query("completeness", f"{COMPLETE} SELECT metric, round_even(v * 10000, 0) / 10000 AS value FROM cells")
def completeness_rates(spark, folder):
    return completeness(undated_lines(spark, folder), part_assignments(spark, folder), part_annual(spark, folder))


@query("duplicates", """
SELECT count(*) AS row_count, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_incident_id_count,
  round_even((count(*) - count(DISTINCT (l_orderkey, l_linenumber))) / count(*)::DOUBLE * 10000, 0) / 10000 AS duplicate_rate FROM lineitem""")
def duplicate_ids(spark, folder):
    return duplicate_metrics(line_incidents(spark, folder), ["incident_id"])


@query("scope_counts", f"WITH {INC} SELECT source_name, year AS occurred_year, cat AS offense_group, count(*) AS row_count FROM inc WHERE cat <> 'unknown' GROUP BY 1, 2, 3")
def combination_counts(spark, folder):
    return key_counts(line_incidents(spark, folder), ["source_name", "occurred_year", "offense_group"])


@query("top_outliers", f"""{BASE} SELECT zcta, year, round(total_rate_per_1000, 9) AS total_rate_per_1000, population_total, total_incident_count FROM ann
ORDER BY ann.total_rate_per_1000 DESC NULLS LAST, zcta, year LIMIT 20""")
def outliers(spark, folder):
    top = top_records(part_annual(spark, folder), "total_rate_per_1000")
    return top.withColumn("total_rate_per_1000", F.round("total_rate_per_1000", 9))


def _plain_index(annual):
    """Annual rows with the descriptive columns a finished index has."""
    return annual.selectExpr(
        "*", "CASE WHEN year < 1998 THEN 'source_universe' ELSE 'state' END AS comparison_scope", "CASE WHEN population_total > 0 THEN 'observed' ELSE 'modeled' END AS data_source_type",
        "total_incident_count > 150 AS is_modeled", "CASE WHEN population_total >= 1000 THEN 'B' WHEN population_total > 0 THEN 'C' END AS confidence_grade",
        "round(total_rate_per_1000 / 100, 6) AS overall_incident_score_0_100",
    )


@query("quality_report", f"""{COMPLETE},
ix AS (SELECT *, CASE WHEN year < 1998 THEN 'source_universe' ELSE 'state' END AS scope, CASE WHEN population_total > 0 THEN 'observed' ELSE 'modeled' END AS dst,
    CASE WHEN population_total >= 1000 THEN 'B' WHEN population_total > 0 THEN 'C' END AS grade FROM ann),
dup AS (SELECT count(*) AS t, count(*) - count(DISTINCT incident_id) AS x FROM inc),
allrows AS (
SELECT 'completeness' AS section, metric, round_even(v * 10000, 0) / 10000 AS value FROM cells
UNION ALL SELECT 'duplicates', 'duplicate_incident_id_count', x FROM dup UNION ALL SELECT 'duplicates', 'duplicate_rate', round_even(x / t::DOUBLE * 10000, 0) / 10000 FROM dup
UNION ALL SELECT 'assignment_method_counts', method, count(*) FROM asg GROUP BY 2
UNION ALL SELECT 'assignment_method_incident_counts', method, sum(n) FROM inc LEFT JOIN one USING (incident_id) GROUP BY 2
UNION ALL SELECT 'offense_group_counts', cat, count(*) FROM inc GROUP BY 2 UNION ALL SELECT 'offense_group_incident_counts', cat, sum(n) FROM inc GROUP BY 2
UNION ALL SELECT 'year_coverage', source_name || '|' || CAST(year AS VARCHAR), count(*) FROM inc GROUP BY 2
UNION ALL SELECT 'index_scope_counts', scope || '|' || dst || '|' || CAST(total_incident_count > 150 AS VARCHAR), count(*) FROM ix GROUP BY 2
UNION ALL SELECT 'confidence_grade_counts', coalesce(grade, 'null'), count(*) FROM ix GROUP BY 2
UNION ALL SELECT 'confidence_grade_counts_by_scope', scope || '|' || grade, count(*) FROM ix WHERE grade IS NOT NULL GROUP BY 2
UNION ALL (SELECT 'top_total_rate_outliers', zcta || '|' || CAST(year AS VARCHAR), total_rate_per_1000 FROM ann ORDER BY total_rate_per_1000 DESC NULLS LAST, zcta, year LIMIT 20)
UNION ALL (SELECT 'top_violent_rate_outliers', zcta || '|' || CAST(year AS VARCHAR), violent_rate_per_1000 FROM ann ORDER BY violent_rate_per_1000 DESC NULLS LAST, zcta, year LIMIT 20)
UNION ALL (SELECT 'top_overall_scores', zcta || '|' || CAST(year AS VARCHAR), round(total_rate_per_1000 / 100, 6) FROM ann ORDER BY round(total_rate_per_1000 / 100, 6) DESC NULLS LAST, zcta, year LIMIT 20))
SELECT section, metric, round(CAST(value AS DOUBLE), 6) AS value FROM allrows""")
def report(spark, folder):
    annual = materialize(part_annual(spark, folder), "annual")
    out = quality_report(undated_lines(spark, folder), part_assignments(spark, folder), annual, _plain_index(annual))
    return out.withColumn("value", F.round("value", 6))


# --- groups -----------------------------------------------------------------------

STATUS = "CASE p_size % 4 WHEN 0 THEN 'observed' WHEN 1 THEN 'county_observed_allocated' WHEN 2 THEN 'national_modeled' END"


def _records(spark, folder):
    """One published record per part (two versions for some), scored by simple arithmetic."""
    part = table(spark, folder, "part")
    cells = [f"CASE WHEN p_size % 5 <> {i % 5} THEN p_size * {i + 1} END AS {c}" for i, c in enumerate(COUNT_COLUMNS)]
    scores = [f"CASE WHEN p_size % 6 <> {i % 6} THEN (p_partkey * {i + 3}) % 100 / 1.0D END AS {score_col(b)}" for i, b in enumerate(["total", *SCORED])]
    base = part.withColumn("version", F.explode(F.expr("CASE WHEN p_size % 2 = 0 THEN array(1, 2) ELSE array(2) END"))).selectExpr(
        "cast(p_partkey AS string) AS zcta", "2022 AS year", "version", "CASE WHEN p_size < 45 THEN cast(p_size * 10 * version AS bigint) END AS population_total",
        f"{STATUS} AS coverage_status", "CASE WHEN p_size < 25 THEN 'observed' ELSE '' END AS data_source_type",
        "CASE WHEN p_size < 10 THEN 'A' ELSE 'C' END AS confidence_grade", "concat('b', p_size % 3, '|', ' a|') AS source_names",
        "(p_partkey * 7) % 1000 / 10.0D AS overall_incident_score_0_100", *cells, *scores,
    )
    return latest_records(base, "version")


def _members(spark, folder):
    """Orders' customers as groups that request parts, some of which do not exist."""
    li = table(spark, folder, "lineitem").selectExpr("l_suppkey AS group_id", "cast(CASE WHEN l_tax > 0.075D THEN l_partkey + 10000000 ELSE l_partkey END AS string) AS zcta")
    return requested_members(li, _records(spark, folder))


MEMBERS = """rec AS (SELECT CASE WHEN p_partkey < 10000 THEN right('00000' || CAST(p_partkey AS VARCHAR), 5) ELSE CAST(p_partkey AS VARCHAR) END AS zcta, p_partkey AS k, p_size AS z, p_size * 20 AS pop0 FROM part),
mem AS (SELECT DISTINCT l_suppkey AS group_id, CASE WHEN key < 10000 THEN right('00000' || CAST(key AS VARCHAR), 5) ELSE CAST(key AS VARCHAR) END AS zcta
  FROM (SELECT l_suppkey, CASE WHEN l_tax > 0.075 THEN l_partkey + 10000000 ELSE l_partkey END AS key FROM lineitem)),
jm AS (SELECT m.group_id, m.zcta, r.k, r.z, CASE WHEN r.z < 45 THEN r.pop0 END AS pop, r.k IS NOT NULL AS found FROM mem m LEFT JOIN rec r USING (zcta))"""


def _group_cells() -> str:
    cells = []
    for i, c in enumerate(COUNT_COLUMNS):
        cells.append(f"CAST(sum(CASE WHEN z % 5 <> {i % 5} THEN z * {i + 1} END) AS BIGINT) AS {c}")
    for i, b in enumerate(["total", *SCORED]):
        v = f"CASE WHEN z % 6 <> {i % 6} THEN ((k * {i + 3}) % 100)::DOUBLE END"
        cells.append(f"coalesce(sum({v} * pop) FILTER (pop > 0) / sum(pop) FILTER (pop > 0 AND {v} IS NOT NULL), avg({v}) FILTER (pop IS NULL OR pop <= 0)) AS s_{b}")
    return ", ".join(cells)


def _half_up(x: str, d: int) -> str:
    return f"floor(({x} + 2.220446049250313e-16) * {10**d} + 0.5) / {10**d}"


@query("group_profile", f"""WITH {MEMBERS},
g AS (SELECT group_id, count(*) AS requested_zip_count, count(*) FILTER (found) AS found_zip_count, count(*) FILTER (NOT found) AS missing_zip_count,
  CAST(coalesce(sum(pop), 0) AS BIGINT) AS population_total, count(*) FILTER (found AND z % 4 = 0) AS direct_observed_zip_count, count(*) FILTER (found AND z % 4 <= 1) AS observed_zip_count,
  count(*) FILTER (found AND z % 4 = 2) AS modeled_zip_count, {_group_cells()} FROM jm GROUP BY group_id)
SELECT group_id, requested_zip_count, found_zip_count, missing_zip_count, population_total, direct_observed_zip_count, observed_zip_count, modeled_zip_count,
  {", ".join(COUNT_COLUMNS)}, {_half_up('total_incident_count::DOUBLE / CASE WHEN population_total > 0 THEN population_total END * 1000', 3)} AS total_rate_per_1000,
  {_half_up('s_violent', 1)} AS violent_score_0_100, {_half_up('s_total', 1)} AS total_incident_score_0_100,
  CASE WHEN s_violent IS NULL THEN 'unavailable' WHEN s_violent < 20 THEN 'very_low' WHEN s_violent < 40 THEN 'low' WHEN s_violent < 60 THEN 'average' WHEN s_violent < 80 THEN 'high' ELSE 'very_high' END AS violent_score_label
FROM g""")
def profile(spark, folder):
    return group_profile(_members(spark, folder)).select(
        "group_id", "requested_zip_count", "found_zip_count", "missing_zip_count", "population_total", "direct_observed_zip_count",
        "observed_zip_count", "modeled_zip_count", *COUNT_COLUMNS, rate_col("total"), score_col("violent"), score_col("total"), "violent_score_label",
    )


@query("group_histograms", f"""WITH {MEMBERS},
l AS (SELECT group_id, 'coverage_status' AS kind, CASE z % 4 WHEN 0 THEN 'observed' WHEN 1 THEN 'county_observed_allocated' WHEN 2 THEN 'national_modeled' ELSE 'unavailable' END AS value FROM jm WHERE found
  UNION ALL SELECT group_id, 'data_source_type', CASE WHEN z < 25 THEN 'observed' ELSE 'unavailable' END FROM jm WHERE found
  UNION ALL SELECT group_id, 'confidence_grade', CASE WHEN z < 10 THEN 'A' ELSE 'C' END FROM jm WHERE found)
SELECT group_id, kind, value, count(*) AS zip_count FROM l GROUP BY ALL""")
def histograms(spark, folder):
    return group_histograms(_members(spark, folder))


@query("group_sources", f"WITH {MEMBERS} SELECT DISTINCT group_id, unnest(['b' || CAST(z % 3 AS VARCHAR), 'a']) AS source_name FROM jm WHERE found")
def sources_of_groups(spark, folder):
    return group_sources(_members(spark, folder))


@query("missing_keys", f"WITH {MEMBERS} SELECT group_id, zcta FROM jm WHERE NOT found")
def missing_keys(spark, folder):
    return missing_members(_members(spark, folder))


# --- published records and writes ---------------------------------------------------

PUBLISHED = """rc AS (SELECT CASE WHEN p_partkey < 10000 THEN right('00000' || CAST(p_partkey AS VARCHAR), 5) ELSE CAST(p_partkey AS VARCHAR) END AS zcta, CAST(2020 + p_size % 3 AS INTEGER) AS year,
  CASE WHEN p_size % 7 = 0 THEN 'state' ELSE 'source_universe' END AS comparison_scope, CASE p_size % 4 WHEN 0 THEN 'observed' WHEN 1 THEN 'partial_observed' WHEN 2 THEN '' END AS coverage_status,
  CASE WHEN p_size < 25 THEN 'observed' END AS data_source_type, CAST(p_size * 100 AS BIGINT) AS population_total FROM part),
pb AS (SELECT * FROM rc WHERE comparison_scope = 'source_universe' AND coalesce(coverage_status, '') IN ('', 'observed'))"""


def _published(spark, folder, raw=False):
    records = table(spark, folder, "part").selectExpr(
        "cast(p_partkey AS string) AS zcta", "2020 + p_size % 3 AS year", "CASE WHEN p_size % 7 = 0 THEN 'state' ELSE 'source_universe' END AS comparison_scope",
        "CASE p_size % 4 WHEN 0 THEN 'observed' WHEN 1 THEN 'partial_observed' WHEN 2 THEN '' END AS coverage_status",
        "CASE WHEN p_size < 25 THEN 'observed' END AS data_source_type", "cast(p_size * 100 AS bigint) AS population_total",
    )
    return records if raw else publishable(records)


@query("publishable", f"WITH {PUBLISHED} SELECT * FROM pb")
def published(spark, folder):
    return _published(spark, folder)


@query("coverage_projection", f"WITH {PUBLISHED} SELECT zcta, year, population_total, coverage_status, data_source_type, CAST(NULL AS VARCHAR) AS coverage_notes FROM pb")
def projection(spark, folder):
    return coverage_projection(_published(spark, folder))


@query("manifest", f"""WITH {PUBLISHED}
SELECT year, comparison_scope, count(*) AS row_count, {digest_sql(["comparison_scope", "coverage_status", "data_source_type", "CAST(population_total AS VARCHAR)",
  "CAST(year AS VARCHAR)", "zcta"])} AS checksum FROM pb GROUP BY 1, 2""")
def bundle_manifest(spark, folder):
    return manifest(_published(spark, folder))


@query("status_histogram", f"""WITH {PUBLISHED}, l AS (SELECT year, comparison_scope, 'coverage_status' AS kind, coalesce(coverage_status, 'null') AS value FROM rc
  UNION ALL SELECT year, comparison_scope, 'data_source_type', coalesce(data_source_type, 'null') FROM rc)
SELECT *, count(*) AS row_count FROM l GROUP BY ALL""")
def histogram_of_status(spark, folder):
    records = _published(spark, folder, raw=True)
    return status_histogram(records)


@query("default_scopes", f"WITH {PUBLISHED} SELECT year, CASE WHEN max(CASE WHEN comparison_scope = 'source_universe' THEN 1 ELSE 0 END) = 1 THEN 'source_universe' ELSE min(comparison_scope) END AS default_scope FROM rc GROUP BY year")
def scopes_by_year(spark, folder):
    return default_scopes(_published(spark, folder, raw=True))


@query("keyed_json", f"""WITH {PUBLISHED}
SELECT CASE year WHEN 2020 THEN '/api/v1/2020/zips/' WHEN 2021 THEN '/api/v1/2021/zips/' ELSE '/api/v1/2022/zips/' END || zcta || '.json' AS api_path,
  '{{"api_path":"/api/v1/' || CAST(year AS VARCHAR) || '/zips/' || zcta || '.json","api_version":"v1","population_total":' || CAST(population_total AS VARCHAR) ||
  ',"year":' || CAST(year AS VARCHAR) || ',"zcta":"' || zcta || '","zip":"' || zcta || '"}}' AS document FROM pb""")
def keyed_json(spark, folder):
    documents = area_documents(_published(spark, folder), ["zcta", "year", "population_total"])
    path = scratch(spark, "documents")
    write_documents(documents, path)
    read = spark.read.text(path).select(F.col("value").alias("document"))
    return read.select(F.get_json_object("document", "$.api_path").alias("api_path"), "document")


@query("geojson_rows", f"""WITH {SHAPES}
SELECT zcta, CAST(CASE kind WHEN 0 THEN 5 WHEN 1 THEN 10 ELSE 4 END AS BIGINT) AS positions, x AS first_lon, y AS first_lat, s_name AS name
FROM shp JOIN supplier ON lpad(CAST(s_suppkey AS VARCHAR), 8, '0') = zcta""")
def geojson_rows(spark, folder):
    records = table(spark, folder, "supplier").selectExpr("lpad(cast(s_suppkey AS string), 8, '0') AS zcta", "s_name AS name")
    features = geojson_features(records, supplier_polygons(spark, folder), ["zcta", "name"])
    rings = F.from_json(F.get_json_object("feature", "$.geometry.coordinates"), "array<array<array<double>>>")
    parsed = features.select("zcta", rings.alias("r"), F.get_json_object("feature", "$.properties.name").alias("name"))
    return parsed.select(
        "zcta", F.size(F.flatten("r")).cast("long").alias("positions"), F.col("r")[0][0][0].alias("first_lon"), F.col("r")[0][0][1].alias("first_lat"), "name"
    )


@query("replace_by_key", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS prio, CAST(o_orderkey + CASE WHEN year(o_orderdate) = 1997 THEN 1000000 ELSE 0 END AS BIGINT) AS k
FROM orders WHERE year(o_orderdate) <> 1995""")
def replace_by_key(spark, folder):
    """All years, then a year with new rows and one without any."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey AS k", "o_orderpriority AS prio", "year(o_orderdate) AS year")
    path = scratch(spark, "by-year")
    replace_slices(orders, path, ["year"])
    replace_slices(orders.where("year = 1997").withColumn("k", F.col("k") + 1_000_000), path, ["year"], [(1997,), (1995,)])
    return read_slices(spark, path).select("k", "prio", "year")


@query("replace_source", """
SELECT 'feed_' || event_type AS source_name, event_id, CASE WHEN event_type = 'view' THEN value * 2 ELSE value END AS value FROM events""")
def replace_source(spark, folder):
    events = table(spark, folder, "events").selectExpr("concat('feed_', event_type) AS source_name", "event_id", "value")
    path = scratch(spark, "by-source")
    replace_sources(events, path)
    replace_sources(events.where("source_name = 'feed_view'").withColumn("value", F.col("value") * 2), path)
    return read_slices(spark, path).select("source_name", "event_id", "value")


@query("earlier_state", """
SELECT o_orderstatus AS status, 2 AS state, count(*) AS row_count, sum(o_orderkey) AS keys FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, 1, count(*), sum(o_orderkey) + count(*) FROM orders GROUP BY 1""")
def earlier_state(spark, folder):
    """A committed table after and before a rewrite."""
    orders = table(spark, folder, "orders").selectExpr("o_orderstatus AS status", "o_orderkey AS k")
    path = scratch(spark, "states")
    replace_slices(orders.withColumn("k", F.col("k") + 1), path, ["status"])
    replace_slices(orders, path, ["status"])
    both = read_slices(spark, path).withColumn("state", F.lit(2)).unionByName(read_slices(spark, path, 1).withColumn("state", F.lit(1)))
    return both.groupBy("status", "state").agg(F.count(F.lit(1)).alias("row_count"), F.sum("k").alias("keys"))


@query("aligned_append", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, value AS amount FROM events
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, o_totalprice FROM orders""")
def aligned_append(spark, folder):
    events = table(spark, folder, "events").selectExpr("cast(event_id AS string) AS id", "event_type AS kind", "value AS amount")
    orders = table(spark, folder, "orders").selectExpr("o_orderstatus AS extra", "o_totalprice AS amount", "cast(o_orderkey AS string) AS id")
    return append_aligned(events, orders)


@query("stored_append", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, value AS amount FROM events
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, o_totalprice FROM orders""")
def stored_append(spark, folder):
    """The same append into a stored table."""
    events = table(spark, folder, "events").selectExpr("cast(event_id AS string) AS id", "event_type AS kind", "value AS amount")
    orders = table(spark, folder, "orders").selectExpr("o_orderstatus AS extra", "o_totalprice AS amount", "cast(o_orderkey AS string) AS id")
    path = scratch(spark, "appended")
    append_slices(events, path, [])
    append_slices(orders, path, [])
    return read_slices(spark, path)


@query("export_roundtrip", f"""{BASE} SELECT zcta, CAST(year AS VARCHAR) AS year, CAST(total_incident_count AS VARCHAR) AS total_incident_count, CAST(population_total AS VARCHAR) AS population_total FROM ann""")
def export_roundtrip(spark, folder):
    path = scratch(spark, "export") + ".csv"
    shown = consumer_view(part_annual(spark, folder)).select("zcta", "year", "total_incident_count", "population_total")
    export_table(shown, path, "csv", ["zcta", "year"])
    return spark.read.option("header", True).csv(path)

