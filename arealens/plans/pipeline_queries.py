"""The whole index from raw feeds, stage by stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.constants import OVERALL_SCORE
from arealens.operators.aggregate import annual_aggregates
from arealens.operators.assign import assign_areas, join_assignments
from arealens.operators.incidents import normalize_incidents, stage_sources
from arealens.operators.quality import area_coverage, counted_incidents, coverage_ratios
from arealens.operators.scores import apply_scope, build_index
from arealens.operators.stages import Run, Stage, run_stages
from arealens.plans.area_queries import AREA_COVERAGE, ASSIGNED, DATED, RATIOS
from arealens.plans.bindings import scratch, supplier_polygons
from arealens.plans.checks import ANN, POINTS, SHAPES, scored
from arealens.plans.registry import query, table
from arealens.plans.score_queries import GRADED, GRADED_COLUMNS, KEYS
from arealens.sources.tables import normalize_geometries

_FEED = {
    "incident_id_column": "event_id", "date_column": "ts", "offense_column": "offense", "latitude_column": "lat", "longitude_column": "lon", "zip_column": "zip",
}
#: Feeds of the events by kind; the third covers no state.
FEEDS = {
    "nevada_feed": {**_FEED, "jurisdiction_name": "Nevada", "jurisdiction_state": "NV", "row_filters": {"include": [{"column": "event_type", "values": ["error"]}]}},
    "coast_feed": {**_FEED, "jurisdiction_name": "Coast", "jurisdiction_state": "ca", "row_filters": {"exclude": [{"column": "event_type", "values": ["error", "signup"]}]}},
    "open_feed": {**_FEED, "jurisdiction_name": "Open", "row_filters": {"include": [{"column": "event_type", "values": ["signup"]}]}},
}

_SHAPES = """shp AS (SELECT right(zcta, 5) AS zcta, kind, x, y, state_fips FROM (
    SELECT *, row_number() OVER (PARTITION BY right(zcta, 5) ORDER BY zcta DESC) AS rn FROM (SELECT * FROM shp0)) WHERE rn = 1)"""
_POINTS = """pts AS (
  SELECT event_id AS incident_id, CASE event_type WHEN 'error' THEN 'NV' WHEN 'signup' THEN NULL ELSE 'CA' END AS st,
         CASE WHEN user_id = 7 THEN 0 WHEN value <= 200 THEN 33::DOUBLE + value % 9 END AS lat,
         CASE WHEN user_id = 7 THEN 0 ELSE -123::DOUBLE + (user_id % 90) / 10::DOUBLE END AS lon,
         CASE user_id % 5 WHEN 0 THEN lpad(CAST(user_id AS VARCHAR), 5, '0') WHEN 1 THEN '99999' END AS zkey
  FROM events)"""
_INCIDENTS = """inc AS (SELECT event_id AS incident_id, CASE event_type WHEN 'error' THEN 'nevada_feed' WHEN 'signup' THEN 'open_feed' ELSE 'coast_feed' END AS source_name,
    CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, 1::BIGINT AS n,
    CASE event_type WHEN 'view' THEN 'property' WHEN 'click' THEN 'violent' WHEN 'purchase' THEN 'drug' WHEN 'error' THEN 'weapons' ELSE 'unknown' END AS cat FROM events),
one AS (SELECT incident_id, zcta AS assigned_zcta, assignment_method AS method FROM res),
inca AS (SELECT inc.*, assigned_zcta AS zcta FROM inc JOIN one USING (incident_id) WHERE assigned_zcta IS NOT NULL),
pop AS (SELECT zcta, CAST(yr AS INTEGER) AS year, CAST(CASE WHEN x < -122 THEN NULL WHEN x > -116 THEN 0 ELSE 50 + CAST(zcta AS BIGINT) * 7 END AS BIGINT) AS population_total
  FROM shp, (SELECT DISTINCT year(ts) AS yr FROM events) t)"""


def _areas(polygons):
    features = polygons.selectExpr("zcta AS position", "map('GEOID20', right(zcta, 5), 'STATEFP20', state_fips) AS properties", "geom_wkt")
    return normalize_geometries(features, "suppliers", 2020, ["GEOID20"], order=F.col("position"))


def _staged(events, feeds):
    return stage_sources({name: events for name in feeds}, feeds)


def _population(areas, staged):
    """People by the western edge of the area's shape: unknown, none, or by its key."""
    edge = F.regexp_extract("geom_wkt", r"\(\((-?\d+)", 1).cast("int")
    people = F.when(edge < -122, None).when(edge > -116, 0).otherwise(F.col("zcta").cast("long") * 7 + 50).cast("long")
    years = staged.agg(F.collect_set("occurred_year").alias("years"))
    return areas.select("zcta", people.alias("population_total")).join(F.broadcast(years)).select("zcta", F.explode("years").alias("year"), "population_total")


def _annual(incidents, assigned, population):
    located = join_assignments(incidents.drop("zcta"), assigned, ["occurred_year", "offense_group"])
    return apply_scope(annual_aggregates(located, population), "source_universe")


def _index(annual, counted):
    return build_index(annual, coverage_ratios(counted), area_coverage(counted))


STAGES = [
    Stage("areas", _areas, ("polygons",)),
    Stage("staged", _staged, ("events",), {"feeds": FEEDS}),
    Stage("incidents", normalize_incidents, ("staged",)),
    Stage("assigned", lambda incidents, areas, cell: assign_areas(incidents, areas, cell=cell), ("incidents", "areas"), {"cell": 1.0}),
    Stage("population", _population, ("areas", "staged")),
    Stage("annual", _annual, ("incidents", "assigned", "population")),
    Stage("counted", counted_incidents, ("incidents", "assigned")),
    Stage("index", _index, ("annual", "counted")),
]


def build_from_events(spark, folder: str, target: str) -> Run:
    """Run all stages over the events and supplier shapes; tables are kept below ``target``."""
    events = table(spark, folder, "events").selectExpr(
        "cast(event_id AS string) AS event_id", "ts", "event_type",
        "CASE event_type WHEN 'view' THEN 'Larceny' WHEN 'click' THEN 'Simple ASSAULT' WHEN 'purchase' THEN 'narcotics' WHEN 'error' THEN 'Shots fired!' ELSE 'zzz' END AS offense",
        "cast(CASE WHEN user_id = 7 THEN 0D WHEN value <= 200 THEN 33D + value % 9D END AS string) AS lat",
        "cast(CASE WHEN user_id = 7 THEN 0D ELSE -123D + (user_id % 90) / 10D END AS string) AS lon",
        "CASE user_id % 5 WHEN 0 THEN concat('ZIP ', lpad(cast(user_id AS string), 5, '0')) WHEN 1 THEN '99999-1234' END AS zip",
    )
    return run_stages(target, {"events": events, "polygons": supplier_polygons(spark, folder)}, STAGES)


@query("pipeline_index", f"""{ASSIGNED.replace(SHAPES, SHAPES.replace('shp AS', 'shp0 AS') + ', ' + _SHAPES).replace(POINTS, _POINTS)},
{_INCIDENTS}, {ANN.replace('FROM inc GROUP', 'FROM inca GROUP')}, {DATED.replace('month > 1', 'true')}, {RATIOS}, {AREA_COVERAGE}, {scored()}, {GRADED}""")
def pipeline_index(spark, folder):
    """Feeds, areas, classification, assignment, counts, scores and grades, each stage a stored table."""
    index = build_from_events(spark, folder, scratch(spark, "index")).tables["index"]
    return index.select(*KEYS, OVERALL_SCORE, *GRADED_COLUMNS)
