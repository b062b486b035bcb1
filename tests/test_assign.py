"""Assignment rules and the grid join against a brute-force cross-check."""

import random

from pyspark.sql import functions as F

from arealens.functions.geo import edges_from_wkt, strictly_inside
from arealens.operators.assign import assign_areas, attach_located, crowded_cells, distinct_shapes, join_assignments, locate_points, polygon_cells, prepare_polygons
from arealens.operators.aggregate import annual_aggregates
from arealens.operators.quality import area_coverage, counted_incidents, coverage_ratios

SCHEMA = "incident_id string, jurisdiction_state string, latitude double, longitude double, zcta_from_zip string"


def box(x1, y1, x2, y2):
    return f"POLYGON (({x1} {y1}, {x2} {y1}, {x2} {y2}, {x1} {y2}, {x1} {y1}))"


def by_id(df):
    return {r.incident_id: r for r in df.collect()}


def test_spatial_fallback_and_reasons(spark):
    areas = spark.createDataFrame([("90210", "06", box(-118.5, 34.0, -118.0, 34.5))], "zcta string, state_fips string, geom_wkt string")
    incidents = spark.createDataFrame(
        [
            ("inside", "CA", 34.2, -118.2, None), ("placeholder", "CA", 0.0, 0.0, "90210"), ("bad key", "CA", 0.0, 0.0, "99999"),
            ("nothing", "CA", None, None, None), ("other state", "CO", 34.2, -118.2, None), ("beside", "CA", 34.9, -118.2, "90210"),
            ("out of state with key", "ca", 45.0, -118.2, "90210"), ("edge", "CA", 34.0, -118.2, None),
        ],
        SCHEMA,
    )
    got = by_id(assign_areas(incidents, areas))
    assert (got["inside"].zcta, got["inside"].assignment_method, got["inside"].assignment_confidence) == ("90210", "spatial_join", "high")
    assert (got["placeholder"].zcta, got["placeholder"].assignment_method) == ("90210", "zip_fallback")
    assert (got["bad key"].zcta, got["bad key"].assignment_notes) == (None, "zip_fallback_without_loaded_zcta_geometry")
    assert got["nothing"].assignment_notes == "missing_coordinates_and_zip"
    assert (got["other state"].zcta, got["other state"].assignment_notes) == (None, "valid_coordinates_outside_expected_state")
    assert (got["beside"].zcta, got["beside"].assignment_notes) == (None, "valid_coordinates_outside_loaded_zctas")
    assert (got["out of state with key"].zcta, got["out of state with key"].assignment_method) == ("90210", "zip_fallback")
    assert got["edge"].zcta is None


def test_external_states_overrule(spark):
    areas = spark.createDataFrame(
        [("90210", None, box(-118.5, 34.0, -118.0, 34.5)), ("89103", None, box(-115.3, 36.0, -115.0, 36.3))],
        "zcta string, state_fips string, geom_wkt string",
    )
    states = spark.createDataFrame([("90210", "06"), ("89103", "32")], "zcta string, state_fips string")
    incidents = spark.createDataFrame([("a", "CA", None, None, "90210"), ("b", "CA", None, None, "89103")], SCHEMA)
    got = by_id(assign_areas(incidents, areas, states))
    assert (got["a"].zcta, got["a"].assignment_method) == ("90210", "zip_fallback")
    assert (got["b"].zcta, got["b"].assignment_notes) == (None, "zip_fallback_outside_expected_state")


def test_grid_join_equals_brute_force(spark):
    rng = random.Random(5)
    shapes = []
    for i in range(40):
        x, y, w, h = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.1, 4), rng.uniform(0.1, 4)
        ring = [(x, y), (x + w, y + h / 3), (x + w / 2, y + h / 2), (x + w, y + h), (x, y + h)]
        shapes.append((f"{i:05d}", "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in [*ring, ring[0]]) + "))"))
    polygons = spark.createDataFrame(shapes, "zcta string, geom_wkt string")
    # One point holds a third of the rows.
    points = [(i, rng.uniform(-6, 8), rng.uniform(-6, 8)) for i in range(400)] + [(1000 + i, 0.5, 0.5) for i in range(200)]
    rows = spark.createDataFrame(points, "id bigint, lon double, lat double")
    # A small share size splits the crowded cells.
    spots = locate_points(rows, polygons, "lon", "lat", cell=0.7, points_per_task=3)
    located = attach_located(rows, spots, "lon", "lat", {"area": "area"})
    grid = {r.id: r.area for r in located.collect()}
    edged = polygons.select("zcta", edges_from_wkt(F.col("geom_wkt")).alias("e"))
    brute = rows.join(F.broadcast(edged), strictly_inside(F.col("lon"), F.col("lat"), F.col("e")), "left").groupBy("id").agg(F.min("zcta").alias("z"))
    assert grid == {r.id: r.z for r in brute.collect()}
    assert len(grid) == 600 and any(grid.values())


def test_a_dense_city_is_split_into_fine_cells(spark):
    """A lattice of 400 small polygons in one coarse cell, under one large one."""
    shapes = [("z", box(-3, -3, 5, 5)), ("y", box(0.05, 0.05, 0.9, 0.9))]
    shapes += [(f"a{x:02d}{y:02d}", box(x / 20 + 0.005, y / 20, x / 20 + 0.045, y / 20 + 0.04)) for x in range(20) for y in range(20)]
    polygons = spark.createDataFrame(shapes, "zcta string, geom_wkt string")
    prepared = prepare_polygons(polygons)
    dense = crowded_cells(prepared, 1.0)
    assert [tuple(r) for r in dense.where("cx = 0 AND cy = 0").collect()] == [(0, 0, 8)]
    cells = polygon_cells(prepared, 1.0, dense)
    assert cells.where("area = 'z' AND whole").count() > 60 and cells.where("whole AND near IS NOT NULL").count() == 0
    assert max(r["count"] for r in cells.groupBy("cx", "cy", "fx", "fy").count().collect()) < 30
    rng = random.Random(8)
    points = [(i, rng.uniform(-0.2, 1.2), rng.uniform(-0.2, 1.2)) for i in range(500)] + [(900 + k, k / 20, k / 20) for k in range(20)] + [(950 + k, k / 8, k / 8) for k in range(9)]
    rows = spark.createDataFrame(points, "id bigint, lon double, lat double")
    located = attach_located(rows, locate_points(rows, polygons, "lon", "lat", cell=1.0, points_per_task=50), "lon", "lat", {"area": "area"})
    edged = polygons.select("zcta", edges_from_wkt(F.col("geom_wkt")).alias("e"))
    brute = rows.join(F.broadcast(edged), strictly_inside(F.col("lon"), F.col("lat"), F.col("e")), "left").groupBy("id").agg(F.min("zcta").alias("z"))
    assert {r.id: r.area for r in located.collect()} == {r.id: r.z for r in brute.collect()}


def test_polygons_on_each_other_are_tested_once(spark):
    """Two hundred copies each of a square and a triangle; some have no key."""
    triangle = "POLYGON ((0 0, 1 0, 1 0.7, 0 0))"
    shapes = [(f"{i:03d}" if i else None, str(i % 7), box(0, 0, 1, 1) if i % 2 else triangle) for i in range(400)]
    polygons = spark.createDataFrame(shapes, "zcta string, state string, geom_wkt string")
    prepared = prepare_polygons(polygons, carry=("state",))
    assert sorted((r.key.area or "", r.key.state) for r in distinct_shapes(prepared, ("state",)).collect()) == [("", "0"), ("001", "1")]
    rows = spark.createDataFrame([(0.9, 0.1), (0.1, 0.9), (2.0, 2.0)], "lon double, lat double")
    spots = locate_points(rows, polygons, "lon", "lat", cell=1.0, carry=("state",))
    got = {(r.lon, r.lat): (r.area, r.state) for r in spots.collect()}
    assert got == {(0.9, 0.1): (None, "0"), (0.1, 0.9): ("001", "1"), (2.0, 2.0): (None, None)}


def test_counts_are_weighted_and_ids_do_not_fan_out(spark):
    incidents = spark.createDataFrame(
        [("a", 4, 2024, "violent"), ("b", 1, 2024, "property"), ("b", 2, 2024, "property"), ("c", 9, 2024, "drug")],
        "incident_id string, incident_count bigint, occurred_year int, offense_group string",
    )
    assignment = spark.createDataFrame(
        [("a", "55401", "spatial_join"), ("b", "55401", "zip_fallback"), ("b", "55401", "zip_fallback"), ("c", None, "unassigned")],
        "incident_id string, zcta string, assignment_method string",
    )
    population = spark.createDataFrame([("55401", 2024, 1000)], "zcta string, year int, population_total bigint")
    joined = join_assignments(incidents, assignment, ["occurred_year", "offense_group"])
    row = annual_aggregates(joined, population).first()
    assert (row.violent_incident_count, row.property_incident_count, row.total_incident_count, row.total_rate_per_1000) == (4, 3, 7, 7.0)


def test_coverage_is_weighted(spark):
    incidents = spark.createDataFrame(
        [("a", "2024-01-01", 2024, "violent", "s", 4), ("b", None, 2024, "unknown", "s", 1)],
        "incident_id string, occurred_date string, occurred_year int, offense_group string, source_name string, incident_count bigint",
    ).withColumn("occurred_date", F.to_date("occurred_date"))
    assignment = spark.createDataFrame([("a", "55401", "spatial_join"), ("b", None, "unassigned")], "incident_id string, zcta string, assignment_method string")
    counted = counted_incidents(incidents, assignment)
    ratios = coverage_ratios(counted).first()
    assert [ratios[c] for c in ratios.asDict() if c.endswith("rate")] == [0.8, 0.8, 0.8, 0.8]
    area = area_coverage(counted).first()
    assert (area.zcta, area.assigned_count, area.spatial_count, area.source_names) == ("55401", 4, 4, "s")
