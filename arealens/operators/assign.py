"""Assign incidents to areas: point in polygon first, area key second."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import PLACEHOLDER_COORDINATES, STATES
from arealens.functions.fixed import fixed_table
from arealens.functions.geo import bounding_box, edges_from_wkt, strictly_inside, valid_coordinates
from arealens.functions.text import number_column
from arealens.operators.materialize import materialize
from arealens.operators.skew import hottest_keys, lookup_join, row_salts

ASSIGNMENT_COLUMNS = ["incident_id", "zcta", "assignment_method", "assignment_confidence", "assignment_notes", "assigned_at"]


def state_table(df: DataFrame) -> DataFrame:
    """The fixed state dimension (one row per state, safe to broadcast)."""
    names = ["state_code", "state_fips", "state_name", "lat_min", "lat_max", "lon_min", "lon_max"]
    return fixed_table(df.sparkSession, names, STATES)


def inside_state_bounds(df: DataFrame, state: str, lat: str, lon: str, name: str) -> DataFrame:
    """Flag: the point lies in its state's bounding box. True for unknown or unbounded states."""
    bounds = F.broadcast(state_table(df).select(F.col("state_code").alias("_bounded"), "lat_min", "lat_max", "lon_min", "lon_max"))
    inside = F.col(lat).between(F.col("lat_min"), F.col("lat_max")) & F.col(lon).between(F.col("lon_min"), F.col("lon_max"))
    known = F.col("_bounded").isNotNull()
    return df.join(bounds, F.upper(F.col(state)) == F.col("_bounded"), "left").select(
        *df.columns, F.when(known, F.coalesce(inside, F.lit(False))).otherwise(F.lit(True)).alias(name)
    )


#: Polygons of a coarse cell up to which it stays whole; more crowded cells get a finer grid of their own.
CELL_POLYGONS = 16
#: Cells along one side of the finest grid inside a coarse cell.
FINEST = 64


def prepare_polygons(
    polygons: DataFrame, area: str = "zcta", wkt: str = "geom_wkt", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Edges and bounding box per polygon, empty where there is no usable ring."""
    edged = polygons.withColumn("edges", edges_from_wkt(F.col(wkt)))
    edged = edged.withColumn("edges", F.when(F.size("edges") > 2, F.col("edges")))
    box = [e.alias(n) for n, e in bounding_box(F.col("edges")).items()]
    return edged.select(F.col(area).alias("area"), *carry, "edges", *box)


def _within(value: Column, cell: str, size: Column) -> Column:
    """Number of the fine cell of a coordinate along one side of its coarse cell."""
    place = F.floor((value - F.col(cell) * size) * F.col("fine") / size)
    return F.greatest(F.lit(0), F.least(F.col("fine") - 1, place))


def crowded_cells(prepared: DataFrame, cell: float) -> DataFrame:
    """(cx, cy, fine): coarse cells that hold many polygons, with the cells per side that leave few in each."""
    spread = _coarse(prepared.where("edges IS NOT NULL"), cell).groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    sides = F.pow(F.lit(2.0), F.ceil(F.log2(F.sqrt(F.col("n") / CELL_POLYGONS)))).cast("long")
    return spread.where(F.col("n") > CELL_POLYGONS).select("cx", "cy", F.least(sides, F.lit(FINEST)).alias("fine"))


def _coarse(prepared: DataFrame, cell: float) -> DataFrame:
    size = F.lit(float(cell))

    def cells(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size)))

    return prepared.withColumn("cx", cells("min_lon", "max_lon")).withColumn("cy", cells("min_lat", "max_lat"))


def polygon_cells(prepared: DataFrame, cell: float, crowded: DataFrame) -> DataFrame:
    """One row per polygon and cell that it meets: (cx, cy, fx, fy), the edges a test in that cell can need, ``whole``.

    A ray cast towards rising longitude only meets edges that span the cell's latitudes and do not end west
    of it. Cells without any edge inside them lie outside the polygon, and are left out, or inside it: ``whole``, no test.
    """
    size = F.lit(float(cell))
    coarse = _coarse(prepared.where("edges IS NOT NULL"), cell).join(crowded, ["cx", "cy"], "left").withColumn("fine", F.coalesce("fine", F.lit(1).cast("long")))

    def cells(low: str, high: str, side: str) -> Column:
        return F.explode(F.sequence(_within(F.col(low), side, size), _within(F.col(high), side, size)))

    gridded = coarse.withColumn("fx", cells("min_lon", "max_lon", "cx")).withColumn("fy", cells("min_lat", "max_lat", "cy"))
    step, slack = size / F.col("fine"), size / F.col("fine") * 1e-6
    west, south = F.col("cx") * size + F.col("fx") * step - slack, F.col("cy") * size + F.col("fy") * step - slack
    boxed = gridded.withColumns({"west": west, "south": south, "east": west + step + 2 * slack, "north": south + step + 2 * slack})
    near = F.filter(
        "edges",
        lambda e: (F.greatest(e.y1, e.y2) >= F.col("south")) & (F.least(e.y1, e.y2) <= F.col("north")) & (F.greatest(e.x1, e.x2) >= F.col("west")),
    )
    held = boxed.withColumn("near", near).where(F.size("near") > 0).drop("edges")

    def meets(e: Column) -> Column:
        corners = [(F.col(x), F.col(y)) for x in ("west", "east") for y in ("south", "north")]
        sides = [F.signum((e.x2 - e.x1) * (y - e.y1) - (e.y2 - e.y1) * (x - e.x1)) for x, y in corners]
        return (F.least(e.x1, e.x2) <= F.col("east")) & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    middle = ((F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2)
    met = held.withColumn("whole", ~F.exists("near", meets))
    kept = met.where(~F.col("whole") | strictly_inside(*middle, F.col("near")))
    kept = kept.withColumn("near", F.when(~F.col("whole"), F.col("near")))
    return kept.drop("west", "south", "east", "north", "fine")


def distinct_shapes(prepared: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Usable polygons, those with equal edges as one: ``key`` is the smallest of their areas with its carried columns."""
    usable = prepared.where("edges IS NOT NULL")
    return usable.groupBy("edges", "min_lon", "max_lon", "min_lat", "max_lat").agg(F.min(F.struct("area", *carry)).alias("key"))


def _reachable(cells: DataFrame, place: list[str]) -> DataFrame:
    """Cells' polygons without those whose key comes after one that holds the whole cell: no point there can get them."""
    cells = materialize(cells, "cells")
    least = cells.where("whole").groupBy(*place).agg(F.min("key").alias("_least"))
    return cells.join(least, place, "left").where(F.col("_least").isNull() | (F.col("key") <= F.col("_least"))).drop("_least")


def locate_points(
    points: DataFrame,
    polygons: DataFrame,
    lon: str,
    lat: str,
    area: str = "zcta",
    wkt: str = "geom_wkt",
    cell: float = 0.5,
    carry: tuple[str, ...] = (),
    points_per_task: int = 100_000,
) -> DataFrame:
    """Containing area per distinct (lon, lat), the smallest area key where polygons overlap.

    Returns ``lon``, ``lat``, ``point_rows`` (rows at that point), ``area`` and the carried polygon
    columns. Equal points are tested once. ``polygons`` are as given or already prepared.

    The grid turns the spatial test into an equi-join. Coarse cells with many polygons have a finer grid of their
    own, so a point meets few polygons in a dense city too; cells with many points are
    split into shares of about ``points_per_task`` points, with the cell's polygons repeated per share.
    Of polygons that lie on each other only those are tested that a point can get: equal ones once, and in a cell
    that one of them fills none of larger keys.
    """
    prepared = polygons if "edges" in polygons.columns else prepare_polygons(polygons, area, wkt, carry)
    prepared = materialize(distinct_shapes(prepared, carry), "shapes")
    dense = materialize(crowded_cells(prepared, cell), "dense")
    distinct = (
        points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
        .groupBy(F.col(lon).alias("lon"), F.col(lat).alias("lat"))
        .agg(F.count(F.lit(1)).alias("point_rows"))
    )
    size, key = F.lit(float(cell)), ["cx", "cy", "fx", "fy"]
    placed = distinct.withColumn("cx", F.floor(F.col("lon") / size)).withColumn("cy", F.floor(F.col("lat") / size))
    placed = placed.join(dense, ["cx", "cy"], "left").withColumn("fine", F.coalesce("fine", F.lit(1).cast("long")))
    placed = placed.withColumns({"fx": _within(F.col("lon"), "cx", size), "fy": _within(F.col("lat"), "cy", size)}).drop("fine")
    per_cell = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("_points"))
    shares = F.ceil(F.col("_points") / F.lit(points_per_task)).cast("int").alias("shares")
    crowded = per_cell.select(*key, shares).where("shares > 1")
    share_count = F.coalesce("shares", F.lit(1))
    keyed = placed.join(crowded, key, "left").withColumn(
        "salt", F.pmod(F.xxhash64("lon", "lat"), share_count).cast("int")
    )
    # The test is heavy for the bytes it reads: a fixed partition count keeps small inputs from being merged
    # into few tasks, and the keys are those of the join.
    keyed = keyed.repartition(row_salts(points), *key, "salt")
    cells = _reachable(polygon_cells(prepared, cell, dense), key).join(crowded, key, "left")
    cells = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), share_count - 1)))
    hit = reduce(lambda a, b: a & b, [keyed[k] == cells[k] for k in [*key, "salt"]])
    inside = keyed.lon.between(cells.min_lon, cells.max_lon) & keyed.lat.between(cells.min_lat, cells.max_lat) & strictly_inside(keyed.lon, keyed.lat, cells.near)
    hit = hit & (cells.whole | F.coalesce(inside, F.lit(False)))
    # A point outside every polygon keeps an all-NULL first area.
    located = (
        keyed.join(cells, hit, "left")
        .groupBy(keyed.lon, keyed.lat)
        .agg(F.max("point_rows").alias("point_rows"), F.min(cells.key).alias("_first"))
        .select("lon", "lat", "point_rows", "_first.area", *[f"_first.{c}" for c in carry])
    )
    return materialize(located, "located")


def attach_located(rows: DataFrame, located: DataFrame, lon: str, lat: str, names: dict[str, str]) -> DataFrame:
    """Bring located columns (``names`` maps them to output names) back to every row at that point."""
    keyed = located.withColumnsRenamed({"lon": lon, "lat": lat})
    lookup = keyed.select(lon, lat, *[F.col(c).alias(n) for c, n in names.items()])
    return lookup_join(rows, lookup, [lon, lat], hottest_keys(keyed, [lon, lat], "point_rows"))


def known_areas(polygons: DataFrame, area_states: DataFrame | None = None, area: str = "zcta") -> DataFrame:
    """Every known area key with its state (an external state lookup overrules the polygon's)."""
    has_state = "state_fips" in polygons.columns
    own = polygons.select(
        F.col(area).cast("string").alias("area"),
        (F.col("state_fips") if has_state else F.lit(None)).cast("string").alias("_own"),
        F.lit(None).cast("string").alias("_other"),
        F.lit(True).alias("_loaded"),
    )
    if area_states is not None:
        own = own.unionByName(
            area_states.select(
                F.col(area).cast("string").alias("area"),
                F.lit(None).cast("string").alias("_own"),
                F.col("state_fips").cast("string").alias("_other"),
                F.lit(False).alias("_loaded"),
            )
        )
    return (
        own.where(F.col("area").isNotNull())
        .groupBy("area")
        .agg(F.max("_own").alias("_own"), F.max("_other").alias("_other"), F.max("_loaded").alias("loaded"))
        .select("area", F.coalesce("_other", "_own").alias("area_state"), "loaded")
    )


def assign_areas(
    incidents: DataFrame,
    polygons: DataFrame,
    area_states: DataFrame | None = None,
    placeholders: list[tuple[float, float]] = PLACEHOLDER_COORDINATES,
    cell: float = 0.5,
) -> DataFrame:
    """One assignment row per incident row.

    Usable point in a polygon -> ``spatial_join``. Unusable coordinates (missing, invalid or outside the
    expected state) with a known area key -> ``zip_fallback``. Anything else stays
    unassigned with a reason. An area in another state than expected is taken back.
    """
    base = incidents.select(
        "incident_id",
        F.upper(F.col("jurisdiction_state")).alias("_state"),
        number_column(incidents, "latitude").alias("_lat"),
        number_column(incidents, "longitude").alias("_lon"),
        F.nullif(F.trim(F.col("zcta_from_zip").cast("string")), F.lit("")).alias("_key"),
    )
    base = inside_state_bounds(base, "_state", "_lat", "_lon", "_in_state").withColumn(
        "_valid", valid_coordinates(F.col("_lat"), F.col("_lon"), placeholders)
    )
    base = base.withColumn("_usable", F.col("_valid") & F.col("_in_state")).withColumn(
        "_outside", F.col("_valid") & ~F.col("_in_state")
    )
    base = base.withColumn("_plon", F.when(F.col("_usable"), F.col("_lon"))).withColumn(
        "_plat", F.when(F.col("_usable"), F.col("_lat"))
    )
    has_state = "state_fips" in polygons.columns
    read = polygons.select(
        F.col("zcta").cast("string").alias("zcta"), (F.col("state_fips") if has_state else F.lit(None)).cast("string").alias("state_fips"), "geom_wkt"
    )
    prepared = materialize(prepare_polygons(read, carry=("state_fips",)), "polygons")  # the only reading of the polygons
    areas = materialize(known_areas(prepared.select(F.col("area").alias("zcta"), "state_fips"), area_states), "areas")
    any_state = F.coalesce(areas.agg((F.count("area_state") > 0).alias("x")).scalar(), F.lit(False))
    any_area = F.coalesce(areas.agg((F.count_if("loaded") > 0).alias("x")).scalar(), F.lit(False))
    shapes = prepared.drop("state_fips").join(areas.select("area", "area_state"), "area", "left")
    located = locate_points(base, shapes, "_plon", "_plat", cell=cell, carry=("area_state",))
    found = attach_located(base, located, "_plon", "_plat", {"area": "_found", "area_state": "_found_state"})
    keys = areas.select(
        F.col("area").alias("_key"), F.col("area_state").alias("_key_state"), F.col("loaded").alias("_key_loaded")
    )
    joined = lookup_join(found, keys, ["_key"], hottest_keys(base.where(F.col("_key").isNotNull()), ["_key"]))
    expected = F.broadcast(state_table(incidents).select(F.col("state_code").alias("_code"), F.col("state_fips").alias("_expected")))
    joined = joined.join(expected, F.col("_state") == F.col("_code"), "left")

    spatial = F.col("_found").isNotNull()
    key_known = F.coalesce(
        F.when(any_state, F.col("_key_state").isNotNull()).when(any_area, F.col("_key_loaded")).otherwise(F.lit(True)),
        F.lit(False),
    )
    by_key = ~spatial & ~F.col("_usable") & F.col("_key").isNotNull() & key_known
    area_state = F.when(spatial, F.col("_found_state")).otherwise(F.col("_key_state"))
    clash = F.coalesce(area_state != F.col("_expected"), F.lit(False))
    note = (
        F.when(spatial & clash, "valid_coordinates_outside_expected_state")
        .when(by_key & clash, "zip_fallback_outside_expected_state")
        .when(spatial, F.lit(None))
        .when(by_key, "missing_or_invalid_coordinates_used_zip")
        .when(~F.col("_usable") & F.col("_key").isNotNull(), "zip_fallback_without_loaded_zcta_geometry")
        .when(F.col("_outside"), "valid_coordinates_outside_expected_state")
        .when(F.col("_usable"), "valid_coordinates_outside_loaded_zctas")
        .otherwise("missing_coordinates_and_zip")
    )
    assigned = (spatial | by_key) & ~clash
    return joined.select(
        "incident_id",
        F.when(assigned & spatial, F.col("_found")).when(assigned, F.col("_key")).alias("zcta"),
        F.when(assigned & spatial, "spatial_join").when(assigned, "zip_fallback").otherwise("unassigned").alias("assignment_method"),
        F.when(assigned & spatial, "high").when(assigned, "medium").otherwise("none").alias("assignment_confidence"),
        note.alias("assignment_notes"),
        F.current_timestamp().cast("timestamp_ntz").alias("assigned_at"),
    )


def one_assignment_per_id(assignments: DataFrame) -> DataFrame:
    """One row per incident id, an assigned one first (spatial before key, then the smallest area)."""
    order = F.struct(
        F.col("zcta").isNull().alias("a"),
        (F.col("assignment_method") != "spatial_join").alias("b"),
        F.col("zcta"),
        F.col("assignment_method"),
    )
    best = assignments.groupBy("incident_id").agg(F.min(order).alias("_best"))
    return best.select("incident_id", "_best.zcta", "_best.assignment_method")


def join_assignments(incidents: DataFrame, assignments: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Counted incidents with their area, all incidents kept.

    Incidents are summed per id and the ``extra`` columns before the join, so copies of
    one id collapse before they are shuffled; assignments are reduced to one per id.
    """
    extra = extra or []
    counted = incidents.groupBy("incident_id", *extra).agg(
        F.sum(F.coalesce(F.col("incident_count"), F.lit(1))).alias("incident_count")
    )
    return counted.join(one_assignment_per_id(assignments), "incident_id", "left")


def assignment_summary(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("assignment_method").agg(F.count(F.lit(1)).alias("incident_rows"))
