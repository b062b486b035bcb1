"""Points, bounding boxes and polygon edges as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealens.constants import PLACEHOLDER_COORDINATES
from arealens.functions.text import clean_text, to_double

NUMBER = r"([-+]?[0-9]+(?:\.[0-9]+)?)"
POINT_WKT = rf"(?i)^POINT\s*\(\s*{NUMBER}\s+{NUMBER}\s*\)"
POINT_PAIR = rf"^\(?\s*{NUMBER}\s*,\s*{NUMBER}\s*\)?"

EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def parse_point(value: Column) -> tuple[Column, Column]:
    """(latitude, longitude) from ``POINT (lon lat)`` or ``(lat, lon)`` text."""
    text = clean_text(value)

    def pick(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("double")

    is_wkt = text.rlike(POINT_WKT)
    lat = F.when(is_wkt, pick(POINT_WKT, 2)).otherwise(pick(POINT_PAIR, 1))
    lon = F.when(is_wkt, pick(POINT_WKT, 1)).otherwise(pick(POINT_PAIR, 2))
    return lat, lon


def resolve_coordinates(lat: Column, lon: Column, point: Column | None = None) -> tuple[Column, Column]:
    """Numeric columns; if either is missing both come from the point text."""
    lat, lon = to_double(lat), to_double(lon)
    if point is None:
        return lat, lon
    p_lat, p_lon = parse_point(point)
    missing = lat.isNull() | lon.isNull()
    return F.when(missing, p_lat).otherwise(lat), F.when(missing, p_lon).otherwise(lon)


def valid_coordinates(
    lat: Column, lon: Column, placeholders: list[tuple[float, float]] = PLACEHOLDER_COORDINATES
) -> Column:
    """Present, in range and not one of the placeholder pairs; never NULL."""
    in_range = lat.between(-90, 90) & lon.between(-180, 180)
    fake = [(lat == F.lit(float(a))) & (lon == F.lit(float(b))) for a, b in placeholders]
    usable = in_range & ~reduce(lambda a, b: a | b, fake) if fake else in_range
    return F.coalesce(usable, F.lit(False))


def point_wkt(lat: Column, lon: Column, valid: Column | None = None) -> Column:
    valid = valid_coordinates(lat, lon) if valid is None else valid
    text = F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
    return F.when(valid, text)


def rings_from_wkt(wkt: Column) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON as arrays of (x, y)."""
    rings = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(
            F.get(xy, F.lit(0)).try_cast("double").alias("x"), F.get(xy, F.lit(1)).try_cast("double").alias("y")
        )

    return F.transform(rings, lambda ring: F.transform(F.split(ring, ","), point))


def edges_from_rings(rings: Column) -> Column:
    def ring_edges(ring: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.zip_with(
            F.slice(ring, F.lit(1), n),
            F.slice(ring, F.lit(2), n),
            lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
        )

    return F.flatten(F.transform(rings, ring_edges))


def edges_from_wkt(wkt: Column) -> Column:
    return edges_from_rings(rings_from_wkt(wkt))


def _sum(edges: Column, term) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))


def cross(e: Column) -> Column:
    return e.x1 * e.y2 - e.x2 * e.y1


def signed_area(edges: Column) -> Column:
    return _sum(edges, cross) / F.lit(2.0)


def centroid(edges: Column) -> tuple[Column, Column]:
    """Area-weighted (lat, lon); holes must run against the outer ring, as in the standard."""
    area6 = F.nullif(_sum(edges, cross) * F.lit(3.0), F.lit(0.0))
    lat = _sum(edges, lambda e: (e.y1 + e.y2) * cross(e)) / area6
    lon = _sum(edges, lambda e: (e.x1 + e.x2) * cross(e)) / area6
    return lat, lon


def bounding_box(edges: Column) -> dict[str, Column]:
    return {
        "min_lon": F.array_min(F.transform(edges, lambda e: F.least(e.x1, e.x2))),
        "max_lon": F.array_max(F.transform(edges, lambda e: F.greatest(e.x1, e.x2))),
        "min_lat": F.array_min(F.transform(edges, lambda e: F.least(e.y1, e.y2))),
        "max_lat": F.array_max(F.transform(edges, lambda e: F.greatest(e.y1, e.y2))),
    }


def strictly_inside(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd test over all edges; points on the boundary are outside."""

    def crosses(e: Column) -> Column:
        straddles = (e.y1 > lat) != (e.y2 > lat)
        x_at = e.x1 + F.try_divide((e.x2 - e.x1) * (lat - e.y1), e.y2 - e.y1)
        return F.when(straddles & (lon < x_at), 1).otherwise(0)

    def touches(e: Column) -> Column:
        on_line = (e.x2 - e.x1) * (lat - e.y1) == (e.y2 - e.y1) * (lon - e.x1)
        return (
            on_line
            & lon.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
            & lat.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
        )

    odd = F.aggregate(edges, F.lit(0), lambda acc, e: acc + crosses(e)) % 2 == 1
    return odd & ~F.exists(edges, touches)


def polygon_wkt(kind: Column, coordinates: Column) -> Column:
    """WKT from GeoJSON polygon coordinates kept as JSON text."""
    polygon = "array<array<array<double>>>"
    parts = F.when(kind == "Polygon", F.array(F.from_json(coordinates, polygon))).when(
        kind == "MultiPolygon", F.from_json(coordinates, f"array<{polygon}>")
    )

    def point(p: Column) -> Column:
        return F.concat_ws(" ", F.get(p, F.lit(0)).cast("string"), F.get(p, F.lit(1)).cast("string"))

    def ring(r: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(r, point), ", "), F.lit(")"))

    def part(p: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))

    text = F.array_join(F.transform(parts, part), ", ")
    return F.when(kind == "Polygon", F.concat(F.lit("POLYGON "), text)).when(
        kind == "MultiPolygon", F.concat(F.lit("MULTIPOLYGON ("), text, F.lit(")"))
    )
