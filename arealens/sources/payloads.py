"""Landed API responses to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.constants import STATES, TERRITORIES
from arealens.functions.text import to_double

GEOMETRY_FIELDS = {"geometry_x": "x", "geometry_y": "y", "geometry_lon": "longitude", "geometry_lat": "latitude"}


def feature_rows(pages: DataFrame, fields: list[str], payload: str = "payload") -> DataFrame:
    """Paged feature responses: requested attributes plus geometry values the attributes lack."""
    schema = (
        "features array<struct<attributes:map<string,string>,"
        "geometry:struct<x:double,y:double,longitude:double,latitude:double>>>"
    )
    feature = pages.select(F.explode(F.from_json(payload, schema)["features"]).alias("f"))
    attribute = F.col("f.attributes")
    return feature.select(
        *[attribute[n].alias(n) for n in fields],
        *[
            F.when(F.map_contains_key(attribute, F.lit(out)), attribute[out].try_cast("double"))
            .otherwise(F.col(f"f.geometry.{field}"))
            .alias(out)
            for out, field in GEOMETRY_FIELDS.items()
        ],
    )


def record_rows(pages: DataFrame, fields: list[str], payload: str = "payload") -> DataFrame:
    """Paged record responses of the successful pages."""
    parsed = _record_pages(pages, payload)
    record = parsed.where("_page.success").select(F.explode("_page.result.records").alias("r"))
    return record.select(*[F.col("r")[n].alias(n) for n in fields])


def failed_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    parsed = _record_pages(pages, payload)
    return parsed.where(~F.coalesce(F.col("_page.success"), F.lit(False))).drop("_page")


def _record_pages(pages: DataFrame, payload: str) -> DataFrame:
    schema = "success boolean, result struct<records:array<map<string,string>>>"
    return pages.withColumn("_page", F.from_json(payload, schema))


def union_records(frames: list[DataFrame]) -> DataFrame:
    """Union of records with different columns, columns in first-seen order."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    order = list(dict.fromkeys(c for f in frames for c in f.columns))
    return merged.select(*order)


def population_rows(payloads: DataFrame, order: str, payload: str = "payload") -> DataFrame:
    """Population responses keyed by geography id; the last payload by ``order`` wins per area."""
    tables = "map<string,struct<estimate:map<string,double>,error:map<string,double>>>"
    schema = f"release struct<name:string,years:string>, data map<string,{tables}>, geography map<string,struct<name:string>>"
    parsed = payloads.select(F.col(order).alias("_order"), F.from_json(payload, schema).alias("p"))
    each = parsed.select("_order", "p.release", "p.geography", F.explode("p.data").alias("geo_id", "tables"))
    table = F.col("tables")["B01003"]
    name = F.coalesce(F.nullif(F.col("geography")[F.col("geo_id")]["name"], F.lit("")), F.right("geo_id", F.lit(5)))
    digits = F.regexp_replace(name, "[^0-9]", "")
    area = F.when(F.length(digits) >= 5, F.right(digits, F.lit(5))).otherwise(F.right("geo_id", F.lit(5)))
    rows = each.select(
        area.alias("ZCTA"),
        F.concat(F.lit("ZCTA5 "), area).alias("NAME"),
        table["estimate"]["B01003001"].cast("long").alias("B01003_001E"),
        table["error"]["B01003001"].cast("long").alias("B01003_001M"),
        F.col("release.name").alias("source_release"),
        F.col("release.years").alias("source_years"),
        "_order",
        "geo_id",
    ).where((F.length("ZCTA") == 5) & F.col("B01003_001E").isNotNull())
    best = rows.groupBy("ZCTA").agg(
        F.max_by(F.struct("NAME", "B01003_001E", "B01003_001M", "source_release", "source_years"), F.struct("_order", "geo_id")).alias("_r")
    )
    return best.select("ZCTA", "_r.*")


AGENCY_FIELDS = [
    "ori", "state_abbr", "state_name", "agency_name", "agency_type_name", "counties", "is_nibrs",
    "latitude", "longitude", "nibrs_start_date",
]


def agency_rows(payloads: DataFrame, state: str = "state_code", payload: str = "payload") -> DataFrame:
    """Agency directory responses (county bucket -> agencies); buckets that are not lists are skipped.

    The state's name falls back on its code; ``source_json`` is the agency as it came.
    """
    buckets = payloads.select(F.col(state).alias("_state"), F.explode(F.from_json(payload, "map<string,string>")).alias("bucket", "_list"))
    items = buckets.where(F.trim("_list").startswith("[")).select(
        "_state", "bucket", F.explode(F.from_json("_list", "array<map<string,string>>")).alias("a")
    ).where(F.col("a").isNotNull())
    field = {n: F.nullif(F.col("a")[n], F.lit("")) for n in AGENCY_FIELDS}
    code = F.coalesce(field["state_abbr"], "_state")
    by_code = F.lit(None).cast("string")
    for known, name in [*((s[0], s[2]) for s in STATES), *((t[0], t[2]) for t in TERRITORIES)]:
        by_code = F.when(code == known, F.lit(name)).otherwise(by_code)
    return items.select(
        field["ori"].alias("ori"),
        code.alias("state_code"),
        F.coalesce(field["state_name"], by_code).alias("state_name"),
        field["agency_name"].alias("agency_name"),
        field["agency_type_name"].alias("agency_type_name"),
        F.coalesce(field["counties"], "bucket").alias("counties"),
        field["is_nibrs"].try_cast("boolean").alias("is_nibrs"),
        to_double(field["latitude"]).alias("latitude"),
        to_double(field["longitude"]).alias("longitude"),
        field["nibrs_start_date"].alias("nibrs_start_date"),
        F.to_json("a").alias("source_json"),
    )
