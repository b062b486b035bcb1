"""Published record sets: per-area documents, features, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import AREA, OBSERVED_SCOPE, POPULATION, YEAR
from arealens.functions.text import pad_key
from arealens.sources.lineage import content_fingerprint, row_digest

COVERAGE_COLUMNS = [AREA, YEAR, POPULATION, "coverage_status", "data_source_type", "coverage_notes"]


def publishable(records: DataFrame, scope: str = OBSERVED_SCOPE) -> DataFrame:
    """Directly observed records of the published scope only."""
    complete = F.coalesce("coverage_status", F.lit("")).isin("", "observed")
    return records.where((F.col("comparison_scope") == scope) & complete).withColumn(AREA, pad_key(F.col(AREA)))


def area_documents(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One compact JSON document per area and year, keys sorted."""
    names = columns or records.columns
    path = F.concat(F.lit("/api/v1/"), F.col(YEAR).cast("string"), F.lit("/zips/"), F.col(AREA), F.lit(".json"))
    fields = {c: F.col(c) for c in names} | {
        "zip": F.col(AREA), "zcta": F.col(AREA), "api_version": F.lit("v1"), "api_path": path,
    }
    document = F.struct(*[fields[k].alias(k) for k in sorted(fields)])
    return records.select(YEAR, AREA, path.alias("api_path"), F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def coverage_projection(records: DataFrame) -> DataFrame:
    return records.select(
        AREA, YEAR, POPULATION, "coverage_status", "data_source_type", F.lit(None).cast("string").alias("coverage_notes")
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """Documents as text lines, partitioned by year and bucketed by the first digits of the area."""
    (
        documents.withColumn("area_prefix", F.substring(AREA, 1, 3))
        .select("document", YEAR, "area_prefix")
        .repartition(YEAR, "area_prefix")
        .write.mode("overwrite")
        .partitionBy(YEAR, "area_prefix")
        .text(path)
    )


def content_checksum(df: DataFrame) -> Column:
    """Order-independent checksum of the rows (an aggregate)."""
    return content_fingerprint(row_digest(df)).alias("checksum")


def manifest(records: DataFrame) -> DataFrame:
    """Row count and checksum per year and scope."""
    return records.groupBy(YEAR, "comparison_scope").agg(F.count(F.lit(1)).alias("row_count"), content_checksum(records))


def status_histogram(records: DataFrame) -> DataFrame:
    """Rows per year, scope, status kind and value (null where missing)."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("kind"), F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("value"))
            for c in ("coverage_status", "data_source_type")
        ]
    )
    long = records.select(YEAR, "comparison_scope", F.explode(cells).alias("_c"))
    return long.groupBy(YEAR, "comparison_scope", "_c.kind", "_c.value").agg(F.count(F.lit(1)).alias("row_count"))


def default_scopes(records: DataFrame, scope: str = OBSERVED_SCOPE) -> DataFrame:
    """Per year the published scope if present, else the first by name."""
    has = F.max((F.col("comparison_scope") == scope).cast("int")) == 1
    return records.groupBy(YEAR).agg(F.when(has, F.lit(scope)).otherwise(F.min("comparison_scope")).alias("default_scope"))


def geojson_features(records: DataFrame, geometries: DataFrame, properties: list[str], wkt: str = "geom_wkt") -> DataFrame:
    """One GeoJSON feature per record that has a geometry (newline-delimited GeoJSON when written as text)."""
    shapes = geometries.groupBy(AREA).agg(F.min(wkt).alias("_wkt"))
    joined = records.join(shapes, AREA)
    point = r"(-?[0-9.eE+-]+) (-?[0-9.eE+-]+)"
    body = F.regexp_replace(F.regexp_replace("_wkt", r"^[A-Za-z]+\s*", ""), r",\s*", ", ")
    pairs = F.regexp_replace(body, point, r"[$1, $2]")
    coordinates = F.translate(pairs, "()", "[]")
    kind = F.when(F.upper("_wkt").startswith("MULTI"), "MultiPolygon").otherwise("Polygon")
    shown = F.to_json(
        F.struct(*[(F.col(c).cast("string") if dict(records.dtypes)[c].startswith(("timestamp", "date")) else F.col(c)).alias(c) for c in properties]),
        {"ignoreNullFields": "false"},
    )
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"'), kind, F.lit('","coordinates":'), coordinates,
        F.lit('},"properties":'), shown, F.lit("}"),
    )
    return joined.select(AREA, feature.alias("feature"))


def write_features(features: DataFrame, path: str) -> None:
    """Features of :func:`geojson_features` as newline-delimited GeoJSON, ordered by area over the files."""
    features.orderBy(AREA).select("feature").write.mode("overwrite").text(path)


def write_bundle(records: DataFrame, folder: str) -> dict[str, str]:
    """Documents, coverage rows, manifest, status histogram and default scopes of published records as files."""
    kept = publishable(records)
    write_documents(area_documents(kept), f"{folder}/documents")
    written = {"documents": f"{folder}/documents"}
    for name, df in (("coverage", coverage_projection(kept)), ("manifest", manifest(kept)), ("statuses", status_histogram(records)), ("scopes", default_scopes(records))):
        written[name] = f"{folder}/{name}"
        df.write.mode("overwrite").option("ignoreNullFields", False).json(written[name])
    return written
