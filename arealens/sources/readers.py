"""Files of any supported format to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.functions.geo import point_wkt, polygon_wkt
from arealens.sources.framed import BYTEWISE, feature_records, land_json_lines, quoted_rows

BYTE_ORDER_MARK = chr(0xFEFF)
FEATURE = "properties:map<string,string>,geometry:struct<type:string,coordinates:string>"


def file_format(path: str) -> str:
    name = path.rstrip("/").lower()
    for suffix, kind in (
        (".csv", "csv"), (".jsonl", "jsonl"), (".ndjson", "jsonl"), (".geojsonl", "geojsonl"),
        (".geojson", "geojson"), (".json", "json"), (".parquet", "parquet"),
    ):
        if name.endswith(suffix):
            return kind
    raise ValueError(f"unsupported source format: {path}")


#: Words that delimited feeds write for a missing value.
MISSING_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv_text(
    spark: SparkSession, path: str, encoding: str | None = None, skip_bad_lines: bool = False, sep: str = ",",
    multi_line: bool = False, missing: tuple[str, ...] = MISSING_WORDS,
) -> DataFrame:
    """All columns as text (the header line fixes the schema), cast later by expressions.

    A quote inside a quoted field is doubled. ``multi_line`` admits line ends inside quotes; such a file
    is split by :func:`quoted_rows`, unless its encoding is not bytewise. Fields equal to a word of ``missing`` are NULL.
    """
    if multi_line and (encoding or "utf-8").lower() in BYTEWISE:
        rows = quoted_rows(spark, path, sep, encoding, skip_bad_lines)
        return _without_words(rows, missing)
    reader = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).option("escape", '"').option("multiLine", multi_line)
    if encoding:
        reader = reader.option("encoding", {"latin1": "ISO-8859-1"}.get(encoding.lower(), encoding))
    if skip_bad_lines:
        reader = reader.option("mode", "DROPMALFORMED")
    return _without_words(reader.csv(path), missing)


def _without_words(rows: DataFrame, missing: tuple[str, ...]) -> DataFrame:
    return rows.select(*[F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in rows.columns]) if missing else rows


def read_tabular(spark: SparkSession, path: str, options: dict | None = None, fmt: str | None = None) -> DataFrame:
    """CSV, JSON array, JSON lines, GeoJSON (collection or one feature per line) or Parquet.

    Single documents are split too (:mod:`arealens.sources.framed`), at the price of two passes over their text.
    """
    options, kind = options or {}, fmt or file_format(path)
    if kind == "csv":
        return read_csv_text(
            spark, path, options.get("encoding"), options.get("on_bad_lines") == "skip", options.get("sep", ","),
            bool(options.get("multi_line")), tuple(options.get("missing", MISSING_WORDS)),
        )
    if kind == "json":
        return spark.read.json(land_json_lines(spark, path))
    if kind == "jsonl":
        return spark.read.json(path)
    if kind == "parquet":
        return spark.read.parquet(path)
    return feature_points(read_features(spark, path, lines=kind == "geojsonl"))


def read_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """GeoJSON features: ``properties`` (map) and ``geometry`` (type, coordinates as JSON text)."""
    if lines:
        return spark.read.schema(FEATURE.replace(":map", " map").replace("geometry:", "geometry ")).json(path)
    found = feature_records(spark, path).select(F.from_json("record", f"struct<type:string,{FEATURE}>").alias("f"))
    return found.where("coalesce(f.type, 'Feature') = 'Feature' AND (f.type IS NOT NULL OR f.geometry IS NOT NULL)").select("f.properties", "f.geometry")


def feature_points(features: DataFrame) -> DataFrame:
    """Features with ``geometry_wkt`` (points and polygons) and, of points, ``longitude`` and ``latitude`` beside the properties map."""
    xy = F.from_json("geometry.coordinates", "array<double>")
    is_point = F.col("geometry.type") == "Point"
    lon, lat = F.when(is_point, F.get(xy, F.lit(0))), F.when(is_point, F.get(xy, F.lit(1)))
    return features.select(
        "properties",
        lon.alias("longitude"),
        lat.alias("latitude"),
        F.coalesce(
            point_wkt(lat, lon, lat.isNotNull() & lon.isNotNull()),
            polygon_wkt(F.col("geometry.type"), F.col("geometry.coordinates")),
        ).alias("geometry_wkt"),
    )


def property_columns(df: DataFrame, names: list[str], column: str = "properties") -> DataFrame:
    """Turn chosen entries of the properties map into columns."""
    return df.select(*[F.col(column)[n].alias(n) for n in names], *[c for c in df.columns if c != column])


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Separator of a delimited file from its header line only."""
    header = spark.read.text(path).limit(1).collect()
    line = header[0][0].lstrip(BYTE_ORDER_MARK) if header else ""
    for sep in ("|", "\t"):
        if sep in line:
            return sep
    return max([",", ";", ":"], key=line.count)
