"""Where rows came from: file lineage, raw payloads, source profiles, typed re-reads."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import AREA, COUNT_COLUMNS, POPULATION
from arealens.functions.geo import valid_coordinates
from arealens.functions.text import stable_hash, to_double

DIGEST_WORDS = 4


def row_digest(df: DataFrame) -> list[Column]:
    """A row's content as four 60-bit words of its digest; each field goes in with its length."""
    texts = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return [F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)") for k in range(DIGEST_WORDS)]


def content_fingerprint(words: list[Column]) -> Column:
    """An aggregate over digests: the sum of each word and the row count, so repeated rows count."""
    sums = [F.coalesce(F.sum(w).cast("decimal(38,0)").cast("string"), F.lit("0")) for w in words]
    return F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *sums), 256)


def file_lineage(df: DataFrame, source_name: str) -> DataFrame:
    """One row per input file: path, format, size, change time, rows and a content fingerprint.

    The fingerprint covers every column, does not depend on row order and is summed per file on
    the map side, so a file of any size is hashed by all the tasks that read it.
    """
    seen = df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_modified_at"),
        *[w.alias(f"_w{k}") for k, w in enumerate(row_digest(df))],
    )
    keys = ["file_path", "file_name", "file_size_bytes", "file_modified_at"]
    fingerprint = content_fingerprint([F.col(f"_w{k}") for k in range(DIGEST_WORDS)])
    files = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), fingerprint.alias("file_hash"))
    return files.select(
        F.col("file_hash").alias("raw_file_id"),
        F.lit(source_name).alias("source_name"),
        "file_path",
        "file_name",
        F.lower(F.regexp_extract("file_name", r"\.([^.]+)$", 1)).alias("file_format"),
        "file_size_bytes",
        "file_modified_at",
        "row_count",
        "file_hash",
    )


def raw_payloads(df: DataFrame, source_name: str, file_id: Column, row_number: str) -> DataFrame:
    """Every source row as JSON with its row number and a stable record id."""
    columns = [c for c in df.columns if c != row_number and not c.startswith("_")]
    name = F.lit(source_name)
    return df.select(
        stable_hash(name, file_id, F.col(row_number)).alias("raw_record_id"),
        file_id.alias("raw_file_id"),
        name.alias("source_name"),
        F.col(row_number).cast("long").alias("source_row_number"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}).alias("raw_payload_json"),
    )


def source_profile(staged: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Coverage of each source as its data show it, joined to optional static labels (one row per source)."""
    located = valid_coordinates(F.col("latitude_raw"), F.col("longitude_raw"))
    known = F.col("offense_raw").isNotNull()
    profile = staged.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("jurisdiction_state").alias("coverage_state"),
        F.min("occurred_date").alias("data_start_date"),
        F.max("occurred_date").alias("data_end_date"),
        F.max(located).alias("has_point_coordinates"),
        F.avg(located.cast("double")).alias("coordinate_share"),
        F.avg(known.cast("double")).alias("offense_share"),
    )
    return profile if labels is None else profile.join(labels, "source_name", "left")


# --- typed re-read of exported scores -----------------------------------------

WHOLE_FIELDS = {
    "year", POPULATION, "source_count", "county_count", "assigned_incident_count", "spatial_incident_count", *COUNT_COLUMNS,
}
FLAG_FIELDS = {"is_modeled", "is_modelled"}
KEPT_BLANK = {AREA, "comparison_scope", "comparison_scope_value", "source_names"}
NUMBER_NAME = re.compile(r"(_rate_per_1000|_winsorized_per_1000|_score_0_100|_percentile|_index|_z_score)$")
NUMBER_FIELDS = {"data_coverage_score", "percentile_rank", "composite_index"}


def typed_value(name: str, value: Column) -> Column:
    """Text of an exported file to the type its column name stands for."""
    text = F.trim(value)
    if name in FLAG_FIELDS:
        return F.when(text != "", F.lower(text).isin("true", "1", "yes"))
    if name in WHOLE_FIELDS:
        return to_double(text).try_cast("long")
    if NUMBER_NAME.search(name) or name in NUMBER_FIELDS:
        return to_double(text)
    if name == AREA:
        padded = F.when(text.rlike("^[0-9]+$") & (F.length(text) < 5), F.lpad(text, 5, "0")).otherwise(text)
        return F.when(value.isNotNull(), padded)
    return F.coalesce(text, F.lit("")) if name in KEPT_BLANK else F.nullif(text, F.lit(""))


def typed_records(df: DataFrame) -> DataFrame:
    """Re-type every column of an all-text export."""
    return df.select(*[typed_value(c, F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
