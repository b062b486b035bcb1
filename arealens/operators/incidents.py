"""Feeds to staged incidents, staged to normalised incidents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealens.constants import NORMALIZED_COLUMNS, PLACEHOLDER_COORDINATES, STAGED_COLUMNS
from arealens.functions.dates import date_parts, parse_occurred_at, parse_year_day
from arealens.functions.geo import point_wkt, resolve_coordinates, valid_coordinates
from arealens.functions.rates import round_half_even
from arealens.functions.text import (
    as_text,
    clean_text,
    filter_value,
    five_digit_key,
    match_text,
    notes_of,
    number_column,
    stable_hash,
    to_count,
)
from arealens.operators.classify import STARTER_RULES, classify_text

ROW_NUMBER = "_source_row"


def column_or_null(df: DataFrame, name: str | None, dtype: str = "string") -> Column:
    """A configured column, all NULL if it is not configured or not there."""
    if not name or name not in df.columns:
        return F.lit(None).cast(dtype)
    return F.col(f"`{name}`")


def coalesce_columns(df: DataFrame, primary: str | None, fallbacks: list[str] | None = None) -> Column:
    """First non-blank of a primary column and its fallbacks, cleaned."""
    return F.coalesce(*[clean_text(column_or_null(df, c)) for c in [primary, *(fallbacks or [])]])


def _rule_condition(column: str, rule: dict) -> Column:
    sensitive = bool(rule.get("case_sensitive", False))
    tests = []
    if rule.get("values"):
        values = [str(v).strip() if v is not None else "" for v in rule["values"]]
        tests.append(
            filter_value(F.col(f"`{column}`"), sensitive).isin([v if sensitive else v.upper() for v in values])
        )
    if rule.get("regex"):
        pattern = rule["regex"] if sensitive else f"(?iu){rule['regex']}"
        tests.append(as_text(F.col(f"`{column}`")).rlike(pattern))
    condition = reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
    return F.coalesce(condition, F.lit(False))


def apply_row_filters(df: DataFrame, rules: dict | None) -> DataFrame:
    """Keep rows that meet every include rule and no exclude rule.

    A rule is (value in set) or (pattern found); rules on columns the feed lacks are skipped.
    """
    for rule in (rules or {}).get("include") or []:
        if rule.get("column") in df.columns:
            df = df.where(_rule_condition(rule["column"], rule))
    for rule in (rules or {}).get("exclude") or []:
        if rule.get("column") in df.columns:
            df = df.where(~_rule_condition(rule["column"], rule))
    return df


def source_slice(df: DataFrame, config: dict) -> DataFrame:
    """The predicate and projection a feed is published with, on its landed table.

    ``where`` is SQL text and ``select`` a column list; both reach the file scan. Paging of the
    publisher's interface does not apply to landed data.
    """
    kept = df.where(config["where"]) if config.get("where") else df
    return kept.select(*config["select"]) if config.get("select") else kept


def source_counts(staged: DataFrame) -> DataFrame:
    """Staged rows per source."""
    return staged.groupBy("source_name").agg(F.count(F.lit(1)).alias("row_count"))


def number_file_rows(df: DataFrame, file: str, position: str, name: str = ROW_NUMBER, block: int = 1_000_000) -> DataFrame:
    """1..n per file in file order, after filters.

    ``position`` is a file position such as Parquet's ``_metadata.row_index``. Rows are numbered
    inside blocks of positions, and block counts are summed up, so no file is sorted in one task.
    """
    blocked = df.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    counts = blocked.groupBy(file, "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(file).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(file).alias("_f"), F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    local = blocked.withColumn("_local", F.row_number().over(Window.partitionBy(file, "_block").orderBy(position)))
    return (
        local.join(offsets, (F.col(file) == F.col("_f")) & (F.col("_block") == F.col("_b")))
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_block", "_local", "_f", "_b", "_offset")
    )


def number_copies(df: DataFrame, name: str = ROW_NUMBER, chunk: int = 10_000) -> DataFrame:
    """1..k over the k identical copies of a row, for text files that have no positions.

    Copies are counted and written out again in chunks, so a row repeated a billion
    times is never held by one task.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_k"))
    chunks = counted.withColumn("_start", F.explode(F.sequence(F.lit(0), F.floor((F.col("_k") - 1) / F.lit(chunk)))))
    spread = chunks.repartition(*df.columns, "_start")
    first = F.col("_start") * chunk + 1
    last = F.least(F.col("_k"), (F.col("_start") + 1) * chunk)
    return spread.select(*df.columns, F.explode(F.sequence(first, last)).alias(name))


def stage_feed(df: DataFrame, source_name: str, config: dict, row_number: str | None = None) -> DataFrame:
    """Project one feed to the canonical incident columns by its configuration.

    ``row_number`` names an existing position column; it feeds the ids of rows without their own id.
    """
    get = config.get
    source_id = column_or_null(df, get("incident_id_column"))
    number = F.col(row_number).cast("long") if row_number else F.lit(None).cast("long")
    if get("year_column") and get("day_of_year_column"):
        time = column_or_null(df, get("time_column")) if get("time_column") else None
        occurred = parse_year_day(
            column_or_null(df, get("year_column")), column_or_null(df, get("day_of_year_column")), time
        )
    else:
        time = column_or_null(df, get("time_column")) if get("time_column") else None
        occurred = parse_occurred_at(column_or_null(df, get("date_column")), time, get("epoch_timezone"))
    point = get("geocoded_point_column")
    lat, lon = resolve_coordinates(
        column_or_null(df, get("latitude_column")),
        column_or_null(df, get("longitude_column")),
        F.col(f"`{point}`") if point in df.columns else None,
    )
    base = df.select(
        as_text(source_id).alias("_source_id"),
        number.alias("source_row_number"),
        to_count(column_or_null(df, get("count_column"))).alias("incident_count"),
        occurred.alias("occurred_at"),
        coalesce_columns(df, get("offense_column"), get("offense_fallback_columns")).alias("offense_raw"),
        clean_text(column_or_null(df, get("offense_code_column"))).alias("offense_code_raw"),
        as_text(column_or_null(df, get("address_column"))).alias("_address"),
        clean_text(column_or_null(df, get("zip_column"))).alias("zip_raw"),
        lat.alias("latitude_raw"),
        lon.alias("longitude_raw"),
    )
    own_id = clean_text(F.col("_source_id"))
    name = F.lit(source_name)
    derived = stable_hash(
        name,
        *[
            F.col(c)
            for c in ["source_row_number", "occurred_at", "offense_raw", "latitude_raw", "longitude_raw", "_address"]
        ],
    )
    staged = base.select(
        "*",
        F.when(own_id.isNotNull(), stable_hash(name, F.col("_source_id"))).otherwise(derived).alias("incident_id"),
        name.alias("source_name"),
        F.lit(get("jurisdiction_name")).cast("string").alias("jurisdiction_name"),
        F.lit(get("jurisdiction_state")).cast("string").alias("jurisdiction_state"),
        own_id.alias("source_incident_id"),
        *[expr.alias(c) for c, expr in date_parts(F.col("occurred_at")).items()],
        clean_text(F.col("_address")).alias("address_raw"),
        F.lit(get("source_crs", "EPSG:4326")).alias("source_crs"),
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
    )
    return staged.select(*STAGED_COLUMNS)


def stage_sources(feeds: dict[str, DataFrame], configs: dict[str, dict], only: list[str] | None = None) -> DataFrame:
    """Filter, stage and append all (or the named) sources."""
    unknown = [n for n in only or [] if n not in configs]
    if unknown:
        raise KeyError(f"unknown sources: {', '.join(unknown)}")
    staged = []
    for name in only or list(configs):
        feed = apply_row_filters(feeds[name], configs[name].get("row_filters"))
        staged.append(stage_feed(feed, name, configs[name], ROW_NUMBER if ROW_NUMBER in feed.columns else None))
    return reduce(lambda a, b: a.unionByName(b), staged)


def quality_score(dated: Column, known: Column, located: Column, keyed: Column) -> Column:
    """Mean of four completeness flags."""
    return round_half_even(
        (dated.cast("int") + known.cast("int") + located.cast("int") + keyed.cast("int")).cast("double") / F.lit(4.0), 3
    )


def quality_notes(dated: Column, known: Column, located: Column, keyed: Column) -> Column:
    return notes_of(
        (~dated, "missing_or_invalid_date"),
        (~known, "unknown_offense"),
        (~located, "missing_or_invalid_coordinates"),
        (~keyed, "missing_or_invalid_zip"),
    )


def normalize_incidents(
    staged: DataFrame,
    mapping: dict | None = None,
    placeholders: list[tuple[float, float]] = PLACEHOLDER_COORDINATES,
) -> DataFrame:
    """Classify, clean keys and coordinates, grade each row. Map-only: no shuffle."""

    def col(name: str, dtype: str = "string") -> Column:
        return column_or_null(staged, name, dtype)

    def number(name: str) -> Column:
        return number_column(staged, name) if name in staged.columns else F.lit(None).cast("double")

    base = staged.select(
        col("incident_id").alias("incident_id"),
        col("source_name").alias("source_name"),
        F.coalesce(number("incident_count").try_cast("long"), F.lit(1)).alias("incident_count"),
        col("jurisdiction_name").alias("jurisdiction_name"),
        col("jurisdiction_state").alias("jurisdiction_state"),
        col("occurred_at", "timestamp_ntz").alias("occurred_at"),
        col("occurred_date", "date").alias("occurred_date"),
        col("occurred_year", "int").cast("int").alias("occurred_year"),
        col("occurred_month", "int").cast("int").alias("occurred_month"),
        clean_text(col("offense_raw")).alias("offense_raw"),
        match_text(col("address_raw")).alias("address_normalized"),
        clean_text(col("zip_raw")).alias("zip_raw"),
        five_digit_key(col("zip_raw")).alias("zcta_from_zip"),
        number("latitude_raw").alias("_lat"),
        number("longitude_raw").alias("_lon"),
    )
    labelled = classify_text(base, "offense_raw", mapping or STARTER_RULES).withColumn(
        "_located", valid_coordinates(F.col("_lat"), F.col("_lon"), placeholders)
    )
    group = F.col("offense_group")
    flags = (
        F.col("occurred_date").isNotNull(),
        group != "unknown",
        F.col("_located"),
        F.col("zcta_from_zip").isNotNull(),
    )
    full = labelled.select(
        "*",
        (group == "violent").alias("is_violent"),
        (group == "property").alias("is_property"),
        F.when(F.col("_located"), F.col("_lat")).alias("latitude"),
        F.when(F.col("_located"), F.col("_lon")).alias("longitude"),
        point_wkt(F.col("_lat"), F.col("_lon"), F.col("_located")).alias("geom_wkt"),
        quality_score(*flags).alias("data_quality_score"),
        quality_notes(*flags).alias("normalization_notes"),
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
    )
    return full.select(*NORMALIZED_COLUMNS)
