"""The operators' inputs, derived from the star-schema, event and document tables.

Incidents are order lines (area = part) or events (points), populations are part sizes,
counties are suppliers, polygons are drawn from supplier keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.operators.aggregate import annual_aggregates
from arealens.operators.scores import apply_scope
from arealens.plans.registry import table
from arealens.session import checkpoint_dir

LINE_CATEGORY = """
CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'violent'
     WHEN l_returnflag = 'A' THEN 'property'
     WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'drug'
     WHEN l_returnflag = 'N' THEN 'public_order'
     WHEN l_linestatus = 'F' THEN 'weapons'
     WHEN l_discount >= 0.05D THEN 'other'
END"""


def line_incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as incidents that already carry their area; ids repeat, some categories are NULL."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("incident_id"),
        F.concat(F.lit("line_"), "l_returnflag").alias("source_name"),
        F.col("l_partkey").cast("string").alias("zcta"),
        F.year("l_shipdate").alias("occurred_year"),
        F.month("l_shipdate").alias("occurred_month"),
        F.to_date("l_shipdate").alias("occurred_date"),
        F.expr(LINE_CATEGORY).alias("offense_group"),
        F.col("l_quantity").cast("long").alias("incident_count"),
    )


def each_line_year(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """``rows`` once for each ``year`` that order lines have; the years are one row, found by the query itself."""
    years = table(spark, folder, "lineitem").agg(F.collect_set(F.year("l_shipdate")).alias("_years"))
    return rows.join(F.broadcast(years)).withColumn("year", F.explode("_years")).drop("_years")


def part_population(spark: SparkSession, folder: str) -> DataFrame:
    """Residents per part and year of the order lines; some are zero, some unknown."""
    people = F.expr("CASE WHEN p_size = 50 THEN 0 WHEN p_size < 49 THEN p_size * 100 END").cast("long")
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("zcta"), people.alias("population_total"))
    return each_line_year(spark, folder, parts).select("zcta", "year", "population_total")


def part_annual(spark: SparkSession, folder: str, include_population_only: bool = False) -> DataFrame:
    return annual_aggregates(
        line_incidents(spark, folder), part_population(spark, folder), include_population_only=include_population_only
    )


def scoped_annual(spark: SparkSession, folder: str) -> DataFrame:
    return apply_scope(part_annual(spark, folder), "source_universe")


def brand_states(spark: SparkSession, folder: str) -> DataFrame:
    """Part brand in the role of a state; one brand is unknown."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("zcta"),
        F.expr("CASE WHEN p_brand <> 'Brand#7' THEN p_brand END").alias("state_fips"),
    )


def part_assignments(spark: SparkSession, folder: str) -> DataFrame:
    """An assignment table for the order lines: one row per line, method by tax."""
    li = table(spark, folder, "lineitem")
    method = F.expr(
        "CASE WHEN l_tax < 0.02D THEN 'unassigned' WHEN l_tax < 0.06D THEN 'spatial_join' ELSE 'zip_fallback' END"
    )
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("incident_id"),
        F.when(method != "unassigned", F.col("l_partkey").cast("string")).alias("zcta"),
        method.alias("assignment_method"),
    )


def undated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose NULL categories read as unknown and whose January dates are missing."""
    return line_incidents(spark, folder).withColumns(
        {
            "offense_group": F.coalesce("offense_group", F.lit("unknown")),
            "occurred_date": F.when(F.col("occurred_month") > 1, F.col("occurred_date")),
            "latitude": F.when(F.col("incident_count") < 40, F.lit(1.0)),
            "longitude": F.when(F.col("incident_count") > 5, F.lit(1.0)),
            "zcta_from_zip": F.when(F.col("occurred_year") != 1997, F.col("zcta")),
        }
    )


def supplier_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """One polygon per supplier on a 9 x 9 lattice: squares, squares with a hole, triangles."""
    shaped = table(spark, folder, "supplier").selectExpr(
        "lpad(cast(s_suppkey AS string), 8, '0') AS zcta",
        "CASE s_nationkey % 4 WHEN 1 THEN '32' WHEN 2 THEN NULL ELSE '06' END AS state_fips",
        "s_suppkey % 3 AS kind",
        "cast(s_suppkey % 9 - 123 AS int) AS x",
        "cast((s_suppkey div 9) % 9 + 33 AS int) AS y",
    )
    outer = "concat('(', x, ' ', y, ', ', x + 1, ' ', y, ', ', x + 1, ' ', y + 1, ', ', x, ' ', y + 1, ', ', x, ' ', y, ')')"
    corner = "concat({}, ' ', {})"
    low_x, high_x, low_y, high_y = "x + 0.25D", "x + 0.75D", "y + 0.25D", "y + 0.75D"
    hole = "concat('(', " + ", ', ', ".join(
        corner.format(a, b) for a, b in [(low_x, low_y), (low_x, high_y), (high_x, high_y), (high_x, low_y), (low_x, low_y)]
    ) + ", ')')"
    triangle = "concat('(', x, ' ', y, ', ', x + 1, ' ', y, ', ', x + 1, ' ', y, '.777, ', x, ' ', y, ')')"
    wkt = f"""CASE kind WHEN 0 THEN concat('POLYGON (', {outer}, ')')
        WHEN 1 THEN concat('POLYGON (', {outer}, ', ', {hole}, ')')
        ELSE concat('POLYGON (', {triangle}, ')') END"""
    return shaped.select("zcta", "state_fips", F.expr(wkt).alias("geom_wkt"))


def event_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events as incidents with coordinates, a state and an area key of mixed quality."""
    return table(spark, folder, "events").selectExpr(
        "cast(event_id AS string) AS incident_id",
        "CASE event_type WHEN 'error' THEN 'NV' WHEN 'purchase' THEN 'ca' WHEN 'signup' THEN NULL ELSE 'CA' END AS jurisdiction_state",
        "CASE WHEN user_id = 7 THEN 0D WHEN value <= 200 THEN 33D + value % 9D END AS latitude",
        "CASE WHEN user_id = 7 THEN 0D ELSE -123D + (user_id % 90) / 10D END AS longitude",
        "CASE user_id % 5 WHEN 0 THEN lpad(cast(user_id AS string), 8, '0') WHEN 1 THEN '99999999' END AS zcta_from_zip",
    )


def part_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """Part-to-supplier links from order lines, as raw weights; a share of them is missing."""
    li = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))).alias("allocation_weight")
    )
    sup = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return li.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").cast("string").alias("zcta"),
        F.col("l_suppkey").cast("string").alias("county_fips"),
        F.col("s_name").alias("county_name"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("state_code"),
        F.lit("").alias("state_name"),
        "allocation_weight",
    )


def agency_offenses(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as agency table rows of their supplier's county; those of suppliers 5, 14, 23, ... lie in counties without people."""
    li = table(spark, folder, "lineitem")
    sup = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    number = F.expr("CASE l_returnflag WHEN 'A' THEN '8' WHEN 'N' THEN '10' ELSE '11' END")
    return li.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.expr("concat(CASE WHEN l_suppkey % 9 = 5 THEN 'X' ELSE '' END, l_suppkey)").alias("county_fips"),
        F.col("s_name").alias("county_name"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("state_code"),
        F.lit("").alias("state_name"),
        F.year("l_shipdate").alias("year"),
        number.alias("table_number"),
        F.concat(F.lit("Table "), number).alias("table_name"),
        F.when(F.col("l_linenumber") < 6, F.col("l_orderkey").cast("string")).alias("agency_label"),
        F.when(F.col("l_quantity") < 49, F.col("l_quantity")).alias("violent_incident_count"),
        (F.col("l_linenumber") * 2).alias("property_incident_count"),
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder."""
    return f"{checkpoint_dir(spark)}/arealens-{name}-{uuid.uuid4().hex}"
