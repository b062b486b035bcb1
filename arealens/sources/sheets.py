"""Published offence tables, landed as cell grids, to agency rows.

A grid row is (sheet, row_idx, cells): the text cells of one line of one sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import STATES, TERRITORIES
from arealens.functions.fixed import fixed_table
from arealens.functions.text import drop_footnote, header_name, match_text, to_whole

#: Output column -> header name of the counts every table may carry; callers add those of their publisher.
THEFT_FIELDS = {
    "murder_count": "murder_and_nonnegligent_manslaughter",
    "rape_count": "rape",
    "robbery_count": "robbery",
    "aggravated_assault_count": "aggravated_assault",
    "burglary_count": "burglary",
    "larceny_theft_count": "larceny_theft",
    "motor_vehicle_theft_count": "motor_vehicle_theft",
    "arson_count": "arson",
}


def header_rows(grid: DataFrame, keys: list[str], markers: tuple[str, ...]) -> DataFrame:
    """First row of each sheet that has a cell for every marker, as column names."""
    plain = F.transform("cells", match_text)
    is_header = F.lit(True)
    for marker in markers:
        is_header = is_header & F.array_contains(plain, marker)
    first = grid.where(is_header).groupBy(*keys).agg(F.min_by("cells", "row_idx").alias("_h"), F.min("row_idx").alias("header_idx"))
    return first.select(*keys, "header_idx", F.transform("_h", header_name).alias("header"))


def failed_sheets(grid: DataFrame, markers: tuple[str, ...], sheet: str = "sheet", table: str = "table_number") -> DataFrame:
    """Sheets that ``offense_rows`` cannot read, with the reason: no header row, or an unknown table number."""
    sheets = grid.groupBy(sheet, table).agg(F.count(F.lit(1)).alias("grid_rows"))
    headers = header_rows(grid, [sheet, table], markers).select(sheet, table, F.lit(True).alias("_has"))
    reason = F.when(~F.coalesce(F.col(table).cast("string").isin(*TABLES), F.lit(False)), F.lit("unknown_table")).when(F.col("_has").isNull(), F.lit("no_header"))
    return sheets.join(headers, [sheet, table], "left").select(sheet, table, "grid_rows", reason.alias("reason")).where("reason is not null")


TABLES = ("8", "9", "10", "11")


def sheet_records(grid: DataFrame, keys: list[str], markers: tuple[str, ...]) -> DataFrame:
    """Data rows below the header as a column-name -> cell map; fully blank rows are dropped.

    A sheet is a landed file, so there are few headers; they still join without a size assumption.
    """
    headers = header_rows(grid, keys, markers)
    below = grid.join(headers, keys).where(F.col("row_idx") > F.col("header_idx"))
    filled = below.where(F.exists("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    n = F.least(F.size("header"), F.size("cells"))
    entries = F.zip_with(F.slice("header", F.lit(1), n), F.slice("cells", F.lit(1), n), lambda h, c: F.struct(h.alias("h"), c.alias("c")))
    # Of columns with equal names the last one counts.
    return filled.select(*keys, "row_idx", F.expr("cells"), entries.alias("_e")).select(
        *keys,
        "row_idx",
        F.map_from_entries(
            F.aggregate(
                "_e",
                F.array().cast("array<struct<h:string,c:string>>"),
                lambda acc, e: F.concat(
                    F.filter(acc, lambda x: x["h"] != e["h"]), F.array(e)
                ),
            )
        ).alias("record"),
    )


def state_names(df: DataFrame) -> DataFrame:
    rows = [(s[2], s[0]) for s in STATES] + [(t[2], t[0]) for t in TERRITORIES]
    named = fixed_table(df.sparkSession, ["state_name", "state_code"], rows)
    return named.withColumn("_state_key", match_text(F.col("state_name")))


def offense_rows(
    grid: DataFrame, markers: tuple[str, ...], count_fields: dict[str, str], sheet: str = "sheet", table: str = "table_number"
) -> DataFrame:
    """Agency rows of tables 8 to 11; rows without a known state or an agency are dropped.

    ``markers`` are the cells that tell a header row, ``count_fields`` maps outputs to header names.
    Sheets that cannot be read are listed by :func:`failed_sheets`.
    """
    records = sheet_records(grid, [sheet, table], markers)
    number = F.col(table).cast("string")

    def cell(name: str) -> Column:
        return F.try_element_at("record", F.lit(name))

    agency, unit = drop_footnote(cell("agency")), drop_footnote(cell("unit_office"))
    present = lambda c: F.nullif(c, F.lit(""))
    label = (
        F.when(number == "8", drop_footnote(cell("city")))
        .when(number == "9", drop_footnote(cell("university_college")))
        .when(number == "10", drop_footnote(cell("county")))
        .when(
            number == "11",
            F.when(present(agency).isNotNull() & present(unit).isNotNull(), F.concat(agency, F.lit(" - "), unit)).otherwise(agency),
        )
    )
    kind = (
        F.when(number == "8", F.lit("city"))
        .when(number == "9", F.lit("university_college"))
        .when(number == "10", F.lit("county"))
        .when(number == "11", F.coalesce(present(drop_footnote(cell("state_tribal_other"))), F.lit("state_tribal_other")))
    )
    reported = F.when(number == "8", to_whole(cell("population"))).when(number == "9", to_whole(cell("student_enrollment")))
    rows = records.select(
        F.col(sheet),
        number.alias("table_number"),
        F.concat(F.lit("CIUS Table "), number).alias("table_name"),
        match_text(drop_footnote(cell("state"))).alias("_state_key"),
        present(label).alias("agency_label"),
        kind.alias("agency_type"),
        cell("county").alias("county_label"),
        reported.alias("population_reported"),
        *[to_whole(cell(field)).alias(out) for out, field in count_fields.items()],
    ).where(F.col("agency_label").isNotNull())
    return rows.join(F.broadcast(state_names(grid)), "_state_key").select(
        sheet, "table_number", "table_name", "state_code", "state_name", "agency_label", "agency_type", "county_label",
        "population_reported", *count_fields,
    )
