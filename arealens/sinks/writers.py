"""Replaced sources, aligned rows and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.constants import AREA, CONSUMER_COLUMNS
from arealens.sinks.slices import replace_slices


def replace_sources(df: DataFrame, path: str, sources: list[str] | None = None) -> int:
    """Re-ingest the sources in ``df`` and keep all others; of ``sources``, those now without rows are emptied."""
    return replace_slices(df, path, ["source_name"], [(s,) for s in sources or []])


def align_columns(df: DataFrame, target: list[str]) -> DataFrame:
    """Insert by name: target order, unknown columns dropped, missing ones left out."""
    return df.select(*[c for c in target if c in df.columns])


def append_aligned(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append by name; columns the rows lack become NULL."""
    return table.unionByName(align_columns(rows, table.columns), allowMissingColumns=True)


def consumer_view(index: DataFrame) -> DataFrame:
    """The published projection of the index."""
    return align_columns(index, CONSUMER_COLUMNS)


def export_table(df: DataFrame, path: str, fmt: str, order: list[str] | None = None) -> None:
    """Ordered CSV, JSON or Parquet export; a range-partitioned sort, one file per range."""
    ordered = df.orderBy(*(order or [AREA]))
    writer = ordered.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported export format: {fmt}")


def scope_suffix(scope: str) -> str:
    return "" if scope == "source_universe" else f"_{scope}"


def export_scores(index: DataFrame, year: int, scope: str, folder: str, formats: tuple[str, ...] = ("csv", "parquet")) -> dict[str, str]:
    """Consumer and full exports of one year and scope."""
    rows = index.where((F.col("year") == year) & (F.col("comparison_scope") == scope))
    written = {}
    for fmt in formats:
        for kind, df in (("scores", consumer_view(rows)), ("index", rows)):
            path = f"{folder}/area_{kind}_{year}{scope_suffix(scope)}.{fmt}"
            export_table(df, path, fmt)
            written[f"{kind}_{fmt}"] = path
    return written


def report_markdown(report: DataFrame) -> DataFrame:
    """The quality report as ordered Markdown lines: a heading per section, a bullet per metric."""
    bullets = report.select(
        "section",
        F.lit(1).alias("_kind"),
        "metric",
        F.concat(F.lit("- "), F.col("metric"), F.lit(": "), F.coalesce(F.col("value").cast("string"), F.lit("null"))).alias("line"),
    )
    headings = report.select("section").distinct().select(
        "section", F.lit(0).alias("_kind"), F.lit("").alias("metric"), F.concat(F.lit("## "), F.col("section")).alias("line")
    )
    return headings.unionByName(bullets).orderBy("section", "_kind", "metric").select("line")


def write_report(report: DataFrame, folder: str) -> dict[str, str]:
    """The quality report as JSON rows and as Markdown text."""
    paths = {"json": f"{folder}/quality_report.json", "markdown": f"{folder}/quality_report.md"}
    export_table(report, paths["json"], "json", ["section", "metric"])
    report_markdown(report).write.mode("overwrite").text(paths["markdown"])
    return paths
