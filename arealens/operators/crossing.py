"""Edges of one geometry that cross, found in cells of a quadtree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.operators.materialize import materialize

#: Edges of a cell that are compared with each other; cells with more are split in four.
CELL_EDGES = 48
#: Splits at most; what is crowded in so small a cell is compared by a join.
LEVELS = 24


def _side(a: tuple, b: tuple, x: Column, y: Column) -> Column:
    return F.signum((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]))


def edges_cross(e: Column, f: Column) -> Column:
    """Whether two edges meet inside both of them."""
    a, b, c, d = (e["x1"], e["y1"]), (e["x2"], e["y2"]), (f["x1"], f["y1"]), (f["x2"], f["y2"])
    return (_side(a, b, *c) * _side(a, b, *d) < 0) & (_side(c, d, *a) * _side(c, d, *b) < 0)


def any_cross(edges: Column) -> Column:
    """Whether any two edges of an array cross: all pairs, for arrays of bounded length."""
    return F.exists(edges, lambda e: F.exists(edges, lambda f: edges_cross(e, f)))


def _in_cell() -> Column:
    """Whether the edge ``e`` has a point in the closed cell (west, south, width, height)."""
    west, south = F.col("west"), F.col("south")
    east, north = west + F.col("width"), south + F.col("height")
    x1, y1, x2, y2 = (F.col(f"e.{c}") for c in ("x1", "y1", "x2", "y2"))
    boxes = (F.greatest(x1, x2) >= west) & (F.least(x1, x2) <= east) & (F.greatest(y1, y2) >= south) & (F.least(y1, y2) <= north)
    sides = [_side((x1, y1), (x2, y2), x, y) for x, y in ((west, south), (east, south), (west, north), (east, north))]
    return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def crossing_rows(edges: DataFrame, row: str) -> DataFrame:
    """The distinct ``row`` values of those rows of ``edges`` (row, e: struct x1, y1, x2, y2) that have two crossing edges.

    An edge goes to the cells it passes, so two edges that cross share a cell. Crowded cells are split, level by
    level; no cell holds more than ``CELL_EDGES`` when its edges are compared.
    """
    box = edges.groupBy(row).agg(
        F.min(F.least("e.x1", "e.x2")).alias("west"), F.min(F.least("e.y1", "e.y2")).alias("south"),
        F.max(F.greatest("e.x1", "e.x2")).alias("east"), F.max(F.greatest("e.y1", "e.y2")).alias("north"),
    )
    cells = edges.join(box, row).select(
        row, "e", F.lit("").alias("cell"), "west", "south", (F.col("east") - F.col("west")).alias("width"), (F.col("north") - F.col("south")).alias("height")
    )
    found = []
    for level in range(LEVELS + 1):
        cells = materialize(cells, "cells")
        counts = cells.groupBy(row, "cell").agg(F.count(F.lit(1)).alias("n"))
        sized = cells.join(counts, [row, "cell"])
        small = sized.where(F.col("n") <= CELL_EDGES).groupBy(row, "cell").agg(F.collect_list("e").alias("edges"))
        found.append(small.where(any_cross(F.col("edges"))).select(row))
        crowded = sized.where(F.col("n") > CELL_EDGES).drop("n")
        if crowded.isEmpty():
            break
        if level == LEVELS:
            left, right = crowded.alias("l"), crowded.alias("r")
            same = (F.col(f"l.{row}") == F.col(f"r.{row}")) & (F.col("l.cell") == F.col("r.cell"))
            found.append(left.join(right, same & edges_cross(F.col("l.e"), F.col("r.e"))).select(F.col(f"l.{row}").alias(row)))
            break
        half = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (0, 1) for y in (0, 1)]))
        split = crowded.withColumn("h", half)
        width, height = F.col("width") / 2, F.col("height") / 2
        cells = split.select(
            row, "e", F.concat("cell", F.col("h.x").cast("string"), F.col("h.y").cast("string")).alias("cell"),
            (F.col("west") + F.col("h.x") * width).alias("west"), (F.col("south") + F.col("h.y") * height).alias("south"),
            width.alias("width"), height.alias("height"),
        ).where(_in_cell())
    return reduce(lambda a, b: a.unionByName(b), found).distinct()
