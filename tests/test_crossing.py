"""Crossing edges of large polygons, and resumable runs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from arealens.operators import crossing
from arealens.operators.crossing import any_cross, crossing_rows
from arealens.operators.stages import Stage, input_fingerprint, run_stages
from arealens.sources.tables import geometry_summary


def wave(n, twist=None):
    """A closed line of n edges around a circle that does not cross itself, unless two neighbours are swapped."""
    points = [((2 + (k % 2) * 0.3) * math.cos(2 * math.pi * k / n), (2 + (k % 2) * 0.3) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    if twist is not None:
        points[twist], points[(twist + 2) % n] = points[(twist + 2) % n], points[twist]
    return "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*points, points[0]]) + "))"


def test_large_rings(spark):
    shapes = [("a", wave(3000)), ("b", wave(3000, 1500)), ("c", wave(60)), ("d", wave(60, 7)), ("e", None), ("f", "POLYGON EMPTY"), ("a", wave(100, 99)), (None, wave(40, 3))]
    row = geometry_summary(spark.createDataFrame(shapes, "zcta string, geom_wkt string"), "zcta").first()
    assert tuple(row) == (8, 1, 4, 1)


@pytest.mark.parametrize("levels, most", [(24, 4), (2, 3)])
def test_cells_find_what_all_pairs_find(spark, monkeypatch, levels, most):
    monkeypatch.setattr(crossing, "LEVELS", levels)
    monkeypatch.setattr(crossing, "CELL_EDGES", most)
    rng = random.Random(3)
    rows = []
    for row in range(25):
        for _ in range(12):
            x, y = rng.random(), rng.random()
            rows.append((row, (x, y, x + rng.uniform(-0.15, 0.15), y + rng.uniform(-0.15, 0.15))))
    df = spark.createDataFrame(rows, "row long, e struct<x1:double,y1:double,x2:double,y2:double>")
    want = df.groupBy("row").agg(F.collect_list("e").alias("edges")).where(any_cross(F.col("edges")))
    got = sorted(r.row for r in crossing_rows(df, "row").collect())
    assert got == sorted(r.row for r in want.collect()) and 0 < len(got) < 25


def test_a_run_is_taken_up_again(spark, tmp_path):
    built = []

    def base(numbers, add):
        built.append("base")
        return numbers.withColumn("v", F.col("id") + add)

    def broken(base):
        built.append("top")
        return base.withColumn("w", F.raise_error(F.lit("stop")).cast("long"))

    def top(base):
        built.append("top")
        return base.withColumn("w", F.col("v") * 2)

    numbers, folder = spark.range(20), str(tmp_path)
    with pytest.raises(Exception, match="stop"):
        run_stages(folder, {"numbers": numbers}, [Stage("base", base, ("numbers",), {"add": 1}), Stage("top", broken, ("base",))])
    stages = [Stage("base", base, ("numbers",), {"add": 1}), Stage("top", top, ("base",))]
    run = run_stages(folder, {"numbers": numbers.repartition(3)}, stages)
    assert built == ["base", "top", "top"] and run.reused == {"base": True, "top": False}
    assert run.tables["top"].agg(F.sum("w")).first()[0] == 2 * sum(range(1, 21))
    assert run_stages(folder, {"numbers": numbers}, stages).reused == {"base": True, "top": True}
    other = [Stage("base", base, ("numbers",), {"add": 2}), stages[1]]
    assert run_stages(folder, {"numbers": numbers}, other).reused == {"base": False, "top": False}
    changed = run_stages(folder, {"numbers": spark.range(21)}, stages)
    assert changed.reused == {"base": False, "top": False} and changed.prints != run.prints
    assert input_fingerprint(numbers) != input_fingerprint(numbers.unionByName(numbers))
    with pytest.raises(ValueError):
        run_stages(folder, {"base": numbers}, stages)
