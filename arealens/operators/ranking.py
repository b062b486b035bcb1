"""Exact order statistics from value histograms.

A comparison group may hold every row, so nothing here sorts a group in one task.
Values are counted first (copies collapse before the shuffle). The distinct values are
then range-partitioned by a sampled, balanced split, ranked inside their range, and
the ranges' totals are summed up to offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.operators.materialize import materialize
from arealens.operators.skew import null_safe_join, salted_join


def unpivot_values(df: DataFrame, carry: list[str], columns: list[str]) -> DataFrame:
    """One row per present value: carried columns, ``m`` (position of the column), ``v``."""
    cells = [F.struct(F.lit(i).alias("m"), (F.col(c).cast("double") + F.lit(0.0)).alias("v")) for i, c in enumerate(columns)]
    long = df.select(*carry, F.explode(F.array(*cells)).alias("_cell"))
    return long.select(*carry, F.col("_cell.m").alias("m"), F.col("_cell.v").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )


def ordered_histogram(df: DataFrame, columns: list[str], groups: list[str]) -> DataFrame:
    """Distinct values with ``cnt``, ``before`` (smaller values in the group) and ``n`` (group size)."""
    g = [*groups, "m"]
    counted = unpivot_values(df, groups, columns).groupBy(*g, "v").agg(F.count(F.lit(1)).alias("cnt"))
    return order_counts(counted, g)


def ranged(df: DataFrame, order: list, name: str) -> DataFrame:
    """Rows with ``_range``, the number of the sorted range they fall in.

    Ranges are balanced by sampling and, where small, merged at run time; a range number is stored
    with its rows, so every later step and every retry sees the same split.
    """
    split = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return materialize(split, name)


def order_counts(counted: DataFrame, g: list[str]) -> DataFrame:
    """Add ``before`` and ``n`` to (group, v, cnt) rows with distinct values."""
    parts = ranged(counted, [*g, "v"], "values")
    totals = parts.groupBy(*g, "_range").agg(F.sum("cnt").alias("_part"))
    # One row per range and group.
    earlier = Window.partitionBy(*g).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *g,
        "_range",
        F.coalesce(F.sum("_part").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_part").over(Window.partitionBy(*g)).alias("n"),
    )
    inside = Window.partitionBy(*g, "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumn("_inside", F.coalesce(F.sum("cnt").over(inside), F.lit(0)))
    joined = null_safe_join(local, offsets, [*g, "_range"], "inner")
    return joined.select(*g, "v", "cnt", (F.col("_offset") + F.col("_inside")).alias("before"), "n")


def group_bounds(hist: DataFrame, g: list[str], lower: float | None, upper: float | None) -> DataFrame:
    """Per group: clipping bounds ``lo`` and ``hi`` (linear-interpolated quantiles) and the plain mean."""

    def at(position):
        hit = (F.col("before") <= position) & (position < F.col("before") + F.col("cnt"))
        return F.max(F.when(hit, F.col("v")))

    mean = (F.sum(F.col("v") * F.col("cnt")) / F.sum("cnt")).alias("centre")
    if lower is None or upper is None:
        open_ended = [F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi")]
        return hist.groupBy(*g).agg(mean).select("*", *open_ended)
    last = (F.col("n") - 1).cast("double")
    spots = {}
    for name, p in (("lo", lower), ("hi", upper)):
        place = last * F.lit(float(p))
        spots[f"{name}_a"] = at(F.floor(place))
        spots[f"{name}_b"] = at(F.ceil(place))
        spots[f"{name}_t"] = F.max(place - F.floor(place))
    picked = hist.groupBy(*g).agg(mean, *[expr.alias(f"_{k}") for k, expr in spots.items()])
    return picked.select(
        *g,
        "centre",
        *[
            (F.col(f"_{s}_a") + (F.col(f"_{s}_b") - F.col(f"_{s}_a")) * F.col(f"_{s}_t")).alias(s)
            for s in ("lo", "hi")
        ],
    )


def value_outcomes(
    df: DataFrame,
    columns: list[str],
    groups: list[str],
    lower: float | None = None,
    upper: float | None = None,
) -> DataFrame:
    """Per distinct value of each column and group: clipped value, average-rank percentile, z-score.

    The percentile is (rank - 1) / (n - 1) with averaged ties, 0 in an all-zero group
    (checked first) and 0.5 in a group of one; z uses the population deviation, 0 if that is 0.
    The histogram and the outcomes are materialised: each is read several times.
    """
    g = [*groups, "m"]
    hist = materialize(ordered_histogram(df, columns, groups), "histogram")
    v, cnt, n = F.col("v"), F.col("cnt"), F.col("n")
    clipped = F.greatest(F.least(v, F.col("hi")), F.col("lo"))
    off = F.col("w") - F.col("centre")
    moments = salted_join(hist, group_bounds(hist, g, lower, upper), g, "inner").withColumn("w", clipped).groupBy(*g).agg(
        F.max("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.min("w").alias("_min"),
        F.max("w").alias("_max"),
        F.sum(F.when(v <= F.col("lo"), cnt).otherwise(0)).alias("_at_lo"),
        F.sum(F.when(v >= F.col("hi"), cnt).otherwise(0)).alias("_at_hi"),
        F.max("centre").alias("_centre"),
        # Moments about the plain mean: no cancellation of large values.
        (F.sum(off * cnt) / F.sum("cnt")).alias("_off1"),
        (F.sum(off * off * cnt) / F.sum("cnt")).alias("_off2"),
    )
    variance = F.greatest(F.col("_off2") - F.col("_off1") * F.col("_off1"), F.lit(0.0))
    summary = moments.withColumns({"_mean": F.col("_centre") + F.col("_off1"), "_std": F.sqrt(variance)})
    full = salted_join(hist, summary, g, "inner").withColumn("w", clipped)
    at_low, at_high = v <= F.col("lo"), v >= F.col("hi")
    tie_before = F.when(at_low, F.lit(0)).when(at_high, n - F.col("_at_hi")).otherwise(F.col("before"))
    tie_count = F.when(at_low, F.col("_at_lo")).when(at_high, F.col("_at_hi")).otherwise(cnt)
    constant = F.col("_min") == F.col("_max")
    rank = tie_before.cast("double") + (tie_count.cast("double") + F.lit(1.0)) / F.lit(2.0)
    rank = F.when(constant, (n.cast("double") + F.lit(1.0)) / F.lit(2.0)).otherwise(rank)
    percentile = (
        F.when(constant & (F.col("_min") == 0), F.lit(0.0))
        .when(n == 1, F.lit(0.5))
        .otherwise((rank - F.lit(1.0)) / (n.cast("double") - F.lit(1.0)))
    )
    z = F.when(constant | (F.col("_std") == 0), F.lit(0.0)).otherwise((F.col("w") - F.col("_mean")) / F.col("_std"))
    return materialize(full.select(*g, "v", "cnt", F.col("w"), percentile.alias("p"), z.alias("z")), "outcomes")


def attach_outcomes(df: DataFrame, outcomes: DataFrame, columns: list[str], groups: list[str], outputs: dict[str, list[str]]) -> DataFrame:
    """Bring per-value outcomes back to the rows, each row for itself.

    ``outputs`` maps an outcome (``w``, ``p`` or ``z``) to one output name per column; outputs come
    last, column by column, and replace columns of that name. One left join per column: the planner
    broadcasts the outcomes where their measured size allows it and splits skewed values otherwise.
    """
    made = {name for names in outputs.values() for name in names}
    kept = [c for c in df.columns if c not in made]
    out = df.select(*kept)
    for i, column in enumerate(columns):
        lookup = outcomes.where(F.col("m") == i).select(
            *[F.col(k).alias(f"_o{i}_{k}") for k in groups],
            F.col("v").alias(f"_o{i}_v"),
            *[F.col(kind).alias(names[i]) for kind, names in outputs.items()],
        )
        match = F.col(column).cast("double") + F.lit(0.0) == F.col(f"_o{i}_v")
        for k in groups:
            match = match & F.col(k).eqNullSafe(F.col(f"_o{i}_{k}"))
        out = out.join(lookup, match, "left")
    return out.select(*kept, *[names[i] for i in range(len(columns)) for names in outputs.values()])


def fixed_domain_percentiles(df: DataFrame, column: str, name: str, groups: list[str], digits: int = 1) -> DataFrame:
    """Average-rank percentiles of a column of few possible values: numbers of ``digits`` decimals in a fixed range.

    As in :func:`value_outcomes`, but a group has no more distinct values than the range has, so they are counted and summed
    up in their order without any splitting of ranges. The lookup is materialised: the planner sees how small it is
    before it plans the join, and leaves the rows, which are wide, where they are. They are read twice, first their
    groups and ``column`` only, and not stored; ``df`` must give the same values both times.
    """
    place = F.rint(F.col(column).cast("double") * 10.0**digits).cast("long")
    counted = df.where(F.col(column).isNotNull()).groupBy(*groups, place.alias("_place")).agg(F.count(F.lit(1)).alias("cnt"))
    group = Window.partitionBy(*groups)
    n, low, high = F.sum("cnt").over(group), F.min("_place").over(group), F.max("_place").over(group)
    before = F.coalesce(F.sum("cnt").over(group.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = before.cast("double") + (F.col("cnt").cast("double") + 1.0) / 2.0
    percentile = F.when((low == high) & (low == 0), F.lit(0.0)).when(n == 1, F.lit(0.5)).otherwise((rank - 1.0) / (n.cast("double") - 1.0))
    lookup = counted.select(*[F.col(k).alias(f"_g_{k}") for k in groups], "_place", percentile.alias(name))
    lookup = materialize(lookup, "places")
    match = place == F.col("_place")
    for k in groups:
        match = match & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return df.join(lookup, match, "left").select(*[c for c in df.columns if c != name], name)


def global_row_number(df: DataFrame, order: list, name: str) -> DataFrame:
    """1..n in the given total order, without one global sort task."""
    parts = ranged(df, order, "ranked")
    earlier = Window.partitionBy(F.lit(0)).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, at most as many as shuffle partitions.
    offsets = (
        parts.groupBy(F.col("_range").alias("_r"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_r", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = parts.withColumn("_within", within).join(F.broadcast(offsets), F.col("_range") == F.col("_r"))
    return numbered.select((F.col("_offset") + F.col("_within")).alias(name), *df.columns)


def priority_rank(df: DataFrame, value: str, key: str, name: str = "priority_rank") -> DataFrame:
    """1..n by value descending, then by key."""
    ranked = global_row_number(df, [F.desc_nulls_last(value), F.asc(key)], name)
    return ranked.withColumn(name, F.col(name).cast("int"))
