"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So many of the heaviest keys for each shuffle partition are broadcast; any other key then holds less than
# a quarter of an even partition.
HOT_KEYS_PER_PARTITION = 4


def _same(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    pairs = [left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def row_salts(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def hottest_keys(rows: DataFrame, keys: list[str], weight: str | None = None, limit: int | None = None) -> DataFrame:
    """The keys with the most rows, a few for each shuffle partition. ``weight`` names a row count already known."""
    limit = limit or HOT_KEYS_PER_PARTITION * row_salts(rows)
    if weight is None:
        counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
    else:
        counted = rows.select(*keys, F.col(weight).alias("_weight"))
    return counted.orderBy(F.desc("_weight"), *keys).limit(limit).select(*keys)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], hot: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Left join to a lookup that has one row per key, whatever the spread of keys in ``rows``.

    The keys of ``hot`` (see :func:`hottest_keys`) are answered by a
    broadcast whose size that limit bounds. Rows so answered, and rows with a NULL key, are
    then spread over the shuffle by their input partition instead of by their key.
    """
    values = [c for c in lookup.columns if c not in keys]
    wanted = lookup.join(F.broadcast(hot), _same(lookup, hot, keys, null_safe), "left_semi")
    renamed = wanted.select(*[F.col(k).alias(f"_w_{k}") for k in keys], *[F.col(v).alias(f"_h_{v}") for v in values])
    match = [
        F.col(k).eqNullSafe(F.col(f"_w_{k}")) if null_safe else F.col(k) == F.col(f"_w_{k}") for k in keys
    ]
    answered = (
        hot.join(F.broadcast(renamed), reduce(lambda a, b: a & b, match), "left")
        .select(*[F.col(k).alias(f"_w_{k}") for k in keys], *[f"_h_{v}" for v in values])
        .withColumn("_hot", F.lit(True))
    )
    first = rows.join(F.broadcast(answered), reduce(lambda a, b: a & b, match), "left").drop(
        *[f"_w_{k}" for k in keys]
    )
    spread = F.col("_hot").isNotNull()
    if not null_safe:
        spread = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], spread)
    salts = row_salts(rows)
    first = first.withColumn(
        "_salt", F.when(spread, F.pmod(F.spark_partition_id(), F.lit(salts)) + 1).otherwise(F.lit(0))
    )
    rest = lookup.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[F.col(v).alias(f"_v_{v}") for v in values],
        # Always 0, but not a literal: a constant would be folded out of the join key.
        F.pmod(F.hash(*keys), F.lit(1)).alias("_c_salt"),
    )
    cold = [
        F.col(k).eqNullSafe(F.col(f"_c_{k}")) if null_safe else F.col(k) == F.col(f"_c_{k}") for k in keys
    ] + [F.col("_salt") == F.col("_c_salt")]
    joined = first.join(rest, reduce(lambda a, b: a & b, cold), "left")
    return joined.select(
        *[c for c in rows.columns if c not in values],
        *[F.when(F.col("_hot"), F.col(f"_h_{v}")).otherwise(F.col(f"_v_{v}")).alias(v) for v in values],
    )


def salted_join(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join to per-group values where one group may cover all rows.

    The few group rows are repeated once per shuffle partition, so every group is spread over
    all of them. NULL keys match each other.
    """
    salts = row_salts(rows)
    left = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    right = groups.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys],
        *[c for c in groups.columns if c not in keys],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_g_salt"),
    )
    match = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys] + [F.col("_salt") == F.col("_g_salt")]
    return left.join(right, reduce(lambda a, b: a & b, match), how).drop(
        "_salt", "_g_salt", *[f"_g_{k}" for k in keys]
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on keys unique on both sides, NULL matching NULL, left keys kept."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, match), how).drop(*[f"_r_{k}" for k in keys])
