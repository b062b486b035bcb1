"""Order statistics and the index against direct computation."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from arealens.constants import CATEGORIES, count_col
from arealens.functions.rates import round_decimal
from arealens.operators.ranking import fixed_domain_percentiles, global_row_number
from arealens.operators.scores import build_index, percentile_ranks, winsorize, z_scores
from arealens.operators.skew import hottest_keys, lookup_join


def percent_rank(s: pd.Series) -> pd.Series:
    v = s.dropna()
    if len(v) and v.max() == 0 and v.min() == 0:
        return s.where(s.isna(), 0.0)
    if len(v) == 1:
        return s.where(s.isna(), 0.5)
    return (s.rank(method="average") - 1) / (len(v) - 1)


@pytest.fixture()
def skewed():
    """A third of the values equal, groups of one, all-zero groups, NULL values and a NULL group."""
    rng = random.Random(3)
    rows = [(i, "big", 7.25 if i % 3 == 0 else rng.choice([rng.uniform(0, 50), round(rng.uniform(0, 9))]), float(i % 5)) for i in range(900)]
    rows += [(1000 + i, "zero", 0.0, None) for i in range(5)] + [(2000, "single", 3.0, -0.0), (2001, "gone", None, 1.0)]
    rows += [(3000 + i, None, float(i % 4), rng.gauss(0, 1)) for i in range(20)]
    return pd.DataFrame(rows, columns=["k", "g", "a", "b"])


def test_repeated_rows_keep_their_own_outcomes(spark):
    """Rows of one area and year that differ in value are scored each for itself, whatever the join."""
    df = spark.createDataFrame([("x", 1.0), ("x", 5.0), ("y", 3.0)], "k string, v double").withColumn("g", F.lit("all"))
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = z_scores(df, {"v": "z"}, ["g"])
            assert out.columns == ["k", "v", "g", "z"]
            assert sorted((r.k, r.v, round(r.z, 4)) for r in out.collect()) == [("x", 1.0, -1.2247), ("x", 5.0, 1.2247), ("y", 3.0, 0.0)]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_statistics_equal_direct_computation(spark, skewed):
    df = spark.createDataFrame(skewed.astype(object).where(skewed.notna(), None).values.tolist(), "k bigint, g string, a double, b double")
    groups = skewed.groupby(skewed["g"].fillna("NULL"))
    ranked = percentile_ranks(df, {"a": "pa", "b": "pb"}, ["g"]).toPandas().set_index("k").sort_index()
    clipped = winsorize(df, {"a": "wa"}, ["g"], 0.05, 0.9).toPandas().set_index("k").sort_index()
    standard = z_scores(df, {"a": "za"}, ["g"]).toPandas().set_index("k").sort_index()
    want = skewed.set_index("k").sort_index()
    for c in ("a", "b"):
        expected = groups[c].transform(percent_rank)
        expected.index = skewed["k"]
        pd.testing.assert_series_equal(ranked[f"p{c}"], expected.sort_index().rename(f"p{c}").astype(float), check_names=False)
    clip = groups["a"].transform(lambda s: s.clip(s.quantile(0.05), s.quantile(0.9)))
    clip.index = skewed["k"]
    pd.testing.assert_series_equal(clipped["wa"], clip.sort_index(), check_names=False)
    z = groups["a"].transform(lambda s: (s - s.mean()) / s.std(ddof=0) if s.std(ddof=0) else s * 0.0)
    z.index = skewed["k"]
    pd.testing.assert_series_equal(standard["za"], z.sort_index(), check_names=False, atol=1e-9)
    assert len(want) == len(ranked)


def test_lookup_join_with_hot_and_missing_keys(spark):
    rows = spark.range(300).select("id", F.when(F.col("id") < 150, 1).when(F.col("id") < 170, None).otherwise(F.col("id") % 40).alias("k"))
    lookup = spark.range(1, 30).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    rows = rows.withColumn("k", F.col("k").cast("int"))
    for limit in (1, 5, 100):
        got = lookup_join(rows, lookup, ["k"], hottest_keys(rows.where("k is not null"), ["k"], limit=limit))
        want = rows.join(lookup, "k", "left")
        assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, want.select("id", "k", "v").collect()))


def test_global_row_number(spark):
    df = spark.range(500).select(F.format_string("%05d", F.col("id")).alias("key"), (F.col("id") % 3).alias("v"))
    got = global_row_number(df, [F.desc("v"), F.asc("key")], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 501))
    assert [(r.v, r.key) for r in got] == sorted(((r.v, r.key) for r in got), key=lambda t: (-t[0], t[1]))


def annual(spark, rows):
    names = ["total", *CATEGORIES]
    data = [(z, 2023, p, *[c.get(n, 0) for n in names], "source_universe", "") for z, p, c in rows]
    schema = "zcta string, year int, population_total bigint, " + ", ".join(f"{count_col(n)} bigint" for n in names)
    return spark.createDataFrame(data, schema + ", comparison_scope string, comparison_scope_value string")


def test_index_centre_and_order(spark):
    df = annual(spark, [("1", 1000, {"violent": 1, "property": 2, "total": 3}), ("2", 1000, {"violent": 3, "property": 4, "total": 7}), ("3", 1000, {"violent": 5, "property": 8, "total": 13}), ("4", None, {"violent": 1, "total": 1})])
    rows = {r.zcta: r for r in build_index(df).collect()}
    known = [rows[z] for z in "123"]
    assert round(sum(r.total_index for r in known) / 3, 6) == 100
    assert rows["3"].overall_incident_score_0_100 > rows["1"].overall_incident_score_0_100
    assert rows["4"].total_incident_score_0_100 is None and rows["4"].overall_incident_score_label == "unavailable"
    assert rows["4"].score_notes.startswith("overall_score_unavailable_no_category_scores")
    assert rows["1"].drug_score_0_100 == 0.0


def test_large_area_with_few_incidents_is_partial(spark):
    df = annual(spark, [("92336", 100000, {"property": 1, "total": 1}), ("90650", 100000, {"violent": 50, "property": 150, "total": 200})])
    ratios = spark.createDataFrame([(2023, 1.0, 1.0, 1.0, 1.0)], "year int, zcta_assignment_rate double, spatial_assignment_rate double, offense_classification_rate double, date_completeness_rate double")
    seen = spark.createDataFrame(
        [("92336", 2023, 1, 1, 1, "s", 1.0), ("90650", 2023, 200, 200, 1, "s", 1.0)],
        "zcta string, year int, assigned_count bigint, spatial_count bigint, source_count bigint, source_names string, spatial_assignment_share double",
    )
    rows = {r.zcta: r for r in build_index(df, ratios, seen).collect()}
    assert (rows["92336"].coverage_status, rows["92336"].confidence_grade, rows["92336"].observed_level) == ("partial_observed", "D", "zcta_partial")
    assert "partial_observed_high_population_low_incident_count" in rows["92336"].score_notes
    assert (rows["90650"].coverage_status, rows["90650"].confidence_grade) == ("observed", "A")


def test_overall_percentile_leaves_the_rows_where_they_are(spark):
    rows = [(i, "a" if i % 3 else None, None if i % 11 == 0 else (i * 7 % 90) / 10.0) for i in range(200)] + [(900, "one", 4.5), (901, "zero", 0.0), (902, "zero", 0.0)]
    df = spark.createDataFrame(rows, "id int, g string, s double")
    out = fixed_domain_percentiles(df, "s", "p", ["g"])
    pdf = df.toPandas()
    want = pdf.groupby("g", dropna=False)["s"].transform(percent_rank)
    got = out.toPandas().set_index("id")["p"]
    for i, w in zip(pdf["id"], want, strict=True):
        assert (pd.isna(w) and pd.isna(got[i])) or got[i] == pytest.approx(w)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_round_decimal_is_round(spark):
    rng = random.Random(5)
    values = [None, 0.0, -0.0, -1e-9, 0.5, 1.5, -2.5, 0.125, 2.675, 1.005, 0.0000000005, 1.0000000005, 8.5e3, 9.1e9, 1e300, -1e300, float("inf"), float("-inf"), float("nan")]
    values += [rng.uniform(-9, 9) * 10.0 ** rng.randint(-12, 12) for _ in range(3000)] + [rng.randint(-9999, 9999) / 10**rng.randint(0, 13) for _ in range(3000)]
    values += [rng.randint(-9999, 9999) + rng.randint(0, 10**6) / 10**6 + 0.5 / 10**6 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (3, 6, 9, 12):
        slow, fast = F.round("v", digits), round_decimal(F.col("v"), digits)
        shown = df.select("v", slow.alias("s"), fast.alias("f"))
        assert shown.where(~F.col("s").eqNullSafe(F.col("f"))).collect() == []
        assert {str(r.f) for r in shown.where("f = 0").collect()} <= {"0.0"}
