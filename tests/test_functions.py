"""Scalar expressions on hand-written values."""

import datetime

import pytest
from pyspark.sql import functions as F

from arealens.functions import dates, geo, rates, text


def one(spark, expr, **values):
    fields = ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
    df = spark.createDataFrame([tuple(values.values())], fields) if values else spark.range(1)
    return df.select(expr.alias("x")).first()[0]


@pytest.mark.parametrize(
    "given,expected",
    [("  a \t b ", "a b"), ("", None), ("   ", None), ("NaN", None), ("None", None), ("null", None), (" nan ", "nan"), (None, None), ("x  y", "x y")],
)
def test_clean_text(spark, given, expected):
    assert one(spark, text.clean_text(F.col("v")), v=given) == expected


@pytest.mark.parametrize(
    "given,expected", [("Theft/From-Auto", "theft from auto"), (None, ""), ("B&E", "b e"), ("--", ""), ("A_b", "a b")]
)
def test_match_text(spark, given, expected):
    assert one(spark, text.match_text(F.col("v")), v=given) == expected


@pytest.mark.parametrize(
    "given,expected",
    [("12345-6789", "12345"), ("ZCTA5 54321", "54321"), ("860Z200US13579", "13579"), ("no key", None), ("", None), (None, None)],
)
def test_five_digit_key(spark, given, expected):
    assert one(spark, text.five_digit_key(F.col("v")), v=given) == expected


@pytest.mark.parametrize("given,expected", [("1.5", 1.5), ("nan", None), ("x", None), ("1.0d", None), (" 7 ", 7.0), (None, None)])
def test_to_double(spark, given, expected):
    assert one(spark, text.to_double(F.col("v")), v=given) == expected


@pytest.mark.parametrize("given,expected", [("4", 4), (None, 1), ("x", 1), ("0", 1), ("-3", 1), ("2.5", 2), ("3.5", 4)])
def test_to_count(spark, given, expected):
    assert one(spark, text.to_count(F.col("v")), v=given) == expected


@pytest.mark.parametrize("given,expected", [("1,234", 1234), ("-", None), ("--", None), ("12.9", 12), ("", None)])
def test_to_whole(spark, given, expected):
    assert one(spark, text.to_whole(F.col("v")), v=given) == expected


def test_name_keys(spark):
    assert one(spark, text.county_key(F.col("v")), v="Suffolk County") == "suffolk"
    assert one(spark, text.county_key(F.col("v")), v="St. Charles City") == "saint charles"
    assert one(spark, text.agency_place_key(F.col("v")), v="Salem Police Department") == "salem"
    assert one(spark, text.agency_place_key(F.col("v")), v="Dover Department of Public Safety") == "dover"
    assert one(spark, text.place_key(F.col("v")), v="Carson City") == "carson"
    assert one(spark, text.agency_key(F.col("v")), v="Essex County Sheriff's Office") == "essex county"
    assert one(spark, text.county_fips(F.col("v")), v="1001") == "01001"
    assert one(spark, text.county_fips(F.col("v")), v="0500000US25021") == "25021"


def test_append_note(spark):
    assert one(spark, text.append_note(F.col("v"), "b"), v="a") == "a; b"
    assert one(spark, text.append_note(F.col("v"), "b"), v="a; b") == "a; b"
    assert one(spark, text.append_note(F.col("v"), "b"), v=None) == "b"
    assert one(spark, text.append_note(F.col("v"), "bc", whole_note=False), v="abcd") == "abcd"


@pytest.mark.parametrize(
    "date,time,expected",
    [
        ("2023-01-01T00:00:00.000", "0845", (2023, 1, 1, 8, 45)),
        ("2023-01-01 00:00:00", "5", (2023, 1, 1, 0, 5)),
        ("02/03/2024", None, (2024, 2, 3, 0, 0)),
        ("2/3/2024 4:05:00 PM", None, (2024, 2, 3, 16, 5)),
        ("2024-03-02T13:47:00", None, (2024, 3, 2, 13, 47)),
        ("2024-03-02", "13:47", (2024, 3, 2, 13, 47)),
        ("2024-03-02", "2561", None),
        ("2024-03-02", "nan", (2024, 3, 2, 0, 0)),
        ("nonsense", None, None),
        (None, "0845", None),
        ("1712289600000", None, (2024, 4, 5, 4, 0)),
    ],
)
def test_parse_occurred_at(spark, date, time, expected):
    got = one(spark, dates.parse_occurred_at(F.col("d"), F.col("t")), d=date, t=time)
    assert got == (None if expected is None else datetime.datetime(*expected))


def test_epoch_moves_only_with_a_zone(spark):
    assert one(spark, dates.parse_occurred_at(F.col("d")), d=1735690124000) == datetime.datetime(2025, 1, 1, 0, 8, 44)
    zoned = dates.parse_occurred_at(F.col("d"), timezone="America/New_York")
    assert one(spark, zoned, d=1735690124000) == datetime.datetime(2024, 12, 31, 19, 8, 44)


@pytest.mark.parametrize(
    "y,d,t,expected",
    [
        ("2024", "159", "20:00", datetime.datetime(2024, 6, 7, 20)),
        ("2023", "366", None, datetime.datetime(2024, 1, 1)),
        ("2024", "0", None, None),
        ("2024", "10", "soon", datetime.datetime(2024, 1, 10)),
        (None, "10", None, None),
    ],
)
def test_parse_year_day(spark, y, d, t, expected):
    assert one(spark, dates.parse_year_day(F.col("y"), F.col("d"), F.col("t")), y=y, d=d, t=t) == expected


def test_point_text(spark):
    def both(v):
        lat, lon = geo.parse_point(F.col("v"))
        return one(spark, F.concat_ws("|", lat.cast("string"), lon.cast("string")), v=v)

    assert both("POINT (-96.5 32.25)") == "32.25|-96.5"
    assert both("(32.25, -96.5)") == "32.25|-96.5"
    assert both("POINT EMPTY") == ""


def test_rates_and_labels(spark):
    rate = rates.safe_rate(F.col("c"), F.col("p"))
    assert one(spark, rate, c=10, p=1000) == 10
    assert one(spark, rate, c=10, p=0) is None
    df = spark.createDataFrame([(None,), (0.0,), (20.0,), (59.9,), (80.0,)], "s double")
    got = [r[0] for r in df.select(rates.score_label(F.col("s"))).collect()]
    assert got == ["unavailable", "very_low", "low", "average", "very_high"]


def test_confidence_grades(spark):
    rows = [
        ("observed", 5000, 50, 0.95, 0.9), ("observed", 5000, 3, 0.95, 0.9), ("observed", 600, 50, 0.8, 0.8),
        ("observed", 200, 50, 0.1, 0.6), ("observed", 200, 50, 0.1, 0.2), ("observed", 50, 50, 1.0, 1.0),
        ("observed", None, 50, 1.0, 1.0), ("partial_observed", 90000, 10, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "s string, p bigint, n bigint, sh double, c double")
    got = [r[0] for r in df.select(rates.confidence_grade(*[F.col(x) for x in ("s", "p", "n", "sh", "c")])).collect()]
    assert got == ["A", "C", "B", "C", "D", "D", "D", "D"]
