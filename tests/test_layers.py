"""Crosswalks, agency names, baseline layer, published records, classification."""

import json

import pytest


from arealens.operators.agencies import name_lookup
from arealens.operators.classify import classify_distinct, classify_text
from arealens.operators.crosswalk import allocate_counties, allocated_annual
from arealens.operators.groups import group_profile, requested_members
from arealens.operators.layers import modeled_annual, modeled_layer
from arealens.sinks.bundle import area_documents, manifest, publishable
from arealens.sinks.writers import write_report
from arealens.sources.lineage import typed_records

RULES = {
    "violent": {"robbery": {"keywords": ["robbery"]}, "threat": {"keywords": ["terroristic threat"]}},
    "property": {"burglary": {"keywords": ["burglary", "b&e"]}, "vehicle": {"keywords": ["auto theft"]}, "theft": {"keywords": ["theft"]}},
    "drug": {"drug": {"keywords": ["narcotics", "poss marij"], "regexes": ["hsc [0-9]+"]}},
    "weapons": {"weapons": {"keywords": ["gun"]}},
    "public_order": {"disorder": {"keywords": ["protective order", "interfer w emergency"]}},
}


@pytest.mark.parametrize(
    "text,expected",
    [
        ("ROBBERY - STREET", "violent/robbery"), ("Burglary residence", "property/burglary"), ("AUTO THEFT", "property/vehicle"),
        ("theft with gun", "weapons/weapons"), ("Protective Order (robbery)", "public_order/disorder"), ("shotgunning", "unknown/unknown"),
        ("PC 1 Interfer W/Emergency Call", "public_order/disorder"), ("HSC 481 robbery", "drug/drug"), ("B&E night", "property/burglary"),
        ("terroristic threats", "violent/threat"), ("", "unknown/unknown"), (None, "unknown/unknown"),
    ],
)
def test_classification(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    for op in (classify_text, classify_distinct):
        row = op(df, "t", RULES).first()
        assert f"{row.offense_group}/{row.offense_subgroup}" == expected


def test_multi_county_agency_goes_to_the_largest(spark):
    agencies = spark.createDataFrame(
        [(1, "NM", "Tallgrass Police Department", "35101|35103|35107", "Aster|Briar|Clover")],
        "id int, state_code string, agency_name string, county_fips string, county_name string",
    )
    people = spark.createDataFrame([("35101", 1200), ("35103", 98000), ("35107", 40500)], "county_fips string, population_total bigint")
    row = name_lookup(agencies, people, "id", places_only=True).first()
    assert (row.name_key, row.county_fips, row.county_name, row.match_count) == ("tallgrass", "35103", "Briar", 1)
    assert row.lookup_notes == "multi_county_agency:35101|35103|35107;primary_county_by_population"


def test_allocation_rescales_over_reporting_counties(spark):
    links = spark.createDataFrame([("1", "A", 0.5), ("1", "B", 0.25), ("1", "C", 0.25), ("2", "A", 1.0)], "zcta string, county_fips string, allocation_weight double")
    people = spark.createDataFrame([("1", 2024, 1000), ("2", 2024, 500)], "zcta string, year int, population_total bigint")
    county = spark.createDataFrame(
        [("A", 2024, "Alpha", "NY", 900, 10.0, 4.0, 6.0, "t"), ("B", 2024, "Beta", "NY", 300, 40.0, 10.0, 30.0, "t")],
        "county_fips string, year int, county_name string, state_code string, population_total bigint, total_rate_per_1000 double, violent_rate_per_1000 double, property_rate_per_1000 double, source_names string",
    )
    allocation = allocate_counties(links, people, county)
    rows = {(r.zcta, r.county_fips): r for r in allocation.collect()}
    assert rows[("1", "A")].allocation_weight == pytest.approx(2 / 3) and rows[("1", "B")].allocation_weight == pytest.approx(1 / 3)
    assert rows[("1", "B")].allocated_total_incident_count == pytest.approx(1000 / 3 * 40 / 1000)
    area = {r.zcta: r for r in allocated_annual(allocation, people).collect()}
    assert (area["1"].total_incident_count, area["1"].county_fips, area["1"].drug_incident_count) == (20, "A|B", None)
    assert json.loads(area["1"].county_components)[0] == {"county_fips": "A", "county_name": "Alpha", "weight": 0.666667}


def test_baseline(spark):
    people = spark.createDataFrame([("10001", 2024, 1000), ("10002", 2024, 0)], "zcta string, year int, population_total bigint")
    rows = {r.zcta: r for r in modeled_annual(people, 6.0, 21.2).collect()}
    r = rows["10001"]
    assert (r.violent_incident_count, r.property_incident_count, r.total_incident_count, r.weapons_incident_count) == (6, 21, 27, None)
    assert rows["10002"].violent_incident_count is None and rows["10002"].total_incident_count == 0
    layer = {r.zcta: r for r in modeled_layer(people, "base", "uniform").collect()}
    assert (layer["10001"].overall_incident_score_0_100, layer["10001"].confidence_grade, layer["10001"].is_modeled) == (50.0, "C", True)
    assert layer["10002"].violent_score_label == "unavailable"


def test_only_observed_records_are_published(spark):
    raw = spark.createDataFrame(
        [("601", "2024", "source_universe", "1000", "False", "42.5", "observed"), ("602", "2024", "source_universe", "1000", "False", "5.0", "partial_observed"), ("603", "2024", "state", "9", "True", "50", "observed")],
        "zcta string, year string, comparison_scope string, population_total string, is_modeled string, overall_incident_score_0_100 string, coverage_status string",
    )
    records = publishable(typed_records(raw))
    row = records.first()
    assert records.count() == 1
    assert (row.zcta, row.year, row.population_total, row.is_modeled, row.overall_incident_score_0_100) == ("00601", 2024, 1000, False, 42.5)
    document = json.loads(area_documents(records).first().document)
    assert (document["zip"], document["api_path"], document["api_version"]) == ("00601", "/api/v1/2024/zips/00601.json", "v1")
    assert manifest(records).first().row_count == 1


def test_group_profile_weights_and_fallback(spark):
    from arealens.constants import COUNT_COLUMNS, SCORE_COLUMNS_OUT

    def rec(z, pop, n, score, status):
        return (z, 2024, pop, *[n] * len(COUNT_COLUMNS), *[score] * len(SCORE_COLUMNS_OUT), status)

    schema = "zcta string, year int, population_total bigint, " + ", ".join(f"{c} bigint" for c in COUNT_COLUMNS) + ", " + ", ".join(f"{c} double" for c in SCORE_COLUMNS_OUT) + ", coverage_status string"
    records = spark.createDataFrame([rec("00001", 100, 5, 10.0, "observed"), rec("00002", 300, None, 50.0, "national_modeled"), rec("00003", None, 1, 90.0, "observed")], schema)
    wanted = spark.createDataFrame([("g", "1"), ("g", "2"), ("g", "9"), ("h", "3")], "group_id string, zcta string")
    rows = {r.group_id: r for r in group_profile(requested_members(wanted, records)).collect()}
    g = rows["g"]
    assert (g.requested_zip_count, g.found_zip_count, g.missing_zip_count, g.population_total, g.total_incident_count) == (3, 2, 1, 400, 5)
    assert (g.total_rate_per_1000, g.violent_score_0_100, g.violent_score_label) == (12.5, 40.0, "average")
    assert (rows["h"].violent_score_0_100, rows["h"].total_rate_per_1000) == (90.0, None)


def test_report_files(spark, tmp_path):
    report = spark.createDataFrame([("b", "x", 1.0), ("a", "y", None)], "section string, metric string, value double")
    paths = write_report(report, str(tmp_path))
    lines = [r.value for r in spark.read.text(paths["markdown"]).collect()]
    assert sorted(lines) == ["## a", "## b", "- x: 1.0", "- y: null"]
    assert spark.read.json(paths["json"]).count() == 2
