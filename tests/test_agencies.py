"""County names of table rows: each label is read and resolved once."""

from arealens.operators.agencies import agency_name_keys, resolve_rows

LOOKUP = "state_code string, name_key string, county_fips string, county_name string, match_count bigint, lookup_notes string"


def test_labels_are_read_once_however_many_rows_bear_them(spark):
    rows = [
        (1, "10", "CA", None, "St. Ring County"), (2, "10", "CA", None, "St. Ring County"), (3, "10", "CA", None, None),
        (4, "8", "CA", "Oak city", None), (5, "9", "CA", "Oak Police Department", None), (6, "9", None, "Oak Police Department", None),
        (7, None, "CA", "Oak Police Department", "x"), (7, None, "CA", "Oak Police Department", "y"), (8, "8", "CA", None, None), (9, "8", "NV", "Elm", None),
    ]
    table = spark.createDataFrame(rows, "id int, table_number string, state_code string, agency_label string, county_label string")
    counties = spark.createDataFrame([("CA", "saint ring", "06001", "St. Ring County")], "state_code string, name_key string, county_fips string, county_name string")
    places = spark.createDataFrame([("CA", "oak", "06003", "Oak", 2, None), ("NV", "elm", "32001", "Elm", 3, "multi")], LOOKUP)
    agencies = spark.createDataFrame([("CA", "oak", "06005", "Oak", 1, None), (None, "oak", "x", "x", 1, None)], LOOKUP)
    out = resolve_rows(table, counties, places, agencies)
    assert out.columns == [*table.columns, "county_fips", "county_name", "mapping_method", "mapping_notes"]
    got = sorted((r.id, r.county_label or "", r.county_fips, r.mapping_method, r.mapping_notes) for r in out.collect())
    agency = ("06005", "agency_name_lookup", None)
    assert got == [
        (1, "St. Ring County", "06001", "county_name", None), (2, "St. Ring County", "06001", "county_name", None),
        (3, "", None, "unmatched_county_name", "county_not_found:None"),
        (4, "", "06003", "agency_city_lookup_ambiguous_same_county", None), (5, "", *agency),
        (6, "", None, "unmatched_agency_name", "agency_not_found:Oak Police Department"),
        (7, "x", *agency), (7, "y", *agency),
        (8, "", None, "unmatched_city", None), (9, "", "32001", "agency_city_lookup_primary_county", "multi"),
    ]
    assert "regexp_replace" not in out._jdf.queryExecution().executedPlan().toString()


def test_names_are_read_once_however_many_agencies_bear_them(spark):
    rows = [(i, "CA", "Oak Police Department") for i in range(3)] + [(3, None, "Elm city police"), (3, "NV", "Elm city police"), (4, "NV", None), (5, "NV", "police")]
    agencies = spark.createDataFrame(rows, "id int, state_code string, agency_name string")
    out = agency_name_keys(agencies, "id")
    assert out.columns == ["id", "state_code", "name_key"]
    got = sorted((r.id, r.state_code or "", r.name_key) for r in out.collect())
    assert got == [(0, "CA", "oak"), (1, "CA", "oak"), (2, "CA", "oak"), (3, "", "elm"), (3, "", "elm city"), (3, "NV", "elm"), (3, "NV", "elm city")]
    assert "regexp_replace" not in out._jdf.queryExecution().executedPlan().toString()
