"""Column contracts, default parameters and fixed lookup values."""

from __future__ import annotations

# --- column contracts: fixed values ---------------------------------------------

CATEGORIES = ["violent", "property", "drug", "public_order", "weapons", "other", "unknown"]
SCORED = ["violent", "property", "drug", "public_order", "weapons", "other"]
BASES = ["total", *SCORED]

AREA = "zcta"
YEAR = "year"
POPULATION = "population_total"
SCOPE_COLUMNS = ["year", "comparison_scope", "comparison_scope_value"]


def count_col(base: str) -> str:
    return f"{base}_incident_count"


def rate_col(base: str) -> str:
    return f"{base}_rate_per_1000"


def winsorized_col(base: str) -> str:
    return f"{base}_rate_winsorized_per_1000"


def score_col(base: str) -> str:
    return "total_incident_score_0_100" if base == "total" else f"{base}_score_0_100"


def percentile_col(base: str) -> str:
    return "total_incident_percentile" if base == "total" else f"{base}_percentile"


def z_col(base: str) -> str:
    return f"{base}_z_score"


def label_col(base: str) -> str:
    return "total_incident_score_label" if base == "total" else f"{base}_score_label"


OVERALL_SCORE = "overall_incident_score_0_100"
OVERALL_LABEL = "overall_incident_score_label"

COUNT_COLUMNS = [count_col("total"), *[count_col(c) for c in CATEGORIES]]
RATE_COLUMNS = [rate_col("total"), *[rate_col(c) for c in CATEGORIES]]
ANNUAL_COLUMNS = [AREA, YEAR, POPULATION, *COUNT_COLUMNS, *RATE_COLUMNS]
MONTHLY_COLUMNS = ["month", *ANNUAL_COLUMNS]

SCORE_COLUMNS_OUT = [OVERALL_SCORE, *[score_col(c) for c in SCORED], score_col("total")]

INDEX_COLUMNS = [
    AREA, YEAR, "comparison_scope", "comparison_scope_value", POPULATION,
    count_col("total"), *[count_col(c) for c in SCORED], count_col("unknown"),
    *RATE_COLUMNS,
    *[winsorized_col(b) for b in BASES],
    *[score_col(b) for b in BASES], OVERALL_SCORE,
    *[percentile_col(b) for b in BASES], "overall_percentile",
    *[z_col(b) for b in [*SCORED, "total"]],
    "violent_index", "property_index", "total_index", "composite_index", "percentile_rank",
    "coverage_status", "data_source_type", "source_names", "source_count",
    "assigned_incident_count", "spatial_incident_count", "is_modeled", "observed_level",
    "county_fips", "county_name", "county_count", "county_components", "allocation_method",
    "data_coverage_score", "confidence_grade", "score_notes",
    *[label_col(c) for c in SCORED], label_col("total"), OVERALL_LABEL,
]

CONSUMER_COLUMNS = [
    AREA, YEAR, "comparison_scope", "comparison_scope_value", POPULATION,
    "coverage_status", "data_source_type", "source_names", "source_count",
    "assigned_incident_count", "spatial_incident_count", "is_modeled", "observed_level",
    "county_fips", "county_name", "county_count", "county_components", "allocation_method",
    OVERALL_SCORE, *[score_col(c) for c in SCORED], score_col("total"),
    "overall_percentile", *[percentile_col(c) for c in SCORED], percentile_col("total"),
    *COUNT_COLUMNS, *[rate_col(b) for b in BASES],
    "data_coverage_score", "confidence_grade", "score_notes",
    OVERALL_LABEL, *[label_col(c) for c in SCORED], label_col("total"),
]

STAGED_COLUMNS = [
    "incident_id", "source_name", "jurisdiction_name", "jurisdiction_state", "source_row_number",
    "source_incident_id", "incident_count", "occurred_at", "occurred_date", "occurred_year",
    "occurred_month", "offense_raw", "offense_code_raw", "address_raw", "zip_raw",
    "latitude_raw", "longitude_raw", "source_crs", "loaded_at",
]

NORMALIZED_COLUMNS = [
    "incident_id", "source_name", "incident_count", "jurisdiction_name", "jurisdiction_state",
    "occurred_at", "occurred_date", "occurred_year", "occurred_month", "offense_raw",
    "offense_normalized", "offense_group", "offense_subgroup", "is_violent", "is_property",
    "address_normalized", "zip_raw", "zcta_from_zip", "latitude", "longitude", "geom_wkt",
    "data_quality_score", "normalization_notes", "created_at",
]

# --- default parameters (fixed values of the scoring method) ------------------

RATE_MULTIPLIER = 1000.0
WINSOR_LOWER, WINSOR_UPPER = 0.01, 0.99
OVERALL_WEIGHTS = {
    "violent": 0.40, "property": 0.30, "weapons": 0.15,
    "drug": 0.05, "public_order": 0.05, "other": 0.05,
}
INDEX_MEAN, INDEX_STD = 100.0, 15.0
COMPOSITE_WEIGHTS = {"violent": 0.60, "property": 0.35, "total": 0.05}
LOW_COUNT_THRESHOLD = 5
PARTIAL_POPULATION = 50_000
PARTIAL_MIN_INCIDENTS = 20
PLACEHOLDER_COORDINATES = [(0.0, 0.0)]
BASELINE_VIOLENT_RATE, BASELINE_PROPERTY_RATE = 3.708, 18.351
BASELINE_SCOPE = "national_modeled_baseline"
COUNTY_SCOPE = "county_observed_allocated"
OBSERVED_SCOPE = "source_universe"
CATEGORY_PRIORITY = ["violent", "weapons", "property", "drug", "public_order", "other"]

# --- fixed values: names for matching -----------------------------------------

NULL_WORDS = ["nan", "none", "null"]

COUNTY_SUFFIXES = [
    "county", "parish", "borough", "census area", "municipio", "municipality",
    "city and borough", "city",
]

PLACE_SUFFIXES = ["city", "town", "village", "borough"]

AGENCY_PHRASES = [
    "police department", "department of police", "dept of police",
    "public safety department", "department of public safety", "dept of public safety",
    "sheriff s office", "sheriff office", "sheriff department", "department", "police",
]

SHEET_HEADER_NAMES = {
    "student enrollment1": "student_enrollment",
}

AREA_ID_COLUMNS = ["ZCTA5CE20", "ZCTA5CE10", "GEOID20", "GEOID10", "GEOID", "zcta"]

# --- fixed values: states. code, FIPS, name, then lat min/max and lon min/max ---

STATES = [
    ("AL", "01", "Alabama", 30.1, 35.1, -88.6, -84.8),
    ("AK", "02", "Alaska", 51.0, 72.0, -180.0, -129.0),
    ("AZ", "04", "Arizona", 31.2, 37.1, -114.9, -109.0),
    ("AR", "05", "Arkansas", 33.0, 36.6, -94.7, -89.6),
    ("CA", "06", "California", 32.4, 42.1, -124.6, -114.0),
    ("CO", "08", "Colorado", 36.9, 41.1, -109.2, -101.9),
    ("CT", "09", "Connecticut", 40.9, 42.1, -73.8, -71.7),
    ("DE", "10", "Delaware", 38.4, 39.9, -75.9, -75.0),
    ("DC", "11", "District of Columbia", 38.7, 39.0, -77.2, -76.8),
    ("FL", "12", "Florida", 24.3, 31.1, -87.8, -79.8),
    ("GA", "13", "Georgia", 30.2, 35.1, -85.7, -80.7),
    ("HI", "15", "Hawaii", 18.8, 22.5, -160.4, -154.7),
    ("ID", "16", "Idaho", 42.0, 49.1, -117.4, -111.0),
    ("IL", "17", "Illinois", 36.9, 42.6, -91.6, -87.0),
    ("IN", "18", "Indiana", 37.7, 41.8, -88.2, -84.7),
    ("IA", "19", "Iowa", 40.3, 43.6, -96.8, -90.0),
    ("KS", "20", "Kansas", 36.9, 40.1, -102.2, -94.5),
    ("KY", "21", "Kentucky", 36.4, 39.2, -89.7, -81.9),
    ("LA", "22", "Louisiana", 28.8, 33.1, -94.1, -88.7),
    ("ME", "23", "Maine", 42.9, 47.5, -71.2, -66.8),
    ("MD", "24", "Maryland", 37.8, 39.8, -79.6, -75.0),
    ("MA", "25", "Massachusetts", 41.1, 42.9, -73.6, -69.8),
    ("MI", "26", "Michigan", 41.6, 48.4, -90.5, -82.1),
    ("MN", "27", "Minnesota", 43.4, 49.4, -97.3, -89.4),
    ("MS", "28", "Mississippi", 30.0, 35.1, -91.8, -88.0),
    ("MO", "29", "Missouri", 35.9, 40.7, -95.9, -89.0),
    ("MT", "30", "Montana", 44.2, 49.1, -116.2, -104.0),
    ("NE", "31", "Nebraska", 39.9, 43.1, -104.1, -95.2),
    ("NV", "32", "Nevada", 35.0, 42.1, -120.1, -114.0),
    ("NH", "33", "New Hampshire", 42.6, 45.4, -72.6, -70.6),
    ("NJ", "34", "New Jersey", 38.8, 41.4, -75.7, -73.8),
    ("NM", "35", "New Mexico", 31.2, 37.1, -109.2, -103.0),
    ("NY", "36", "New York", 40.4, 45.1, -79.9, -71.7),
    ("NC", "37", "North Carolina", 33.8, 36.7, -84.4, -75.3),
    ("ND", "38", "North Dakota", 45.8, 49.1, -104.2, -96.4),
    ("OH", "39", "Ohio", 38.3, 42.4, -84.9, -80.4),
    ("OK", "40", "Oklahoma", 33.5, 37.1, -103.1, -94.3),
    ("OR", "41", "Oregon", 41.9, 46.4, -124.7, -116.4),
    ("PA", "42", "Pennsylvania", 39.6, 42.3, -80.7, -74.6),
    ("RI", "44", "Rhode Island", 41.1, 42.1, -71.9, -71.0),
    ("SC", "45", "South Carolina", 32.0, 35.3, -83.4, -78.4),
    ("SD", "46", "South Dakota", 42.4, 45.9, -104.2, -96.3),
    ("TN", "47", "Tennessee", 34.9, 36.8, -90.4, -81.6),
    ("TX", "48", "Texas", 25.6, 36.6, -106.8, -93.4),
    ("UT", "49", "Utah", 36.9, 42.1, -114.2, -108.9),
    ("VT", "50", "Vermont", 42.6, 45.1, -73.5, -71.4),
    ("VA", "51", "Virginia", 36.5, 39.6, -83.8, -75.1),
    ("WA", "53", "Washington", 45.4, 49.1, -124.9, -116.8),
    ("WV", "54", "West Virginia", 37.1, 40.7, -82.8, -77.6),
    ("WI", "55", "Wisconsin", 42.4, 47.2, -92.9, -86.7),
    ("WY", "56", "Wyoming", 40.9, 45.1, -111.2, -104.0),
    ("PR", "72", "Puerto Rico", 17.8, 18.6, -67.4, -65.1),
]

# Territories known by name and county prefix only: code, FIPS, name.
TERRITORIES = [
    ("AS", "60", "American Samoa"),
    ("GU", "66", "Guam"),
    ("MP", "69", "Northern Mariana Islands"),
    ("VI", "78", "U.S. Virgin Islands"),
]
