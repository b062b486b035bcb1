"""Common SQL text of the checks, written against the raw tables."""

from __future__ import annotations

INC = """inc AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS incident_id,
         'line_' || l_returnflag AS source_name,
         CAST(l_partkey AS VARCHAR) AS zcta,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'F' THEN 'violent' ELSE 'property' END
              WHEN l_returnflag = 'N' THEN CASE WHEN l_linestatus = 'F' THEN 'drug' ELSE 'public_order' END
              WHEN l_linestatus = 'F' THEN 'weapons'
              WHEN l_discount >= 0.05 THEN 'other' ELSE 'unknown' END AS cat,
         CAST(l_quantity AS BIGINT) AS n
  FROM lineitem)"""

POP = """pop AS (
  SELECT CAST(p_partkey AS VARCHAR) AS zcta, CAST(y AS INTEGER) AS year,
         CAST(CASE WHEN p_size = 50 THEN 0 WHEN p_size = 49 THEN NULL ELSE p_size * 100 END AS BIGINT) AS population_total
  FROM part, (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem) t)"""

CATS = ["violent", "property", "drug", "public_order", "weapons", "other", "unknown"]
BASES = ["total", "violent", "property", "drug", "public_order", "weapons", "other"]


def counts(source: str = "inc") -> str:
    cells = ",\n         ".join(
        f"CAST(sum(CASE WHEN cat = '{c}' THEN n ELSE 0 END) AS BIGINT) AS {c}_incident_count" for c in CATS
    )
    return f"CAST(sum(n) AS BIGINT) AS total_incident_count,\n         {cells}"


COUNT_NAMES = ["total_incident_count"] + [f"{c}_incident_count" for c in CATS]
COUNTS = ", ".join(COUNT_NAMES)


def rates(digits: int | None = None) -> str:
    cells = []
    for b in ["total", *CATS]:
        value = f"CASE WHEN population_total > 0 THEN CAST({b}_incident_count AS DOUBLE) / population_total * 1000 END"
        cells.append(f"{f'round({value}, {digits})' if digits else value} AS {b}_rate_per_1000")
    return ", ".join(cells)


ANN = f"""cnt AS (SELECT zcta, year, {counts()} FROM inc GROUP BY zcta, year),
ann AS (SELECT c.*, p.population_total, {rates()} FROM cnt c LEFT JOIN pop p USING (zcta, year))"""

BASE = f"WITH {INC},\n{POP},\n{ANN}"


def score_name(b: str) -> str:
    return "total_incident_score_0_100" if b == "total" else f"{b}_score_0_100"


def percentile_name(b: str) -> str:
    return "total_incident_percentile" if b == "total" else f"{b}_percentile"


def label_name(b: str) -> str:
    return "total_incident_score_label" if b == "total" else f"{b}_score_label"


def clipped(group: str) -> str:
    """Winsorised rates w_<base> over ``ann``."""
    bounds = ", ".join(
        f"quantile_cont({b}_rate_per_1000, 0.01) OVER (PARTITION BY {group}) AS lo_{b}, "
        f"quantile_cont({b}_rate_per_1000, 0.99) OVER (PARTITION BY {group}) AS hi_{b}"
        for b in BASES
    )
    cells = ", ".join(
        f"CASE WHEN {b}_rate_per_1000 IS NOT NULL THEN greatest(least({b}_rate_per_1000, hi_{b}), lo_{b}) END AS w_{b}"
        for b in BASES
    )
    return f"bnd AS (SELECT *, {bounds} FROM ann),\nwin AS (SELECT *, {cells} FROM bnd)"


def percentile(column: str, group: str) -> str:
    """Average-rank percentile; NULL values neither rank nor count."""
    part = f"PARTITION BY {group}, {column} IS NULL"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL "
        f"WHEN max({column}) OVER (PARTITION BY {group}) = 0 AND min({column}) OVER (PARTITION BY {group}) = 0 THEN 0.0 "
        f"WHEN count({column}) OVER (PARTITION BY {group}) = 1 THEN 0.5 "
        f"ELSE (rank() OVER ({part} ORDER BY {column}) + (count(*) OVER (PARTITION BY {group}, {column}) - 1) / 2.0 - 1) "
        f"/ CAST(count({column}) OVER (PARTITION BY {group}) - 1 AS DOUBLE) END"
    )


def z_score(column: str, group: str) -> str:
    part = f"OVER (PARTITION BY {group})"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN max({column}) {part} = min({column}) {part} THEN 0.0 "
        f"ELSE ({column} - avg({column}) {part}) / stddev_pop({column}) {part} END"
    )


def scored(group: str = "year") -> str:
    """CTEs up to ``idx``: percentiles p_, scores, z-scores z_, overall score and label inputs."""
    p = ", ".join(f"{percentile(f'w_{b}', group)} AS p_{b}, {z_score(f'w_{b}', group)} AS z_{b}" for b in BASES)
    s = ", ".join(f"round_even(p_{b} * 100 * 10, 0) / 10 AS {score_name(b)}" for b in BASES)
    return f"""{clipped(group)},
rnk AS (SELECT *, {p} FROM win),
scr AS (SELECT *, {s} FROM rnk),
ovr AS (SELECT *, {OVERALL} AS overall_incident_score_0_100, {MISSING} AS score_notes FROM scr)"""


WEIGHTS = [("violent", 0.4), ("property", 0.3), ("drug", 0.05), ("public_order", 0.05), ("weapons", 0.15), ("other", 0.05)]
_sum = " + ".join(f"coalesce({c}_score_0_100 * {w}::DOUBLE, 0)" for c, w in WEIGHTS)
_avail = " + ".join(f"CASE WHEN {c}_score_0_100 IS NULL THEN 0::DOUBLE ELSE {w}::DOUBLE END" for c, w in WEIGHTS)
OVERALL = f"CASE WHEN ({_avail}) > 0 THEN round_even(({_sum}) / ({_avail}) * 10, 0) / 10 END"
_missing = "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {c}_score_0_100 IS NULL THEN '{c}' END" for c, _ in WEIGHTS
) + "], lambda x: x IS NOT NULL), ',')"
MISSING = (
    f"CASE WHEN ({_avail}) <= 0 THEN 'overall_score_unavailable_no_category_scores' "
    f"WHEN {_missing} <> '' THEN 'renormalized_missing_categories:' || {_missing} END"
)


def label(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 'unavailable' WHEN {column} < 20 THEN 'very_low' WHEN {column} < 40 THEN 'low' "
        f"WHEN {column} < 60 THEN 'average' WHEN {column} < 80 THEN 'high' ELSE 'very_high' END"
    )


LABELS = ", ".join(
    f"{label(score_name(b))} AS {label_name(b)}" for b in BASES
) + f", {label('overall_incident_score_0_100')} AS overall_incident_score_label"

# Unicode white space and the ASCII punctuation of the match form.
SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"
PUNCT = r"[!-/:-@\[-`{-~ ]+"


def squeezed(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def cleaned(x: str) -> str:
    return f"CASE WHEN lower({x}) IN ('nan', 'none', 'null') OR {squeezed(x)} = '' THEN NULL ELSE {squeezed(x)} END"


def matched(x: str) -> str:
    return f"coalesce(trim(regexp_replace(lower({cleaned(x)}), '{PUNCT}', ' ', 'g')), '')"


ASSIGN = """asg AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS incident_id,
         CASE WHEN l_tax >= 0.02 THEN CAST(l_partkey AS VARCHAR) END AS zcta,
         CASE WHEN l_tax < 0.02 THEN 'unassigned' WHEN l_tax < 0.06 THEN 'spatial_join' ELSE 'zip_fallback' END AS method
  FROM lineitem),
one AS (
  SELECT incident_id, zcta AS assigned_zcta, method FROM (
    SELECT *, row_number() OVER (PARTITION BY incident_id
      ORDER BY zcta IS NULL, method <> 'spatial_join', zcta, method) AS rn FROM asg)
  WHERE rn = 1)"""

# Supplier polygons in closed form: lattice corner, kind, state.
SHAPES = """shp AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS zcta, s_suppkey % 3 AS kind,
         CAST(s_suppkey % 9 - 123 AS DOUBLE) AS x, CAST((s_suppkey // 9) % 9 + 33 AS DOUBLE) AS y,
         CASE s_nationkey % 4 WHEN 1 THEN '32' WHEN 2 THEN NULL ELSE '06' END AS state_fips
  FROM supplier)"""

POINTS = """pts AS (
  SELECT CAST(event_id AS VARCHAR) AS incident_id,
         CASE event_type WHEN 'error' THEN 'NV' WHEN 'purchase' THEN 'ca' WHEN 'signup' THEN NULL ELSE 'CA' END AS st,
         CASE WHEN user_id = 7 THEN 0 WHEN value <= 200 THEN 33::DOUBLE + value % 9 END AS lat,
         CASE WHEN user_id = 7 THEN 0 ELSE -123::DOUBLE + (user_id % 90) / 10::DOUBLE END AS lon,
         CASE user_id % 5 WHEN 0 THEN lpad(CAST(user_id AS VARCHAR), 8, '0') WHEN 1 THEN '99999999' END AS zkey
  FROM events)"""

WITHIN = """lon > x AND lon < x + 1 AND lat > y AND lat < y + 1 AND (
    kind = 0
    OR (kind = 1 AND NOT (lon BETWEEN x + 0.25 AND x + 0.75 AND lat BETWEEN y + 0.25 AND y + 0.75))
    OR (kind = 2 AND lat - y < 0.777 * (lon - x)))"""


def digest_sql(fields: list[str]) -> str:
    """The fingerprint of all rows in SQL: digest words of length-prefixed fields, summed."""
    row = " || '|' || ".join(f"coalesce(CAST(length({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields)
    words = " || '|' || ".join(f"CAST(coalesce(sum(CAST('0x' || substr(sha256({row}), {1 + 15 * k}, 15) AS BIGINT)), 0) AS VARCHAR)" for k in range(4))
    return f"sha256(CAST(count(*) AS VARCHAR) || '|' || {words})"
