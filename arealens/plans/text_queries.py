"""Scalar functions over documents, customers, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.constants import INDEX_MEAN
from arealens.functions import dates, geo, text
from arealens.functions.rates import logistic_score, round_half_up
from arealens.operators.assign import inside_state_bounds
from arealens.operators.classify import classify_distinct, classify_text
from arealens.operators.incidents import normalize_incidents
from arealens.plans.checks import PUNCT, cleaned, matched
from arealens.plans.registry import query, table

LABEL = "CASE lang WHEN 'de' THEN 'NULL' WHEN 'es' THEN '  two   words ' WHEN 'fr' THEN ' nan ' ELSE lang END"


@query("clean_text", f"""
SELECT doc_id, {cleaned('text')} AS cleaned, {cleaned(f'({LABEL})')} AS label FROM documents""")
def clean_text(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("cleaned"), text.clean_text(F.expr(LABEL)).alias("label")
    )


@query("match_text", f"SELECT doc_id, {matched('text')} AS matched FROM documents")
def match_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.match_text(F.col("text")).alias("matched"))


@query("key_extract", r"""
SELECT doc_id, nullif(regexp_extract(text, '([0-9]{5})', 1), '') AS area_key,
       CASE WHEN regexp_replace(source, '[^0-9]', '', 'g') <> ''
            THEN right('00000' || regexp_replace(source, '[^0-9]', '', 'g'), 5) END AS fips,
       CASE WHEN length(CAST(doc_id AS VARCHAR)) < 5 THEN lpad(CAST(doc_id AS VARCHAR), 5, '0')
            ELSE CAST(doc_id AS VARCHAR) END AS padded,
       CASE WHEN regexp_matches(upper(lang), '^[A-Z]{2}$') THEN upper(lang) ELSE '' END AS code
FROM documents""")
def key_extract(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        text.five_digit_key(F.col("text")).alias("area_key"),
        text.county_fips(F.col("source")).alias("fips"),
        text.pad_key(F.col("doc_id")).alias("padded"),
        text.state_code(F.col("lang")).alias("code"),
    )


CELL = """CASE c_mktsegment
  WHEN 'BUILDING' THEN concat(cast({div} AS {str}), ',', lpad(cast(c_custkey % 1000 AS {str}), 3, '0'))
  WHEN 'AUTOMOBILE' THEN 'nan' WHEN 'HOUSEHOLD' THEN '--'
  WHEN 'MACHINERY' THEN concat(cast(c_custkey AS {str}), '.75')
  ELSE concat(' Agency  ', cast(c_nationkey AS {str}), ' Unit12') END"""


@query("numeric_parse", f"""
WITH c AS (SELECT c_custkey, c_mktsegment AS seg, c_nationkey, {CELL.format(div='c_custkey // 1000', str='VARCHAR')} AS cell FROM customer)
SELECT c_custkey,
  CASE WHEN seg = 'MACHINERY' THEN c_custkey + 0.75::DOUBLE END AS number,
  CASE WHEN seg = 'MACHINERY' THEN c_custkey WHEN seg = 'BUILDING' THEN c_custkey END AS whole,
  CASE WHEN seg = 'MACHINERY' THEN CAST(c_custkey + 1 AS BIGINT) ELSE 1 END AS weight,
  CASE WHEN seg = 'AUTOMOBILE' THEN NULL WHEN seg = 'HOUSEHOLD' THEN '--'
       WHEN seg = 'BUILDING' THEN regexp_replace(cell, ',[0-9]+$', ',') WHEN seg = 'MACHINERY' THEN regexp_replace(cell, '75$', '')
       ELSE 'Agency ' || CAST(c_nationkey AS VARCHAR) || ' Unit' END AS stripped
FROM c""")
def numeric_parse(spark, folder):
    cell = F.expr(CELL.format(div="c_custkey div 1000", str="string"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        text.to_double(cell).alias("number"),
        text.to_whole(cell).alias("whole"),
        text.to_count(cell).alias("weight"),
        text.drop_footnote(cell).alias("stripped"),
    )




@query("parse_dates", """
WITH e AS (SELECT event_id, event_type, date_trunc('second', ts) AS s, date_trunc('minute', ts) AS m, date_trunc('day', ts) AS d FROM events)
SELECT event_id, strftime(CASE event_type
    WHEN 'view' THEN s WHEN 'click' THEN d WHEN 'error' THEN s WHEN 'signup' THEN m ELSE NULL END, '%Y-%m-%d %H:%M:%S') AS occurred,
  CASE WHEN event_type <> 'purchase' THEN CAST(year(d) AS INTEGER) END AS occurred_year,
  CASE WHEN event_type <> 'purchase' THEN CAST(month(d) AS INTEGER) END AS occurred_month
FROM e""")
def parse_dates(spark, folder):
    events = table(spark, folder, "events").selectExpr(
        "event_id",
        """CASE event_type WHEN 'view' THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
             WHEN 'click' THEN date_format(ts, 'M/d/yyyy')
             WHEN 'error' THEN cast(unix_seconds(cast(ts AS timestamp)) * 1000 AS string)
             WHEN 'signup' THEN date_format(ts, "yyyy-MM-dd'T'00:00:00.000")
             ELSE date_format(ts, "yyyy-MM-dd'T'00:00:00") END AS day""",
        """CASE event_type WHEN 'signup' THEN cast(cast(date_format(ts, 'HHmm') AS int) AS string)
             WHEN 'purchase' THEN '2575' WHEN 'view' THEN 'nan' END AS clock""",
    )
    parsed = events.withColumn("at", dates.parse_occurred_at(F.col("day"), F.col("clock")))
    parts = dates.date_parts(F.col("at"))
    return parsed.select(
        "event_id",
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("occurred"),
        parts["occurred_year"].alias("occurred_year"),
        parts["occurred_month"].alias("occurred_month"),
    )


@query("epoch_zone", """
SELECT event_id,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS utc_time,
  strftime(date_trunc('second', ts) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d %H:%M:%S') AS local_time
FROM events""")
def epoch_zone(spark, folder):
    events = table(spark, folder, "events").selectExpr(
        "event_id", "unix_seconds(cast(ts AS timestamp)) * 1000 AS millis"
    )
    fmt = "yyyy-MM-dd HH:mm:ss"
    return events.select(
        "event_id",
        F.date_format(dates.parse_occurred_at(F.col("millis")), fmt).alias("utc_time"),
        F.date_format(dates.parse_occurred_at(F.col("millis"), timezone="America/New_York"), fmt).alias("local_time"),
    )


@query("year_day", """
SELECT o_orderkey,
  strftime(CASE o_orderstatus WHEN 'O' THEN date_trunc('day', o_orderdate) + INTERVAL 20 HOUR
                              ELSE date_trunc('day', o_orderdate) END, '%Y-%m-%d %H:%M:%S') AS occurred
FROM orders""")
def year_day(spark, folder):
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "cast(year(o_orderdate) AS string) AS y", "concat(dayofyear(o_orderdate), '.0') AS d",
        "CASE o_orderstatus WHEN 'O' THEN '20:00' WHEN 'F' THEN 'soon' END AS t",
    )
    at = dates.parse_year_day(F.col("y"), F.col("d"), F.col("t"))
    return orders.select("o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("occurred"))


@query("point_text", """
WITH e AS (SELECT event_id, event_type, CAST(CAST(user_id - 75 AS DECIMAL(10,2)) AS VARCHAR) AS lon,
                  CAST(CAST(value % 9 AS DECIMAL(10,2)) AS VARCHAR) AS lat FROM events)
SELECT event_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(lat AS DOUBLE) END AS lat,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(lon AS DOUBLE) END AS lon,
  event_type <> 'error' AND NOT (CAST(lat AS DOUBLE) = 0 AND CAST(lon AS DOUBLE) = 0) AS has_wkt
FROM e""")
def point_text(spark, folder):
    events = table(spark, folder, "events").selectExpr(
        "event_id",
        """CASE event_type
             WHEN 'view' THEN concat('POINT (', cast(user_id - 75 AS decimal(10,2)), ' ', cast(value % 9 AS decimal(10,2)), ')')
             WHEN 'click' THEN concat('point(', cast(user_id - 75 AS decimal(10,2)), '  ', cast(value % 9 AS decimal(10,2)), ' )')
             WHEN 'error' THEN 'POINT EMPTY'
             ELSE concat('(', cast(value % 9 AS decimal(10,2)), ', ', cast(user_id - 75 AS decimal(10,2)), ')') END AS point""",
        "CASE WHEN event_type = 'signup' THEN cast(cast(value % 9 AS decimal(10,2)) AS string) END AS lat_text",
    )
    lat, lon = geo.resolve_coordinates(F.col("lat_text"), F.lit(None).cast("string"), F.col("point"))
    located = events.select("event_id", lat.alias("lat"), lon.alias("lon"))
    return located.withColumn("has_wkt", geo.point_wkt(F.col("lat"), F.col("lon")).isNotNull())


@query("coord_and_region_mask", """
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'CA' WHEN 'click' THEN 'tx' WHEN 'error' THEN 'ZZ' WHEN 'purchase' THEN 'NY' END AS st,
                  CASE WHEN user_id = 3 THEN 0 WHEN user_id = 4 THEN 95 ELSE 25 + value % 20 END AS lat,
                  CASE WHEN user_id = 3 THEN 0 WHEN user_id <> 5 THEN -130 + user_id % 60 END AS lon FROM events)
SELECT event_id, coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0), false) AS is_valid,
  coalesce(CASE upper(st) WHEN 'CA' THEN lat BETWEEN 32.4 AND 42.1 AND lon BETWEEN -124.6 AND -114.0
             WHEN 'TX' THEN lat BETWEEN 25.6 AND 36.6 AND lon BETWEEN -106.8 AND -93.4
             WHEN 'NY' THEN lat BETWEEN 40.4 AND 45.1 AND lon BETWEEN -79.9 AND -71.7 ELSE true END, false) AS in_state
FROM e""")
def coord_and_region_mask(spark, folder):
    events = table(spark, folder, "events").selectExpr(
        "event_id",
        "CASE event_type WHEN 'view' THEN 'CA' WHEN 'click' THEN 'tx' WHEN 'error' THEN 'ZZ' WHEN 'purchase' THEN 'NY' END AS st",
        "CASE WHEN user_id = 3 THEN 0D WHEN user_id = 4 THEN 95D ELSE 25D + value % 20D END AS lat",
        "CASE WHEN user_id = 3 THEN 0D WHEN user_id <> 5 THEN -130D + user_id % 60 END AS lon",
    )
    flagged = inside_state_bounds(events, "st", "lat", "lon", "in_state")
    return flagged.select("event_id", geo.valid_coordinates(F.col("lat"), F.col("lon")).alias("is_valid"), "in_state")


# Words and phrases that occur in the documents.
DOC_RULES = {
    "property": {
        "articles": {"keywords": ["the", "and the", "der", "b&e"]},
        "joined": {"keywords": ["of the", "la"]},
    },
    "violent": {"link": {"keywords": ["que", "les", "in the"]}, "late": {"keywords": ["zu"]}},
    "weapons": {"digits": {"regexes": ["[0-9]{4} [0-9]{4}"]}},
    "other": {"rest": {"keywords": ["on", "un", "to-and"]}},
}


def _token(*words: str) -> str:
    return "list_has_any(string_split_regex(t, '[^\\p{L}\\p{N}_]+'), [" + ", ".join(f"'{w}'" for w in words) + "])"


CLASSIFIED = f"""
WITH d AS (SELECT doc_id, {matched('text')} AS t FROM documents),
c AS (SELECT doc_id, t, CASE
   WHEN t = '' THEN 'unknown/unknown'
   WHEN regexp_matches(t, '[0-9]{{4}} [0-9]{{4}}') THEN 'weapons/digits'
   WHEN contains(t, 'in the') THEN 'violent/link'
   WHEN contains(t, 'and the') OR contains(t, 'b e') THEN 'property/articles'
   WHEN contains(t, 'of the') THEN 'property/joined'
   WHEN contains(t, 'to and') THEN 'other/rest'
   WHEN {_token('que', 'les')} THEN 'violent/link'
   WHEN {_token('zu')} THEN 'violent/late'
   WHEN {_token('the', 'der')} THEN 'property/articles'
   WHEN {_token('la')} THEN 'property/joined'
   WHEN {_token('on', 'un')} THEN 'other/rest'
   ELSE 'unknown/unknown' END AS k FROM d)
SELECT doc_id, split_part(k, '/', 1) AS offense_group, split_part(k, '/', 2) AS offense_subgroup,
       CAST(coalesce(length(nullif(t, '')), 0) AS BIGINT) AS text_length FROM c"""


def _classified(df):
    return df.select(
        "doc_id", "offense_group", "offense_subgroup",
        F.coalesce(F.length("offense_normalized"), F.lit(0)).cast("long").alias("text_length"),
    )


@query("classify_text", CLASSIFIED)
def classify_direct(spark, folder):
    return _classified(classify_text(table(spark, folder, "documents").select("doc_id", "text"), "text", DOC_RULES))


@query("classify_distinct", CLASSIFIED)
def classify_memoised(spark, folder):
    return _classified(classify_distinct(table(spark, folder, "documents").select("doc_id", "text"), "text", DOC_RULES))


EVENT_RULES = {
    "violent": {"failure": {"keywords": ["error"]}},
    "property": {"sale": {"keywords": ["purchase", "big purchase"]}},
    "public_order": {"look": {"keywords": ["view"]}},
}


@query("normalized_quality_notes", """
WITH e AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'violent' WHEN 'purchase' THEN 'property' WHEN 'view' THEN 'public_order' ELSE 'unknown' END AS grp,
    user_id % 11 <> 0 AS dated, value BETWEEN 1 AND 90 AS located, user_id > 20 AS keyed FROM events),
n AS (SELECT *, list_filter([CASE WHEN NOT dated THEN 'missing_or_invalid_date' END, CASE WHEN grp = 'unknown' THEN 'unknown_offense' END,
    CASE WHEN NOT located THEN 'missing_or_invalid_coordinates' END, CASE WHEN NOT keyed THEN 'missing_or_invalid_zip' END], lambda x: x IS NOT NULL) AS notes FROM e)
SELECT CAST(event_id AS VARCHAR) AS incident_id, grp AS offense_group, grp = 'violent' AS is_violent, grp = 'property' AS is_property,
  (CAST(dated AS INT) + CAST(grp <> 'unknown' AS INT) + CAST(located AS INT) + CAST(keyed AS INT)) / 4.0::DOUBLE AS data_quality_score,
  CASE WHEN len(notes) > 0 THEN array_to_string(notes, '; ') END AS normalization_notes
FROM n""")
def normalized_quality_notes(spark, folder):
    staged = table(spark, folder, "events").selectExpr(
        "cast(event_id AS string) AS incident_id",
        "event_type AS offense_raw",
        "CASE WHEN user_id % 11 <> 0 THEN to_date(ts) END AS occurred_date",
        "CASE WHEN value BETWEEN 1 AND 90 THEN value WHEN value > 90 THEN value + 90 END AS latitude_raw",
        "cast(user_id AS double) - 180D AS longitude_raw",
        "CASE WHEN user_id > 20 THEN concat('Z-', lpad(user_id, 6, '0')) END AS zip_raw",
    )
    return normalize_incidents(staged, EVENT_RULES).select(
        "incident_id", "offense_group", "is_violent", "is_property", "data_quality_score", "normalization_notes"
    )


@query("score_rounding", """
SELECT event_id, round_even(100 / (1 + exp(-(value - 100) / 50)) * 10, 0) / 10 AS logistic,
  floor((value / 7 + 2.220446049250313e-16) * 10 + 0.5) / 10 AS half_up FROM events""")
def score_rounding(spark, folder):
    z = (F.col("value") - F.lit(INDEX_MEAN)) / F.lit(50.0)
    return table(spark, folder, "events").select(
        "event_id", logistic_score(z).alias("logistic"), round_half_up(F.col("value") / F.lit(7.0), 1).alias("half_up")
    )


@query("name_keys", f"""
WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4
    WHEN 0 THEN 'St. ' || s_name || ' County' WHEN 1 THEN s_name || ' City and Borough'
    WHEN 2 THEN s_name || ' Police Department' ELSE s_name || ' Township Village ' || CAST(s_nationkey AS VARCHAR) END AS raw FROM supplier),
m AS (SELECT s_suppkey, trim(regexp_replace(lower(raw), '{PUNCT}', ' ', 'g')) AS t FROM s)
SELECT s_suppkey,
  CASE s_suppkey % 4 WHEN 0 THEN regexp_replace(regexp_replace(t, '^st ', 'saint '), ' county$', '')
       WHEN 1 THEN regexp_replace(t, ' city and borough$', '') ELSE t END AS county_key,
  CASE s_suppkey % 4 WHEN 1 THEN regexp_replace(t, ' borough$', '') WHEN 3 THEN regexp_replace(t, ' [0-9]+$', '') ELSE t END AS place_key,
  CASE s_suppkey % 4 WHEN 2 THEN regexp_replace(t, ' police department$', '') ELSE t END AS agency_key
FROM m""")
def name_keys(spark, folder):
    raw = F.expr("""CASE s_suppkey % 4
        WHEN 0 THEN concat('St. ', s_name, ' County') WHEN 1 THEN concat(s_name, ' City and Borough')
        WHEN 2 THEN concat(s_name, ' Police Department') ELSE concat(s_name, ' Township Village ', s_nationkey) END""")
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        text.county_key(raw).alias("county_key"),
        text.place_key(raw).alias("place_key"),
        text.agency_key(raw).alias("agency_key"),
    )
