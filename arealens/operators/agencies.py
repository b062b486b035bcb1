"""Resolve agency, place and county names to counties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.functions.text import agency_key, agency_place_key, county_key, place_key
from arealens.operators.materialize import materialize
from arealens.operators.skew import hottest_keys, lookup_join

NAME_SEPARATORS = r"[,;/]| and "


def county_names(crosswalk: DataFrame) -> DataFrame:
    """(state_code, name_key) -> county; of equal keys the largest FIPS code is kept."""
    named = crosswalk.where(
        (F.coalesce("state_code", F.lit("")) != "")
        & (F.coalesce("county_name", F.lit("")) != "")
        & (F.coalesce("county_fips", F.lit("")) != "")
    )
    return (
        named.groupBy("state_code", county_key(F.col("county_name")).alias("name_key"))
        .agg(F.max(F.struct("county_fips", "county_name")).alias("_c"))
        .select("state_code", "name_key", "_c.county_fips", "_c.county_name")
    )


def resolve_county_lists(rows: DataFrame, names: DataFrame, key: str, counties: str = "counties", state: str = "state_code") -> DataFrame:
    """Free-text county lists to bar-joined sorted codes and names; ``key`` identifies a row."""
    parts = rows.select(key, F.col(state).alias("state_code"), F.explode(F.split(F.col(counties), NAME_SEPARATORS)).alias("_name"))
    keyed = parts.where(F.trim("_name") != "").select(key, "state_code", county_key(F.col("_name")).alias("name_key")).distinct()
    found = keyed.join(names, ["state_code", "name_key"])
    listed = F.sort_array(F.collect_set(F.struct("county_fips", "county_name")))
    per_row = found.groupBy(key).agg(listed.alias("_l")).select(
        key,
        F.array_join("_l.county_fips", "|").alias("county_fips"),
        F.array_join("_l.county_name", "|").alias("county_name"),
    )
    return rows.join(per_row, key, "left")


def primary_county(agencies: DataFrame, county_population: DataFrame, key: str) -> DataFrame:
    """One county per agency: its only one, else the most populous of its list (ties to the larger code)."""
    listed = agencies.where(F.coalesce("county_fips", F.lit("")) != "").select(
        key,
        F.col("county_fips").alias("_all"),
        F.filter(F.split("county_fips", r"\|"), lambda x: x != "").alias("_f"),
        F.filter(F.split(F.coalesce("county_name", F.lit("")), r"\|"), lambda x: x != "").alias("_n"),
    )
    each = listed.select(key, F.size("_f").alias("_k"), "_all", "_n", F.posexplode("_f").alias("_i", "_fips")).select(
        key, "_k", "_all", "_fips", F.coalesce(F.get("_n", F.col("_i")), F.lit("")).alias("_name")
    )
    people = county_population.groupBy(F.col("county_fips").alias("_fips")).agg(F.sum("population_total").alias("_pop"))
    ranked = each.join(people, "_fips", "left").where((F.col("_k") == 1) | (F.col("_pop") > 0))
    best = ranked.groupBy(key).agg(F.max(F.struct("_pop", "_fips", "_name", "_k", "_all")).alias("_b"))
    note = F.when(
        F.col("_b._k") > 1, F.concat(F.lit("multi_county_agency:"), F.col("_b._all"), F.lit(";primary_county_by_population"))
    )
    return best.select(
        key, F.col("_b._fips").alias("county_fips"), F.col("_b._name").alias("county_name"), note.alias("lookup_notes")
    )


def agency_name_keys(agencies: DataFrame, key: str, name: str = "agency_name", places_only: bool = False) -> DataFrame:
    """One row per agency and name key: the place key, and unless ``places_only`` the agency key.

    Agencies of different places share names; each name is read once.
    """
    keys = [agency_place_key(F.col("_name"))] + ([] if places_only else [agency_key(F.col("_name"))])
    named = agencies.where(F.col(name).isNotNull()).select(key, "state_code", F.col(name).alias("_name"))
    names = named.groupBy("_name").agg(F.count(F.lit(1)).alias("_rows"))
    names = materialize(names.select("_name", "_rows", F.array_distinct(F.array(*keys)).alias("_keys")), "agency_names")
    keyed = lookup_join(named, names.select("_name", "_keys"), ["_name"], hottest_keys(names, ["_name"], "_rows"))
    return keyed.select(key, "state_code", F.explode("_keys").alias("name_key")).where(F.col("name_key") != "")


def unambiguous_names(candidates: DataFrame) -> DataFrame:
    """Keep a (state, name) key only if all its candidates are in one county.

    ``match_count`` counts candidates, ``lookup_notes`` joins their distinct notes.
    Candidates are (state_code, name_key, county_fips, county_name, lookup_notes) rows;
    equal ones are counted before they are gathered.
    """
    distinct = candidates.groupBy("state_code", "name_key", "county_fips", "county_name", "lookup_notes").agg(
        F.count(F.lit(1)).alias("_k")
    )
    distinct = materialize(distinct, "candidates")
    county = distinct.groupBy("state_code", "name_key").agg(
        F.min("county_fips").alias("county_fips"),
        F.max("county_fips").alias("_other"),
        F.min("county_name").alias("county_name"),
        F.sum("_k").alias("match_count"),
    )
    single = county.where(F.col("county_fips") == F.col("_other")).drop("_other")
    # Notes are gathered only for the keys that stay.
    notes = F.nullif(F.array_join(F.sort_array(F.collect_set("lookup_notes")), ";"), F.lit(""))
    gathered = distinct.join(single.select("state_code", "name_key"), ["state_code", "name_key"], "left_semi")
    gathered = gathered.groupBy("state_code", "name_key").agg(notes.alias("lookup_notes"))
    return single.join(gathered, ["state_code", "name_key"], "left").select("state_code", "name_key", "county_fips", "county_name", "match_count", "lookup_notes")


def name_lookup(agencies: DataFrame, county_population: DataFrame, key: str, places_only: bool = False) -> DataFrame:
    """(state, name) -> county lookup from an agency directory."""
    chosen = primary_county(agencies, county_population, key)
    keyed = agency_name_keys(agencies, key, places_only=places_only).join(chosen, key)
    return unambiguous_names(keyed)


def resolve_rows(rows: DataFrame, counties: DataFrame, places: DataFrame, agencies: DataFrame) -> DataFrame:
    """Attach a county to table rows: by county name (table 10), place (table 8) or agency name.

    ``rows`` has table_number, state_code, agency_label and county_label. Labels come back in every
    table and year: each is read and resolved once, and its outcome goes back to its rows.
    """
    kind = F.when(F.col("table_number") == "10", "county").when(F.col("table_number") == "8", "city").otherwise("agency")
    label = F.when(F.col("table_number") == "10", F.col("county_label")).otherwise(F.col("agency_label"))
    named, same = rows.withColumns({"_kind": kind, "_label": label}), ["_kind", "state_code", "_label"]
    labels = named.groupBy(*same).agg(F.count(F.lit(1)).alias("_rows"))
    name_key = (
        F.when(F.col("_kind") == "county", county_key(F.col("_label")))
        .when(F.col("_kind") == "city", place_key(F.col("_label")))
        .otherwise(agency_key(F.col("_label")))
    )
    labels = materialize(labels.withColumn("_key", name_key), "labels")
    lookups = (
        counties.select(
            F.lit("county").alias("_kind"), "state_code", F.col("name_key").alias("_key"), "county_fips", "county_name",
            F.lit(1).cast("long").alias("match_count"), F.lit(None).cast("string").alias("lookup_notes"),
        )
        .unionByName(_kind(places, "city"))
        .unionByName(_kind(agencies, "agency"))
    )
    keys = ["_kind", "state_code", "_key"]
    hot = hottest_keys(labels.where(F.col("_key").isNotNull() & F.col("state_code").isNotNull()), keys)
    joined = lookup_join(labels, materialize(lookups, "names"), keys, hot)
    found = F.col("county_fips").isNotNull()
    stem = F.when(F.col("_kind") == "city", "agency_city_lookup").otherwise("agency_name_lookup")
    method = (
        F.when(found & (F.col("_kind") == "county"), "county_name")
        .when(found & F.col("lookup_notes").isNotNull(), F.concat(stem, F.lit("_primary_county")))
        .when(found & (F.col("match_count") == 1), stem)
        .when(found, F.concat(stem, F.lit("_ambiguous_same_county")))
        .when(F.col("_kind") == "county", "unmatched_county_name")
        .when(F.col("_kind") == "city", "unmatched_city")
        .otherwise("unmatched_agency_name")
    )
    written = F.when(F.col("_kind") == "county", F.coalesce("_label", F.lit("None"))).otherwise(F.col("_label"))
    note = F.when(found, F.col("lookup_notes")).otherwise(F.concat(F.col("_kind"), F.lit("_not_found:"), written))
    outcome = joined.select(
        *same, "_rows", "county_fips", "county_name", method.alias("mapping_method"), note.alias("mapping_notes")
    )
    outcome = materialize(outcome, "resolved")
    # a big city's police names a third of the rows: the most frequent labels are answered by a broadcast
    resolved = lookup_join(named, outcome.drop("_rows"), same, hottest_keys(outcome, same, "_rows"), null_safe=True)
    return resolved.select(*rows.columns, "county_fips", "county_name", "mapping_method", "mapping_notes")


def _kind(lookup: DataFrame, kind: str) -> DataFrame:
    return lookup.select(
        F.lit(kind).alias("_kind"), "state_code", F.col("name_key").alias("_key"), "county_fips", "county_name",
        "match_count", "lookup_notes",
    )
