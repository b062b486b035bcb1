"""Readers, row filters, staging, row numbers and replace-by-source writes."""

import json

import pytest
from pyspark.sql import functions as F

from arealens.operators.incidents import apply_row_filters, number_copies, number_file_rows, stage_feed, stage_sources
from arealens.sinks.slices import read_slices
from arealens.sinks.writers import replace_sources
from arealens.session import checkpoint_dir
from arealens.sources.lineage import content_fingerprint, row_digest
from arealens.sources.readers import property_columns, read_tabular
from arealens.sources.tables import geometry_summary, read_crosswalk, read_geometries, read_population


def test_csv_is_text_and_bad_lines_are_skipped(spark, tmp_path):
    path = tmp_path / "meters.csv"
    path.write_text("station,reading,note\n0071,12.50,ok\n0072,9\n0073,1,b,extra,extra\n0074,NA,\"say \"\"hi\"\", twice\"\n")
    rows = read_tabular(spark, str(path), {"on_bad_lines": "skip"}).collect()
    assert [tuple(r) for r in rows] == [("0071", "12.50", "ok"), ("0074", None, 'say "hi", twice')]


def test_csv_line_ends_in_quotes_and_encodings(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_bytes("key,note\n1,\"größe\nzwei\"\n2,n/a\n".encode("latin-1"))
    rows = read_tabular(spark, str(path), {"multi_line": True, "encoding": "latin1"}).collect()
    assert [tuple(r) for r in rows] == [("1", "größe\nzwei"), ("2", None)]


def test_json_and_point_features(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "k": "x"}, {"id": 2}]')
    (tmp_path / "b.jsonl").write_text('{"id": 1}\n{"id": 2}\n{"id": 3}\n')
    feature = {"type": "Feature", "properties": {"id": "7"}, "geometry": {"type": "Point", "coordinates": [-1.5, 2.0]}}
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    assert read_tabular(spark, str(tmp_path / "a.json")).count() == 2
    assert read_tabular(spark, str(tmp_path / "b.jsonl")).count() == 3
    points = property_columns(read_tabular(spark, str(tmp_path / "c.geojson")), ["id"]).first()
    assert (points.id, points.longitude, points.latitude) == ("7", -1.5, 2.0)
    assert points.geometry_wkt == "POINT (-1.5 2.0)"


def test_row_filters(spark):
    df = spark.createDataFrame(
        [("a", "\tKeep ", "plain"), ("b", "drop", "plain"), ("c", "KEEP", "under Review"), ("d", None, "plain"), ("e", "keep", None)],
        "id string, state string, remark string",
    )
    rules = {
        "include": [{"column": "state", "values": ["keep"]}, {"column": "elsewhere", "values": ["1"]}],
        "exclude": [{"column": "remark", "regex": "review|void"}],
    }
    assert [r.id for r in apply_row_filters(df, rules).collect()] == ["a", "e"]


def test_staging_shapes(spark):
    df = spark.createDataFrame(
        [("q9", "2023", "60", "0705", None, "fallback", "3", "POINT (12.25 48.5)")],
        "ref string, yr string, dy string, tm string, main string, other string, n string, place string",
    )
    config = {
        "incident_id_column": "ref", "year_column": "yr", "day_of_year_column": "dy", "time_column": "tm", "offense_column": "main",
        "offense_fallback_columns": ["other"], "count_column": "n", "geocoded_point_column": "place", "zip_column": "absent",
    }
    row = stage_feed(df, "src", config).first()
    assert (str(row.occurred_date), row.occurred_at.hour, row.occurred_at.minute) == ("2023-03-01", 7, 5)
    assert (row.latitude_raw, row.longitude_raw) == (48.5, 12.25)
    assert (row.offense_raw, row.incident_count, row.zip_raw) == ("fallback", 3, None)


def test_sources_are_replaced_and_emptied(spark, tmp_path):
    def feed(*keys):
        return spark.createDataFrame([(k, "2022-08-0" + k, "noise") for k in keys], "ref string, day string, kind string")

    config = {"incident_id_column": "ref", "date_column": "day", "offense_column": "kind"}
    configs = {name: config for name in ("north", "south", "west")}
    path = str(tmp_path / "staged")
    replace_sources(stage_sources({"north": feed("1"), "south": feed("1", "2"), "west": feed("4")}, configs), path)
    again = stage_sources({"north": feed("1"), "south": feed("3", "5", "6")}, configs, only=["south"])
    replace_sources(again, path, ["south", "west"])
    counts = {r.source_name: r["count"] for r in read_slices(spark, path).groupBy("source_name").count().collect()}
    assert counts == {"north": 1, "south": 3}


def test_file_row_numbers_after_a_filter(spark, tmp_path):
    path = str(tmp_path / "rows.parquet")
    spark.range(1000).coalesce(2).write.parquet(path)
    df = spark.read.parquet(path).select("id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).where("id % 3 = 0")
    numbered = number_file_rows(df, "f", "i", block=37).collect()
    for name in {r.f for r in numbered}:
        rows = sorted((r for r in numbered if r.f == name), key=lambda r: r.i)
        assert [r._source_row for r in rows] == list(range(1, len(rows) + 1))


def test_copies_are_numbered_in_chunks(spark):
    df = spark.range(25).select(F.when(F.col("id") < 20, "hot").otherwise("cold").alias("k"))
    rows = number_copies(df, "n", chunk=6).collect()
    assert sorted(r.n for r in rows if r.k == "hot") == list(range(1, 21))
    assert sorted(r.n for r in rows if r.k == "cold") == list(range(1, 6))


def test_crosswalk_files(spark, tmp_path):
    path = tmp_path / "bar.txt"
    path.write_bytes("﻿GEOID_ZCTA5_20|GEOID_COUNTY_20|NAMELSAD_COUNTY_20|AREALAND_PART|AREAWATER_PART\n03301|33013|Alder County|900|0\n03301|33015|Birch County|100|0\n".encode())
    got = {r.county_fips: (round(r.allocation_weight, 3), r.state_code) for r in read_crosswalk(spark, str(path)).collect()}
    assert got == {"33013": (0.9, "NH"), "33015": (0.1, "NH")}
    named = tmp_path / "named.csv"
    named.write_text("ZIP Code,County Name,State Code,State Name,County FIPS\n03301,Alder County,NH,New Hampshire,33013\n05401,A County,VT,Vermont,50007\n05401,B County,VT,Vermont,50011\n")
    rows = read_crosswalk(spark, str(named)).collect()
    assert sorted((r.zcta, r.allocation_weight) for r in rows) == [("03301", 1.0), ("05401", 0.5), ("05401", 0.5)]


def test_population_file(spark, tmp_path):
    path = tmp_path / "pop.csv"
    path.write_text("GEO_ID,NAME,B01003_001E,B01003_001M\n860Z200US73001,ZCTA5 73001,100,5\n860Z200US73002,ZCTA5 73002,n/a,\nbad,bad,1,1\n")
    rows = {r.zcta: r.population_total for r in read_population(spark, str(path), 2024).collect()}
    assert rows == {"73001": 100, "73002": None}


def test_area_geometries(spark, tmp_path):
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"GEOID": "73001", "STATEFP": "06", "ALAND": 5}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"GEOID": "73002"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"GEOID": "x"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"GEOID": "73003"}, "geometry": None},
    ]
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    table = read_geometries(spark, str(path), 2020)
    rows = {r.zcta: r for r in table.collect()}
    assert set(rows) == {"73001", "73002"}
    assert (rows["73001"].centroid_lat, rows["73001"].centroid_lon, rows["73001"].state_fips, rows["73001"].land_area) == (1.0, 1.0, "06", 5.0)
    assert rows["73002"].geom_wkt.startswith("MULTIPOLYGON (((")
    assert geometry_summary(table, "zcta").first().invalid_geometry_count == 0


def test_fingerprint_counts_repeated_rows(spark):
    def mark(rows):
        df = spark.createDataFrame(rows, "a int, b string")
        return df.agg(content_fingerprint(row_digest(df)).alias("f")).first().f

    assert mark([(1, "a"), (1, "a")]) != mark([(2, "b"), (2, "b")])
    assert mark([(1, "a|b")]) != mark([(1, "a")]) and mark([(1, "x"), (2, "y")]) == mark([(2, "y"), (1, "x")])


def test_a_machine_local_folder_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {}
        _jsc = type("J", (), {"hadoopConfiguration": lambda self: {"fs.defaultFS": "file:///"}})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
