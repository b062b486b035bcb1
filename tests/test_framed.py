"""Documents read in small blocks against whole parsers."""

import csv
import io
import json
import random

import pytest

from arealens.sources.framed import feature_records, json_records, quoted_rows
from arealens.sources.readers import read_features, read_tabular


@pytest.fixture()
def small_blocks(spark):
    """Splits of about so many bytes, so that one small file is read by many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def values(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 5)
    if kind == 5:
        return [values(rng, depth + 1) for _ in range(rng.randrange(3))]
    if kind == 6:
        return {rng.choice(["a", "b", "features", 'q"}{['] ): values(rng, depth + 1) for _ in range(rng.randrange(3))}
    return [rng.randrange(100), None, True, "".join(rng.choice('{}[]",\\ \n\té漢u') for _ in range(rng.randrange(12))), 1.5][kind]


@pytest.mark.parametrize("indent", [None, 2])
def test_objects_of_an_array(spark, tmp_path, small_blocks, indent):
    rng = random.Random(1)
    want = [{"id": i, "v": values(rng)} for i in range(150)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(want, indent=indent, ensure_ascii=False))
    (tmp_path / "one.json").write_text(json.dumps({"data": want[:5]}, indent=indent))
    (tmp_path / "none.json").write_text("[]")
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 20
    got = [json.loads(r.record) for r in json_records(spark, str(path)).collect()]
    assert sorted(got, key=lambda o: o["id"]) == want
    assert [json.loads(r.record) for r in json_records(spark, str(tmp_path / "one.json")).collect()] == [{"data": want[:5]}]
    assert json_records(spark, str(tmp_path / "none.json")).collect() == []
    assert read_tabular(spark, str(path)).selectExpr("count(*) n", "sum(id) s").first() == (150, sum(range(150)))


def collection(rng, n, header):
    features = [
        {"type": "Feature", "properties": {"id": str(i), "t": rng.choice(['"}', "a{", "x", "é[", "\\"])}, "geometry": {"type": "Point", "coordinates": [i, -i]} if i % 3 else None}
        for i in range(n)
    ]
    return {**header, "features": features, "note": {"by": [{"k": 1}]}}


@pytest.mark.parametrize("header", [
    {"type": "FeatureCollection"},
    {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:4326"}}, "links": [{"a": {"b": 1}}, {"c": '"features":[{'}]},
    {"bbox": [1, 2, 3, 4]},
])
def test_features_of_a_collection(spark, tmp_path, small_blocks, header):
    rng = random.Random(3)
    path = tmp_path / "c.geojson"
    whole = collection(rng, 60, header)
    path.write_text(json.dumps(whole, indent=1))
    got = read_features(spark, str(path)).selectExpr("properties['id'] AS id", "properties['t'] AS t", "geometry.coordinates AS c").collect()
    assert sorted((int(r.id), r.t, r.c is not None) for r in got) == [(i, f["properties"]["t"], f["geometry"] is not None) for i, f in enumerate(whole["features"])]
    assert feature_records(spark, str(path)).count() >= 60


def test_polygons_keep_their_geometry(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    feature = {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    row = read_tabular(spark, str(tmp_path / "p.geojson")).first()
    assert (row.geometry_wkt, row.longitude) == ("POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0))", None)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_rows(spark, tmp_path, small_blocks, end):
    rng = random.Random(7)
    want = [(str(i), "".join(rng.choice('ab,"\n\r é') for _ in range(rng.randrange(1, 30))) + "x", rng.choice(["", "tail"])) for i in range(200)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerows([("id", "text", "end"), *want])
    path = tmp_path / "q.csv"
    path.write_bytes(out.getvalue().encode())
    (tmp_path / "r.csv").write_bytes("id,text,ID\n1,\"open\nend".encode())
    assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 20
    got = sorted(map(tuple, quoted_rows(spark, str(path)).collect()), key=lambda r: int(r[0]))
    assert got == [(a, b, c or None) for a, b, c in want]
    broken = quoted_rows(spark, str(tmp_path / "r.csv"))
    assert broken.columns == ["id0", "text", "ID2"] and broken.count() == 1


def test_rows_of_another_width(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes("a;b\n1;\"größe\nzwei\"\n\n2\n3;x;y\n".encode("latin-1"))
    path = str(tmp_path / "w.csv")
    assert sorted(map(tuple, quoted_rows(spark, path, ";", "latin1").collect()), key=str) == [("1", "größe\nzwei"), ("2", None), ("3", "x")]
    assert list(map(tuple, quoted_rows(spark, path, ";", "latin1", skip_bad_lines=True).collect())) == [("1", "größe\nzwei")]
    (tmp_path / "e.csv").write_text("")
    assert quoted_rows(spark, str(tmp_path / "e.csv")).columns == []
