"""Replace, append and failed writes of tables with committed states."""

import pytest
from pyspark.sql import functions as F

from arealens.sinks import slices
from arealens.sinks.slices import append_slices, read_slices, replace_slices


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_slices_are_replaced_emptied_and_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b/c=1", 2, "z"), (None, 3, "n"), ("", 3, "e")], "k string, year int, v string")
    replace_slices(first, path, ["k", "year"])
    assert rows(read_slices(spark, path)) == rows(first)
    new = spark.createDataFrame([("a", 1, "w"), (None, 3, "m")], "k string, year int, v string")
    replace_slices(new, path, ["k", "year"], [("b/c=1", 2), ("never", 9)])
    assert rows(read_slices(spark, path)) == [("", 3, "e"), ("a", 1, "w"), (None, 3, "m")]
    assert rows(read_slices(spark, path, 1)) == rows(first)
    replace_slices(new.limit(0), path, ["k", "year"], [("a", 1), ("", 3), (None, 3)])
    assert rows(read_slices(spark, path)) == [] and read_slices(spark, path).columns == ["k", "year", "v"]


def test_a_failed_write_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    replace_slices(first, path, ["k"])
    broken = first.withColumn("v", F.raise_error(F.lit("no value")).cast("int"))
    with pytest.raises(Exception, match="no value"):
        replace_slices(broken, path, ["k"], [("a",), ("b",)])
    assert rows(read_slices(spark, path)) == [("a", 1), ("b", 2)]

    def interrupted(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(slices, "_commit", interrupted)
    with pytest.raises(KeyboardInterrupt):  # new files are written, the state is not
        replace_slices(first.withColumn("v", F.lit(9)), path, ["k"])
    assert rows(read_slices(spark, path)) == [("a", 1), ("b", 2)]


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1)], "k string, v int")
    replace_slices(first, path, ["k"])
    commit = slices._commit

    def late(spark_, path_, number, state):
        monkeypatch.setattr(slices, "_commit", commit)
        replace_slices(first.withColumn("v", F.lit(2)), path, ["k"])  # another writer comes first
        commit(spark_, path_, number, state)

    monkeypatch.setattr(slices, "_commit", late)
    with pytest.raises(RuntimeError, match="another writer"):
        replace_slices(first.withColumn("v", F.lit(3)), path, ["k"])
    assert rows(read_slices(spark, path)) == [("a", 2)]


def test_appended_rows_are_aligned(spark, tmp_path):
    path = str(tmp_path / "t")
    append_slices(spark.createDataFrame([("a", 1)], "k string, v int"), path, ["k"])
    append_slices(spark.createDataFrame([(7, "b", 2), (8, "a", None)], "extra int, k string, v int"), path, ["k"])
    append_slices(spark.createDataFrame([("c",)], "k string"), path, ["k"])
    assert rows(read_slices(spark, path)) == sorted([("a", 1), ("a", None), ("b", 2), ("c", None)], key=str)
    replace_slices(spark.createDataFrame([("a", 5)], "k string, w int"), path, ["k"])
    assert sorted(map(str, read_slices(spark, path).select("k", "v", "w").collect())) == sorted(
        ["Row(k='a', v=None, w=5)", "Row(k='b', v=2, w=None)", "Row(k='c', v=None, w=None)"]
    )


def test_a_table_is_missing_before_the_first_commit(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_slices(spark, str(tmp_path / "none"))
