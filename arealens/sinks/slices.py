"""Tables of replaceable slices whose every state is complete.

Rows of one key value (a source, a year) form a slice. A write puts new slices into a folder of its own, and only
then commits the list of folders that now make up the table as the next numbered file in ``_table``. Readers
follow the highest number. Nothing is deleted before, or by, a commit: a job that fails at any moment leaves the
table as it was, a reader keeps the state it opened, and of two writers that start from the same state one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STATES = "_table"


def _folder(spark: SparkSession, path: str):
    """(file system, path constructor) of the table."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, make = _folder(spark, f"{path}/{STATES}")
    found = fs.globStatus(make(f"{path}/{STATES}/*.json")) or []
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)


def _state(spark: SparkSession, path: str, number: int | None = None) -> tuple[int, dict]:
    """Number and content of the committed state: slices by key text, each with its folders, and the schema."""
    numbers = _numbers(spark, path)
    if not numbers:
        return 0, {"schema": None, "slices": {}}
    number = number or numbers[-1]
    fs, make = _folder(spark, path)
    stream = fs.open(make(f"{path}/{STATES}/{number:010d}.json"))
    try:
        return number, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """Publish ``state`` as the successor of state ``number``; a rename, which fails if another writer was first."""
    fs, make = _folder(spark, path)
    draft, final = make(f"{path}/{STATES}/.{uuid.uuid4().hex}"), make(f"{path}/{STATES}/{number + 1:010d}.json")
    out = fs.create(draft, False)
    out.write(json.dumps(state).encode())
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another writer has changed {path}; read it again and repeat the write")


def _slice_keys(spark: SparkSession, values: list[tuple]) -> list[str]:
    """Key values as the text that names a slice."""
    return [json.dumps([None if v is None else str(v) for v in value]) for value in values]


def _write(df: DataFrame, path: str, keys: list[str]) -> tuple[dict[str, str], list]:
    """New slices of ``df`` below a folder of their own: slice name -> folder. Hot slices are written by many tasks."""
    spark = df.sparkSession
    version = f"data/{uuid.uuid4().hex}"
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) // 8)
    shown = F.to_json(F.array(*[F.col(f"`{k}`").cast("string") for k in keys])) if keys else F.lit("[]")
    others = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    salt = F.pmod(F.xxhash64(*others), F.lit(parts)) if others else F.lit(0)
    named = df.withColumn("_slice", shown).withColumn("_slice_folder", F.md5("_slice"))
    named.repartition("_slice_folder", salt).write.partitionBy("_slice_folder").parquet(f"{path}/{version}")
    written = spark.read.schema("_slice string, _slice_folder string").parquet(f"{path}/{version}")
    found = written.groupBy("_slice_folder").agg(F.first("_slice").alias("s")).collect()  # a row for each slice
    return {json.dumps(json.loads(r["s"])): f"{version}/_slice_folder={r['_slice_folder']}" for r in found}


def replace_slices(df: DataFrame, path: str, keys: list[str], values: list[tuple] | None = None) -> int:
    """Replace the slices whose key values occur in ``df``, keep all others; the number of the new state.

    ``values`` names key values (one tuple per slice) to replace too: those without rows in ``df`` become
    empty. The table takes the columns of ``df``; older slices lack new ones and read as NULL there.
    """
    spark = df.sparkSession
    number, state = _state(spark, path)
    slices = dict(state["slices"])
    written = _write(df, path, keys)
    for name in _slice_keys(spark, values or []):
        slices.pop(name, None)
    slices |= {name: [folder] for name, folder in written.items()}
    _commit(spark, path, number, {"schema": _merged(state["schema"], df.schema), "slices": slices})
    return number + 1


def append_slices(df: DataFrame, path: str, keys: list[str]) -> int:
    """Add rows by column name, whatever the order: missing columns become NULL, unknown ones are dropped once the table has columns."""
    spark = df.sparkSession
    number, state = _state(spark, path)
    if state["schema"]:
        df = df.select(*[c for c in StructType.fromJson(state["schema"]).names if c in df.columns])
    slices = {name: list(folders) for name, folders in state["slices"].items()}
    for name, folder in _write(df, path, keys).items():
        slices.setdefault(name, []).append(folder)
    _commit(spark, path, number, {"schema": state["schema"] or df.schema.jsonValue(), "slices": slices})
    return number + 1


def _merged(schema: dict | None, new: StructType) -> dict:
    names = set(new.names)
    kept = [f for f in StructType.fromJson(schema).fields if f.name not in names] if schema else []
    return StructType([*new.fields, *kept]).jsonValue()


def read_slices(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as last committed, or in state ``number``. Raises FileNotFoundError before the first commit."""
    found, state = _state(spark, path, number)
    if not found:
        raise FileNotFoundError(f"no committed table at {path}")
    schema = StructType.fromJson(state["schema"])
    folders = [f"{path}/{f}" for folders in state["slices"].values() for f in folders]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)
