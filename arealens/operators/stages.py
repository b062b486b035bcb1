"""A run over several stages that can be taken up again.

Each stage's table is stored under a fingerprint of everything it depends on: the content of the inputs it is made from,
directly or through other stages, and the parameters of the stages on the way. A stage whose table is complete under
its fingerprint is read instead of built, so a run that failed goes on where it stopped, and a run on
unchanged inputs builds nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from arealens.sources.lineage import content_fingerprint, row_digest


class Stage(NamedTuple):
    """``build`` gets the tables named by ``reads``, in order, and ``params`` by name; change a parameter, such as a version, with the code."""

    name: str
    build: Callable[..., DataFrame]
    reads: tuple[str, ...]
    params: dict = {}


class Run(NamedTuple):
    """All tables by name, and for each stage its fingerprint and whether its table was there already."""

    tables: dict[str, DataFrame]
    prints: dict[str, str]
    reused: dict[str, bool]


def input_fingerprint(df: DataFrame) -> str:
    """The content of a table, whatever the order of its rows or the split of its files."""
    columns = json.dumps(sorted(df.dtypes))
    found = df.agg(content_fingerprint(row_digest(df)).alias("print")).first()["print"]
    return hashlib.sha256(f"{columns}|{found}".encode()).hexdigest()


def _complete(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def run_stages(folder: str, inputs: dict[str, DataFrame], stages: list[Stage]) -> Run:
    """Build the stages in order below ``folder``, which later runs share; a stage may read inputs and earlier stages."""
    spark = next(iter(inputs.values())).sparkSession
    tables, reused = dict(inputs), {}
    prints = {name: input_fingerprint(df) for name, df in inputs.items()}
    for stage in stages:
        if stage.name in tables:
            raise ValueError(f"two tables are named {stage.name}")
        key = json.dumps([stage.name, stage.params, [prints[r] for r in stage.reads]], sort_keys=True)
        prints[stage.name] = hashlib.sha256(key.encode()).hexdigest()
        path = f"{folder}/{stage.name}/{prints[stage.name]}"
        reused[stage.name] = _complete(spark, path)
        if not reused[stage.name]:
            # what a failed run left there is no table: it lacks the marker and is overwritten
            stage.build(*[tables[r] for r in stage.reads], **stage.params).write.mode("overwrite").parquet(path)
        tables[stage.name] = spark.read.parquet(path)
    return Run(tables, {s.name: prints[s.name] for s in stages}, reused)
