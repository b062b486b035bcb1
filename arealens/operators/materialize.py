"""Cut lineage through tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from arealens.session import checkpoint_dir


#: Rows that reach Python at once where they hold whole texts.
TEXT_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where a result is read several times: it is then computed once, survives lost
    executors, and the planner knows its real size. Tables of one application share a
    folder that can be removed when the application has ended. ``batch_rows``: the rows that
    a batch sent to Python may have meanwhile, if the session allows more.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark)}/arealens/{app}/{name}-{uuid.uuid4().hex}"
    before = int(spark.conf.get(_BATCH_ROWS))
    fewer = batch_rows is not None and not 0 < before <= batch_rows
    if fewer:
        spark.conf.set(_BATCH_ROWS, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        if fewer:
            spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)
