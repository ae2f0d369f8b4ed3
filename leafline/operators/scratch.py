"""Tables written between steps to a folder that all executors share, so that what was computed, or asked of a model, stays."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir; where that is unset, a temporary one for a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="leafline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/steps-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet and read again: its lineage ends there."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds the rows of an Arrow batch, since a row may hold a whole text: a worker's memory then doesn't grow with its split."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
