"""Live ingest: files of work messages become idempotent rows, at least once, with a checkpoint as acknowledgement."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.functions import text
from leafline.sources import queue

MESSAGE = "uri string, received_at timestamp"


def messages(spark: SparkSession, path: str) -> DataFrame:
    """A stream of message files; messages without an address are dropped (acknowledged)."""
    return spark.readStream.schema(MESSAGE).json(path).where(F.coalesce("uri", F.lit("")) != "")


def runs(stream: DataFrame) -> DataFrame:
    """A run for each message: document id from the file name, run id from the message."""
    name = F.regexp_replace(F.regexp_extract("uri", r"([^/]+)$", 1), r"\.[^.]+$", "")
    return stream.select(text.slug(name).alias("document_id"), F.sha2(F.concat_ws("|", "uri", "received_at"), 256).alias("run_id"), "uri")


def ingest(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Writes runs by batch; a batch that runs again overwrites its own folder, so redelivery adds nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    w = runs(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="20 seconds")).start()


def collected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(path).dropDuplicates(["run_id"])


def served(spark: SparkSession, path: str, out: str, checkpoint: str, start: Callable[[str], None] | None = None, most: int = queue.MOST, visibility: float = queue.VISIBILITY, poll_s: float | None = None):
    """A stream that starts a run for each message of a queue (sources.queue): rows (document_id, run_id, uri, message_id, receives).

    start(uri) is called for each message in a task; a message whose start raises gives no run and is received again when its
    lease ends, the others are deleted once their rows are written. A run id is made of the message and of how often it was received, so
    that equal messages have runs of their own and a batch that runs again writes the same rows. poll_s: seconds
    between polls; without it the stream takes what is visible, `most` messages at most, and ends.
    """
    spark.dataSource.register(queue.QueueSource)

    def begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            errors = []
            for uri in b["body"]:
                try:
                    if start:
                        start(uri)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the message is left in the queue
                    errors.append(f"{type(e).__name__}: {e}")
            yield b.assign(error=pd.Series(errors, index=b.index, dtype=object))

    def write(batch: DataFrame, number: int) -> None:
        name = F.regexp_replace(F.regexp_extract("body", r"([^/]+)$", 1), r"\.[^.]+$", "")
        rows = batch.mapInPandas(begun, f"{queue.SCHEMA}, error string")
        rows = rows.select(text.slug(name).alias("document_id"), F.sha2(F.concat_ws("|", "message_id", "receives"), 256).alias("run_id"), F.col("body").alias("uri"), "message_id", "receives", "error")
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")
        for r in spark.read.parquet(f"{out}/batch={number}").where("error is null").select("message_id").collect():  # `most` rows a poll
            queue.Queue(path).delete(r["message_id"])

    stream = spark.readStream.format("queue").option("path", path).option("most", most).option("visibility", visibility).load()
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if poll_s is None else w.trigger(processingTime=f"{poll_s} seconds")).start()


def started(spark: SparkSession, out: str) -> DataFrame:
    """The runs that served() started."""
    return spark.read.option("recursiveFileLookup", "true").parquet(out).where("error is null").drop("error")
