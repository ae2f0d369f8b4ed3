"""What the operators of this subpackage share: shared scratch tables, table reading and bounded broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows stay under this bound (at some 100 bytes a row, 20 MB).
BROADCAST_ROWS = 200_000
#: A key of more rows than this is joined where its rows are, see joined().
HOT = 1024


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir, which every executor and the driver can reach.

    Where the setting is absent, a temporary folder serves a local master only; a cluster without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="leafline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/leafline-{spark.sparkContext.applicationId}"


def local_path(uri: str) -> str:
    """The path of a file: URI or plain path; other schemes are mounted by the caller or not supported."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory mapping needs a shared mounted folder in spark.checkpoint.dir, got {uri}")
    return parts.path


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df, written as a Parquet table to the shared folder and read again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; df should be a stored table, whose count comes from its files' footers."""
    return df.count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows are under the bound; without one, joins shuffle."""
    return F.broadcast(df) if few(df, rows) else df


def joined(big: DataFrame, counted: DataFrame, key: str, rows: int) -> DataFrame:
    """big joined with counted(key, n, ...) on key, n being big's rows of that key and `rows` at least big's rows.

    Every key of counted has a row in big, so that counted is broadcast where big has few rows. Beyond that, hot keys are
    broadcast and their rows stay where they are; the others shuffle, HOT rows a key at most. The limit rises with the rows, so
    that there are at most BROADCAST_ROWS hot keys.
    """
    if rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(counted.drop("n")), key)
    limit = max(HOT, -(-rows // BROADCAST_ROWS))
    hot, cold = counted.where(F.col("n") > limit).drop("n"), counted.where(F.col("n") <= limit).drop("n")
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti")
    return big.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))


def boxed(df: DataFrame, name: str = "row") -> Column:
    """All columns of df in one struct, so that no name of theirs can clash with an operator's."""
    return F.struct(*(F.col(quoted(c)) for c in df.columns)).alias(name)


def unboxed(df: DataFrame, name: str = "row", **others: Column) -> list[Column]:
    """The columns of a box, those named in others by them; others that the box lacks follow. A box's own column of such a
    name gives way, in any case of its letters unless the session tells cases apart."""
    same = (lambda c: c) if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    inside, by = df.schema[name].dataType.names, {same(k): (k, v) for k, v in others.items()}
    own = {same(c) for c in inside}
    kept = [by[same(c)][1].alias(by[same(c)][0]) if same(c) in by else F.col(name)[c].alias(c) for c in inside]
    return kept + [v.alias(k) for k, v in others.items() if same(k) not in own]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clashes(distinct: DataFrame) -> DataFrame | None:
    """(h1, own): the h1 that have several h2 in distinct(h1, h2), and the least of these; nothing where there is none."""
    found = stored(distinct.groupBy("h1").agg(F.min("h2").alias("own"), F.count("*").alias("c")).where("c > 1").drop("c"), "clashes")
    return None if found.isEmpty() else found


def told_apart(rows: DataFrame, clash: DataFrame | None) -> DataFrame:
    """rows(h1, h2, ...) with node, a 64-bit key of (h1, h2): h1 itself, but a mixture of both where h1 clashes. Values share a
    node only if both hashes agree."""
    if clash is None:
        return rows.withColumn("node", F.col("h1"))
    node = F.when(F.col("own").isNotNull() & (F.col("own") != F.col("h2")), F.xxhash64("h2", "h1")).otherwise(F.col("h1"))
    return rows.join(maybe_broadcast(clash), "h1", "left").withColumn("node", node).drop("own")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unsigned_crc32(col: Column) -> Column:
    return F.crc32(col.cast("string").cast("binary"))


def arrow_rows(spark: SparkSession, rows: int = 512) -> None:
    """Bounds the rows of an Arrow batch, since texts may be very long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
