"""Writers: runs, elements, trees, chunks, index points and report files. Every write of a key replaces what it wrote before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from leafline.operators import scratch

#: Each so many levels of a fold, what is folded so far is stored, so that plans stay short.
KEPT_LEVELS = 8


def run_pages(pages: DataFrame, path: str) -> None:
    """pages(document_id, run_id, ...) under document and run."""
    pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("document_id", "run_id").parquet(path)


def page_elements(elements: DataFrame, path: str, stage: str) -> None:
    """elements as JSON under the stage, raw or enriched."""
    if stage not in ("raw", "enriched"):
        raise ValueError("stage is raw or enriched")
    elements.write.mode("overwrite").json(f"{path}/{stage}")


def portable(path: Column, anchor: str) -> Column:
    """A path under the anchor made relative to it."""
    base = anchor.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(base)), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


def nested_trees(nodes: DataFrame) -> DataFrame:
    """(doc, tree): JSON forests of nodes(doc, path, title, node_id, start_index, end_index), children folded into parents bottom up."""
    own = F.struct("title", "node_id", "start_index", "end_index")
    rows = nodes.select("doc", "path", F.to_json(own).alias("j"))
    deepest = rows.agg(F.max(F.size("path"))).first()[0] or 0
    carried = None
    for d in range(deepest, 0, -1):
        level = rows.where(F.size("path") == d)
        if carried is not None:
            level = level.join(carried, ["doc", "path"], "left")
            level = level.select("doc", "path", F.when(F.col("children").isNull(), F.col("j")).otherwise(F.concat(F.expr("left(j, length(j) - 1)"), F.lit(',"nodes":'), F.col("children"), F.lit("}"))).alias("j"))
        folded = level.groupBy("doc", F.slice("path", 1, d - 1).alias("parent")).agg(F.array_sort(F.collect_list(F.struct("path", "j"))).alias("x"))
        if d % KEPT_LEVELS == 0:
            folded = scratch.stored(folded, "level")
        carried = folded.select("doc", F.col("parent").alias("path"), F.concat(F.lit("["), F.array_join(F.transform("x", lambda r: r["j"]), ","), F.lit("]")).alias("children"))
    return carried.select("doc", F.col("children").alias("tree")) if carried is not None else nodes.select("doc", F.lit("[]").alias("tree")).limit(0)


def chunk_json(chunks: DataFrame) -> DataFrame:
    return chunks.select("doc_id", F.to_json(F.struct(*chunks.columns), {"ignoreNullFields": "true"}).alias("json"))


def upsert_points(points: DataFrame, path: str) -> int:
    """points replace those of the same papers in the table; papers not named stay. Returns the number written.

    One pass: the rows are counted as they are written, and no row writes nothing.
    """
    seen = Observation()
    points.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("paper").parquet(path)
    return seen.get["n"]


def delete_papers(spark, path: str, papers: list[str]) -> None:
    """Removes papers' points; nothing happens where the table or a paper is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for paper in papers:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/paper={paper}")
        if fs.exists(at):
            fs.delete(at, True)


def create_table(spark, path: str, dim: int) -> bool:
    """A folder with its metadata (cosine, dim, idf at query time, keyed by paper); False if it was there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_meta")
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return False
    spark.createDataFrame([(dim, "cosine", "idf", "paper")], "dim int, distance string, sparse_modifier string, key string").coalesce(1).write.json(f"{path}/_meta")
    return True


def batch_files(summary: DataFrame, items: DataFrame, failed: DataFrame, path: str) -> None:
    """summary as JSON, items as CSV with a header, failures as JSON lines."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    items.write.mode("overwrite").option("header", True).csv(f"{path}/per_item")
    failed.write.mode("overwrite").json(f"{path}/failures")


def index_chunks(spark, rows: DataFrame, path: str, dim: int) -> int:
    """Rows (paper, point_id, embedding, ...) as the whole of their papers in the index, however often: made where it is missing,
    checked, and each named paper's points replaced. Returns the number written."""
    from leafline.operators import index

    create_table(spark, path, dim)
    return upsert_points(index.checked(rows, dim), f"{path}/points")


def write_bytes(spark, uri: str, data: bytes) -> str:
    """data as one object at a path or address that Spark's file systems know."""
    at = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(data))
    out.close()
    return uri
