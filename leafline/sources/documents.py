"""Readers: page corpora, trees, manifests, elements, result files and vectors, all with stated schemas."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import text
from leafline.operators import scratch

PAGES = "doc string, page_idx int, text string, token_count long"
MANIFEST = "batch_id string, items array<struct<document_id:string,pdf_uri:string>>"
INDEX_MANIFEST = "batch_id string, items array<struct<document_id:string,tree_uri:string>>"
NODE = "title string, node_id string, start_index int, end_index int, summary string, raw_text string"


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Staged pages: JSON lines of PAGES; other fields fail."""
    return spark.read.schema(PAGES).option("mode", "FAILFAST").json(path)


def text_pages(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text) as pages: a page a line."""
    lines = documents.select(F.col("doc_id").cast("string").alias("doc"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("page_idx", "text"))
    from leafline.functions.text import count_tokens

    return lines.withColumn("token_count", count_tokens(F.col("text")))


def blobs(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as (path, modificationTime, length, content), in any store that Spark reads."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def manifest(spark: SparkSession, path: str, index: bool = False) -> DataFrame:
    """(batch_id, item_ord, document_id, uri) of a manifest file."""
    m = spark.read.schema(INDEX_MANIFEST if index else MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
    each = m.select("batch_id", F.posexplode("items").alias("item_ord", "i"))
    return each.select("batch_id", "item_ord", "i.document_id", F.col("i.tree_uri" if index else "i.pdf_uri").alias("uri"))


def trees(spark: SparkSession, path: str) -> DataFrame:
    """Tree files as adjacency rows (doc, path array<int>, parent_path, title, ..., depth), level by level until one is empty.

    Spark has no recursive types, so nodes are variants; a file that isn't JSON fails.
    """
    t = spark.read.option("wholetext", True).text(path).select(F.parse_json("value").alias("v"))
    nodes = lambda v, at: F.posexplode(F.variant_get(v, at, "array<variant>")).alias("n", "node")
    level = t.select(F.variant_get("v", "$.paper_id", "string").alias("doc"), nodes("v", "$.root_nodes")).select("doc", F.array("n").alias("path"), "node")
    fields = [F.variant_get("node", f"$.{f.split(' ')[0]}", f.split(" ")[1]).alias(f.split(" ")[0]) for f in NODE.split(", ")]
    out = None
    for d in count(1):
        level = scratch.stored(level, "level")
        if out is not None and level.isEmpty():
            return out
        rows = level.select("doc", "path", F.slice("path", 1, d - 1).alias("parent_path"), *fields, F.lit(d).alias("depth"))
        out = rows if out is None else out.unionByName(rows)
        level = level.select("doc", "path", nodes("node", "$.nodes")).select("doc", F.concat("path", F.array("n")).alias("path"), "node")


RESULT_NAME = r"([^/]+)_p(\d+)_(.+)_([^_/]+)_([^_/]+)\.md$"


def result_names(paths: DataFrame, col: str = "path") -> DataFrame:
    """(pdf, page, image, model, task) of result files named pdf_p1_image_model_task.md; other names are skipped."""
    part = lambda n: F.regexp_extract(col, RESULT_NAME, n)
    return paths.where(F.rlike(col, F.lit(RESULT_NAME))).select(F.col(col), part(1).alias("pdf"), part(2).cast("int").alias("page"), part(3).alias("image"), part(4).alias("model"), part(5).alias("task"))


def grouped_results(named: DataFrame) -> DataFrame:
    return named.groupBy("pdf", "page", "image").agg(F.array_sort(F.collect_list(F.struct("model", "task"))).alias("results"))


def inputs(spark: SparkSession, pdf_dir: str | None = None, tree_dir: str | None = None, manifest_path: str | None = None) -> DataFrame:
    """(item_ord, document_id, uri) of the one given source: documents of a folder, trees of its subfolders, or a manifest."""
    given = [x for x in (pdf_dir, tree_dir, manifest_path) if x]
    if len(given) != 1:
        raise ValueError("give exactly one of pdf_dir, tree_dir and manifest_path")
    if manifest_path:
        return manifest(spark, manifest_path).select("item_ord", "document_id", "uri")
    found = spark.read.format("binaryFile").load(f"{pdf_dir}/*.pdf" if pdf_dir else f"{tree_dir}/*/tree.json").select("path")
    name = F.regexp_extract("path", r"([^/]+)\.pdf$" if pdf_dir else r"([^/]+)/tree\.json$", 1)
    ids = found.select("path", (text.slug(name) if pdf_dir else name).alias("document_id"))
    nth = F.row_number().over(W.orderBy("path")) - 1  # a row a file
    return ids.select(nth.alias("item_ord"), "document_id", F.col("path").alias("uri"))


def source_images(named: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """named(pdf, page, image) with source: the first of a png and a jpg that files(path) has under root."""
    at = lambda ext: F.concat(F.lit(f"{root}/"), "pdf", F.lit("/"), F.col("page").cast("string"), F.lit("/doclayout_yolo/figures/"), "image", F.lit(ext))
    each = named.select("*", F.explode(F.array(F.struct(F.lit(0).alias("rank"), at(".png").alias("path")), F.struct(F.lit(1).alias("rank"), at(".jpg").alias("path")))).alias("x"))
    found = each.join(files.select("path").distinct(), F.col("x.path") == F.col("path"), "left")
    return found.groupBy("pdf", "page", "image").agg(F.min_by("path", F.when(F.col("path").isNotNull(), F.col("x.rank"))).alias("source"))
