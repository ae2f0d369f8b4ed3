"""Whole trees from pages: sections become nodes, oversized nodes are divided again on their own pages, level by level over all
documents at once, and summaries and descriptions follow.

Nodes are rows (doc, path, title, start_index, end_index). path, the ordinals from the root down, names a node, sorts a tree in
preorder and leads to its parent, so that new levels need no numbering of old ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import ids, providers
from leafline.operators import building, processing, scratch, trees
from leafline.operators.building import Options

# Fixed value: how often nodes are divided, one below the other.
DIVISIONS = 3
NODE = ("doc", "path", "title", "start_index", "end_index")


@dataclass
class Built:
    """nodes(doc, path, node_id, title, start_index, end_index, summary) and documents(doc, total_pages, description)."""

    nodes: DataFrame
    documents: DataFrame


def nodes_of(sections: DataFrame, last_page: Column) -> DataFrame:
    """NODE and is_top of checked sections(doc, ord, structure, title, physical_index, appear_start)."""
    kin = processing.post_processed(sections.where("physical_index is not null"), last_page).withColumnRenamed("parent", "parent_ord")
    tree = trees.preorder(scratch.stored(kin, "kin"))
    return tree.select(*NODE)


def above(levels: int) -> Column:
    return F.slice("path", 1, levels)


def divided(nodes: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> DataFrame:
    """nodes, those of more than opt.max_pages pages and opt.max_tokens tokens replaced by what their own pages give.

    A first section of the node's own title is the node; then the node ends where the second begins, otherwise where the first
    does. Nodes below a divided one are looked at in the next round, unless one of its children spans as much as it did.
    """
    rows = scratch.stored(nodes.select(*NODE).withColumn("open", F.lit(True)), "nodes")
    for depth in range(1, DIVISIONS + 1):
        long = rows.where(F.col("open") & (F.size("path") == depth) & (F.col("end_index") - F.col("start_index") > opt.max_pages))
        own = long.select("doc", "path", F.explode(trees.page_indexes(F.col("start_index"), F.col("end_index"))).alias("page_idx")).join(pages.select("doc", "page_idx", "token_count"), ["doc", "page_idx"])
        tokens = own.groupBy("doc", "path").agg(F.sum("token_count").alias("tokens"))
        sized = trees.too_large(long.join(tokens, ["doc", "path"]).withColumn("depth", F.lit(depth - 1)), opt.max_pages, opt.max_tokens, DIVISIONS)
        unit = F.concat_ws("/", F.col("doc").cast("string"), F.array_join(F.transform("path", lambda x: x.cast("string")), "."))
        big = scratch.stored(sized.where("divide").select(unit.alias("unit"), *NODE), "oversized")
        if big.isEmpty():
            continue
        units = scratch.stored(big.select(F.col("unit").alias("doc"), F.col("doc").alias("source"), F.col("start_index").alias("first"), F.col("end_index").alias("last")), "units")
        found = scratch.stored(processing.without_toc(units, pages, opt, provider, checks), "subsections")
        of = big.select(F.col("unit").alias("doc"), F.col("title").alias("own"), F.col("end_index").alias("last"), (F.col("end_index") - F.col("start_index")).alias("span"))
        nth = F.row_number().over(W.partitionBy("doc").orderBy("ord"))
        listed = found.join(of, "doc").withColumn("nth", nth)
        same = listed.where((F.col("nth") == 1) & (F.trim("title") == F.trim("own"))).select("doc", F.lit(True).alias("same"))
        listed = scratch.stored(listed.join(same, "doc", "left").withColumn("same", F.coalesce("same", F.lit(False))), "listed")
        below = listed.where(~(F.col("same") & (F.col("nth") == 1)))
        ends = below.groupBy("doc").agg(F.min_by("physical_index", "nth").alias("cut"))
        made = scratch.stored(nodes_of(below.select("doc", "ord", "structure", "title", "physical_index", "appear_start", "last"), F.col("last")), "children")
        stalled = made.where(F.size("path") == 1).join(of, "doc").where(F.col("end_index") - F.col("start_index") >= F.col("span")).select("doc").distinct().withColumn("open", F.lit(False))
        fresh = made.join(stalled, "doc", "left").withColumnRenamed("doc", "unit").join(big.select("unit", "doc", F.col("path").alias("up")), "unit")
        fresh = fresh.select("doc", F.concat("up", "path").alias("path"), "title", "start_index", "end_index", F.coalesce("open", F.lit(True)).alias("open"))
        cuts = big.join(ends.withColumnRenamed("doc", "unit"), "unit", "left").select("doc", "path", "cut", F.lit(True).alias("cut_up"))
        inside = (F.size("path") > depth) & F.coalesce(F.col("cut_up"), F.lit(False))
        old = rows.withColumn("head", above(depth)).join(cuts.withColumnRenamed("path", "head"), ["doc", "head"], "left").where(~inside)
        old = old.select("doc", "path", "title", "start_index", F.coalesce("cut", "end_index").alias("end_index"), "open")
        rows = scratch.stored(old.unionByName(fresh), "nodes")
    return rows.drop("open")


def structured(pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> DataFrame:
    """(doc, path, node_id, title, start_index, end_index) of the trees of pages(doc, page_idx, text, token_count)."""
    pages = scratch.stored(pages.select("doc", "page_idx", "text", "token_count"), "pages")
    # a first section's appear_start is not asked for: no section ends before it
    seen = trees.with_preface(processing.sections_seen(pages, opt, provider, checks).drop("mode"))
    total = pages.groupBy("doc").agg(F.count("*").cast("int").alias("total"))
    nodes = nodes_of(scratch.stored(seen.join(total, "doc"), "checked"), F.col("total"))
    rows = divided(nodes, pages, opt, provider, checks)
    return rows.withColumn("node_id", ids.node_id(F.row_number().over(W.partitionBy("doc").orderBy("path")) - 1)).select("doc", "path", "node_id", "title", "start_index", "end_index")


def built(pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> Built:
    """Trees with summaries and descriptions, as the options ask for them; an unasked summary or description is null."""
    nodes = scratch.stored(structured(pages, opt, provider, checks), "structure").withColumn("key", F.array_join(F.transform("path", lambda x: x.cast("string")), "."))
    nodes = scratch.stored(building.summarised(nodes, pages, opt, provider), "summaries") if opt.summaries else nodes.withColumn("summary", F.lit(None).cast("string"))
    documents = pages.groupBy("doc").agg(F.count("*").cast("int").alias("total_pages"))
    said = building.described(nodes, opt, provider) if opt.description else documents.select("doc", F.lit(None).cast("string").alias("description"))
    columns = ["doc", "path", *(["node_id"] if opt.node_ids else []), "title", "start_index", "end_index", "summary"]
    return Built(nodes.select(*columns), documents.join(said, "doc", "left"))
