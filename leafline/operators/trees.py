"""Section trees as adjacency rows: ranges, parents, preorder, breadcrumbs, page text and citation runs.

Rows are toc(doc, ord, structure, title, physical_index, appear_start) or nodes(doc, key, parent, ord, ...). Documents are
independent, so every window and join is keyed by doc.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import ids, text
from leafline.operators import scratch

CITATION_RUN = 5


def _by_doc(order: str = "ord"):
    return W.partitionBy("doc").orderBy(order)


def section_ranges(toc: DataFrame, last_page: Column) -> DataFrame:
    """toc with start_index and end_index: a section ends where the next one starts, a page earlier if that one opens its page."""
    nxt = F.lead("physical_index").over(_by_doc())
    opens = F.lead("appear_start").over(_by_doc()) == "yes"
    is_last = F.lead("ord").over(_by_doc()).isNull()
    end = F.when(is_last, last_page).when(opens, nxt - 1).otherwise(nxt)
    return toc.withColumns({"start_index": F.col("physical_index"), "end_index": end.cast("int")})


def with_preface(toc: DataFrame) -> DataFrame:
    """A first section 'Preface' on page 1 for documents whose first section starts later."""
    first = toc.withColumn("nth", F.row_number().over(_by_doc())).where((F.col("nth") == 1) & (F.col("physical_index") > 1))
    rows = first.select("doc", (F.col("ord") - 1).alias("ord"), F.lit("0").alias("structure"), F.lit("Preface").alias("title"), F.lit(1).alias("physical_index"), F.lit(None).cast("string").alias("appear_start"))
    return toc.unionByName(rows)


def parents(toc: DataFrame) -> DataFrame:
    """toc with parent_ord: the latest earlier row whose structure is this one's without its last part; null for roots."""
    up = F.when(F.contains("structure", F.lit(".")), F.regexp_replace("structure", r"\.[^.]*$", ""))
    own = F.struct(*toc.columns)
    # each row stands twice: under the structure it looks for and, after those of its ord, under its own
    at = lambda key, last: F.struct(key.alias("key"), F.lit(last).alias("last"))
    each = toc.select("doc", own.alias("row"), F.explode(F.array(at(up, False), at(F.col("structure"), True))).alias("at")).select("doc", "row", "at.*", F.col("row.ord").alias("ord"))
    w = W.partitionBy("doc", "key").orderBy("ord", "last", "row")
    parent = F.when(F.col("key").isNotNull(), F.last(F.when(F.col("last"), F.col("ord")), ignorenulls=True).over(w))
    found = each.withColumns({"parent_ord": parent, "again": F.col("row").eqNullSafe(F.lag("row").over(w)) & (F.lag("last").over(w) == F.col("last"))})
    return found.where(~F.col("last") & ~F.coalesce("again", F.lit(False))).select("row.*", "parent_ord")


def preorder(nodes: DataFrame) -> DataFrame:
    """nodes(doc, ord, parent_ord, title) with depth, path (ordinals from the root), node_id and breadcrumb (titles from the root).

    Level by level until one is empty: each round joins the children of the level before, on (doc, parent), and stores them. A node that is
    its own ancestor is an error; nodes that no root reaches are in no tree.
    """
    level = nodes.where("parent_ord is null").withColumns({"depth": F.lit(1), "path": F.array("ord"), "breadcrumb": F.array("title")})
    out = level
    for d in count(2):
        above = level.select(F.col("doc").alias("adoc"), F.col("ord").alias("aord"), F.col("path").alias("apath"), F.col("breadcrumb").alias("acrumb"))
        level = nodes.join(above, (F.col("doc") == F.col("adoc")) & (F.col("parent_ord") == F.col("aord")))
        cycle = F.raise_error(F.format_string("node %s of document %s is its own ancestor", "ord", "doc")).cast("boolean")
        level = level.where(F.when(F.array_contains("apath", F.col("ord")), cycle).otherwise(F.lit(True))).select(*nodes.columns, F.lit(d).alias("depth"), F.concat("apath", F.array("ord")).alias("path"), F.concat("acrumb", F.array("title")).alias("breadcrumb"))
        level = scratch.stored(level, "level")
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.withColumn("node_id", ids.node_id(F.row_number().over(W.partitionBy("doc").orderBy("path")) - 1))


def postorder(nodes: DataFrame) -> DataFrame:
    """nodes(doc, path) with visit, from 1: every node after all that is below it, siblings in order."""
    last = F.concat("path", F.array(F.lit(2**31 - 1)).cast(nodes.schema["path"].dataType))  # beyond any ordinal below
    return nodes.withColumn("visit", F.row_number().over(W.partitionBy("doc").orderBy(last)))


def leaves(nodes: DataFrame) -> DataFrame:
    """The nodes that no node names as parent."""
    p = nodes.where("parent_ord is not null").select("doc", F.col("parent_ord").alias("ord")).distinct()
    return nodes.join(p, ["doc", "ord"], "left_anti")


def citation_runs(nodes: DataFrame, run: int = CITATION_RUN) -> DataFrame:
    """Runs of at least `run` citation-shaped leaf siblings become one node 'References' over their pages.

    nodes(doc, parent, ord, title, start_index, end_index, is_leaf); repeated application changes nothing.
    """
    w = W.partitionBy("doc", "parent").orderBy("ord")
    cited = nodes.withColumn("c", F.col("is_leaf") & text.looks_like_citation(F.col("title")))
    marked = cited.withColumn("island", F.sum(F.when(F.col("c") & F.coalesce(F.lag("c").over(w), F.lit(False)), 0).otherwise(1)).over(w))
    sized = marked.withColumn("n", F.count("*").over(W.partitionBy("doc", "parent", "island")))
    merge = F.col("c") & (F.col("n") >= run)
    island = W.partitionBy("doc", "parent", "island")
    whole = sized.withColumns({"merge": merge, "first": F.row_number().over(island.orderBy("ord")) == 1, "begin": F.min("start_index").over(island), "end": F.max("end_index").over(island)})
    either = lambda merged, own: F.when(F.col("merge"), merged).otherwise(F.col(own)).alias(own)
    return whole.where("first or not merge").select("doc", "parent", "ord", either(F.lit("References"), "title"), either(F.col("begin"), "start_index"), either(F.col("end"), "end_index"), "is_leaf")


def page_indexes(start: Column, end: Column) -> Column:
    """0-based pages of a 1-based range; empty where it ends before it starts."""
    return F.when(end >= start, F.sequence(start - 1, end - 1)).otherwise(F.array().cast("array<int>"))


def neighbour_pages(start: Column, end: Column, around: int, total: Column) -> tuple[Column, Column]:
    """0-based pages before and after a 1-based range, `around` of them at most."""
    none = F.array().cast("array<int>")
    if around <= 0:
        return none, none
    lo, hi = F.greatest(F.lit(1), start - around), F.least(total, end + around)
    before = F.when(start > 1, F.sequence(lo - 1, start - 2)).otherwise(none)
    after = F.when(end < total, F.sequence(end, hi - 1)).otherwise(none)
    return before, after


def node_text(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """nodes(doc, key, start_index, end_index) with raw_text: their pages(doc, page_idx, text), clamped and joined in order."""
    each = nodes.select("doc", "key", F.explode(page_indexes(F.greatest(F.col("start_index"), F.lit(1)), F.col("end_index"))).alias("page_idx"))
    got = each.join(pages.select("doc", "page_idx", "text"), ["doc", "page_idx"]).groupBy("doc", "key").agg(F.array_sort(F.collect_list(F.struct("page_idx", "text"))).alias("p"))
    joined = got.select("doc", "key", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("raw_text"))
    return nodes.join(joined, ["doc", "key"], "left").withColumn("raw_text", F.coalesce("raw_text", F.lit("")))


def page_owner(nodes: DataFrame) -> DataFrame:
    """(doc, page, key): the last node in preorder whose 1-based page range covers the page. nodes(doc, key, dfs, start_index, end_index)."""
    each = nodes.where("end_index >= start_index").select("doc", "key", "dfs", F.explode(F.sequence("start_index", "end_index")).alias("page"))
    return each.groupBy("doc", "page").agg(F.max_by("key", "dfs").alias("key"))


def node_images(nodes: DataFrame, images: DataFrame) -> DataFrame:
    """nodes with page_image_uris, in page order, of the pages that have an image(doc, page, uri)."""
    each = nodes.where("end_index >= start_index").select("doc", "key", F.explode(F.sequence("start_index", "end_index")).alias("page"))
    got = each.join(images, ["doc", "page"]).groupBy("doc", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "uri"))), lambda x: x["uri"]).alias("page_image_uris"))
    return nodes.join(got, ["doc", "key"], "left").withColumn("page_image_uris", F.coalesce("page_image_uris", F.array().cast("array<string>")))


def distinct_pages(nodes: DataFrame, page_count: DataFrame) -> DataFrame:
    """(doc, page): each 1-based page that any node covers, within the document's page_count(doc, total)."""
    each = nodes.where("end_index >= start_index").select("doc", F.explode(F.sequence("start_index", "end_index")).alias("page")).distinct()
    return each.join(page_count, "doc").where((F.col("page") >= 1) & (F.col("page") <= F.col("total"))).select("doc", "page")


def too_large(nodes: DataFrame, max_pages: int, max_tokens: int, max_depth: int = 3) -> DataFrame:
    """Whether a node is to be divided: its end more than max_pages after its start, at least max_tokens, above max_depth."""
    span = F.col("end_index") - F.col("start_index")
    return nodes.withColumn("divide", (span > max_pages) & (F.col("tokens") >= max_tokens) & (F.col("depth") < max_depth))


def node_defaults(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({"title": F.coalesce("title", F.lit("")), "node_id": F.coalesce("node_id", F.lit("0000")), "start_index": F.coalesce("start_index", F.lit(1)), "end_index": F.coalesce("end_index", F.lit(1))})


def summary_block(nodes: DataFrame) -> DataFrame:
    """(doc, parent, block): the children's '[id] title' and summary, in order, with blank lines between."""
    s = F.coalesce(F.nullif("summary", F.lit("")), F.lit("(no summary)"))
    one = F.concat(F.lit("["), F.col("node_id"), F.lit("] "), F.col("title"), F.lit("\n"), s)
    got = nodes.groupBy("doc", "parent").agg(F.array_sort(F.collect_list(F.struct("ord", one.alias("b")))).alias("x"))
    return got.select("doc", "parent", F.array_join(F.transform("x", lambda r: r["b"]), "\n\n").alias("block"))
