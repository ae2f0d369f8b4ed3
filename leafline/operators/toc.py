"""Table-of-contents rows: page parsing and offsets, anchors around gaps, verification, grouping of pages by token budget."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def parsed_pages(toc: DataFrame) -> DataFrame:
    """toc(page string) with page_number, null where the page isn't a number."""
    return toc.withColumn("page_number", F.col("page").try_cast("int"))


def within_document(toc: DataFrame, last_page: Column, start: int | Column = 1) -> DataFrame:
    """physical_index beyond the document, or a slice of so many pages from `start` on, becomes null; the row stays."""
    return toc.withColumn("physical_index", F.when(F.col("physical_index") <= last_page + start - 1, F.col("physical_index")))


def located(toc: DataFrame) -> DataFrame:
    return toc.where("physical_index is not null")


def matching_pairs(printed: DataFrame, found: DataFrame, start: int = 1) -> DataFrame:
    """(doc, title, page, physical_index, ord): printed and found rows of equal title, null titles included, from page `start` on."""
    p = printed.select(F.col("doc").alias("pdoc"), F.col("title").alias("ptitle"), "page")
    j = found.join(p, (F.col("doc") == F.col("pdoc")) & F.col("title").eqNullSafe(F.col("ptitle")))
    return j.where(F.col("physical_index") >= start).select("doc", "title", "page", "physical_index", "ord")


def page_offset(pairs: DataFrame) -> DataFrame:
    """(doc, offset): the most frequent physical_index - page, the first seen one on ties."""
    d = pairs.withColumn("offset", F.col("physical_index") - F.col("page")).where("offset is not null")
    counts = d.groupBy("doc", "offset").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    return counts.groupBy("doc").agg(F.max_by("offset", F.struct("n", -F.col("first"))).alias("offset"))


def with_offset(toc: DataFrame, offsets: DataFrame) -> DataFrame:
    """physical_index = page + offset where a page number is known."""
    j = toc.join(offsets, "doc", "left")
    return j.withColumn("physical_index", F.coalesce(F.col("page_number") + F.col("offset"), F.col("physical_index"))).drop("offset")


def anchors(toc: DataFrame, before: Column, after: Column) -> DataFrame:
    """toc with prev_index and next_index: the known pages next to each row, or the given defaults."""
    w = W.partitionBy("doc").orderBy("ord")
    prev = F.last("physical_index", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    nxt = F.first("physical_index", ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing))
    return toc.withColumns({"prev_index": F.coalesce(prev, before), "next_index": F.coalesce(nxt, after)})


def corrected(toc: DataFrame, wrong: DataFrame, fixes: DataFrame) -> DataFrame:
    """toc with physical_index from fixes(doc, ord, fixed) for the rows in wrong(doc, ord); others stay."""
    f = wrong.select("doc", "ord").distinct().join(fixes.where("fixed is not null").select("doc", "ord", "fixed"), ["doc", "ord"])
    return toc.join(f, ["doc", "ord"], "left").withColumn("physical_index", F.coalesce("fixed", "physical_index")).drop("fixed")


def accuracy(checks: DataFrame) -> DataFrame:
    """(doc, accuracy): the share of answers 'yes' among located rows; gate: 0 if no row is located or the last located one lies before the
    middle. checks(doc, ord, answer, physical_index, slice_pages)."""
    a = checks.groupBy("doc").agg(F.avg(F.when(F.col("physical_index").isNotNull(), (F.col("answer") == "yes").cast("double"))).alias("a"), F.max_by("physical_index", F.when(F.col("physical_index").isNotNull(), F.col("ord"))).alias("last"), F.max("slice_pages").alias("pages"))
    return a.select("doc", F.when(F.col("last").isNull() | (F.col("last") < F.col("pages") / 2), F.lit(0.0)).otherwise(F.coalesce("a", F.lit(0.0))).alias("accuracy"))


def decision(accuracy: Column, errors: Column, rounds: Column) -> Column:
    """What follows a verification: keep, fix (three rounds at most) or the next mode."""
    return F.when((accuracy == 1) & (errors == 0), "keep").when((accuracy > 0.6) & (rounds < 3), "fix").otherwise("next")


def toc_pages(flags: DataFrame, limit: int) -> DataFrame:
    """The pages of the first run flagged 'yes': flags(doc, page_idx, flag), a run that starts before `limit` and ends at the first 'no'."""
    w = W.partitionBy("doc").orderBy("page_idx")
    yes = F.col("flag") == "yes"
    m = flags.withColumn("began", F.max(F.when(yes & (F.col("page_idx") < limit), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    m = m.withColumn("stopped", F.max(F.when((F.col("began") == 1) & (F.col("flag") == "no"), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return m.where(yes & (F.col("began") == 1) & (F.col("stopped") == 0)).select("doc", "page_idx")


def search_limit(configured: int, total: Column) -> Column:
    return F.least(F.lit(configured), F.greatest(F.lit(3), F.floor(total / 3).cast("int")))


def strategy(has_toc: Column, has_pages: Column) -> Column:
    return F.when(~has_toc, "none").when(has_pages, "with_pages").otherwise("without_pages")


def by_document(pages: DataFrame, *also: str) -> DataFrame:
    """(doc, p): the pages of each document in order, in one row. also: columns that are the same on all its pages, which may say
    where the pages are already together."""
    return pages.groupBy("doc", *also).agg(F.array_sort(F.collect_list(F.struct("page_idx", "token_count", "text"))).alias("p")).drop(*also)


def grouped(documents: DataFrame, max_tokens: int = 10_000, overlap: int = 1, overhead: int = 0) -> DataFrame:
    """(doc, grp, p): the pages p(page_idx, token_count, ...) of documents(doc, p) as consecutive ones within a token budget; a group
    begins with `overlap` pages of the one before.

    A document's pages fold in order inside one expression; documents are independent.
    """
    each = documents.withColumn("n", F.transform("p", lambda x: x["token_count"] + overhead))
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    each = each.withColumn("total", total)
    parts = F.ceil(F.col("total") / max_tokens)
    each = each.withColumn("cap", F.ceil((F.col("total") / F.greatest(parts, F.lit(1)) + max_tokens) / 2))
    zero = F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("n"), F.array().cast("array<int>").alias("starts"))

    def step(a, x):
        back = F.greatest(a["k"] - overlap, F.lit(0))
        carried = F.aggregate(F.slice("n", back + 1, a["k"] - back), F.lit(0).cast("long"), lambda s, y: s + y)
        over = (a["k"] > 0) & (a["n"] + x > F.col("cap"))
        return F.struct((a["k"] + 1).alias("k"), F.when(over, carried + x).otherwise(a["n"] + x).alias("n"), F.when(over, F.concat(a["starts"], F.array(a["k"]))).otherwise(a["starts"]).alias("starts"))

    cut = each.withColumn("starts", F.concat(F.array(F.lit(0)), F.when(F.col("total") <= max_tokens, F.array().cast("array<int>")).otherwise(F.aggregate("n", zero, step)["starts"])))
    g = cut.select("doc", "p", "starts", F.posexplode("starts").alias("grp", "from"))
    end = F.coalesce(F.try_element_at("starts", F.col("grp") + 2), F.size("p"))
    begin = F.when(F.col("grp") > 0, F.greatest(F.col("from") - overlap, F.lit(0))).otherwise(0)
    return g.select("doc", "grp", F.slice("p", begin + 1, end - begin).alias("p"))


def page_groups(pages: DataFrame, max_tokens: int = 10_000, overlap: int = 1, overhead: int = 0) -> DataFrame:
    """(doc, grp, page_idx) of the groups of pages(doc, page_idx, token_count)."""
    each = pages.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_idx", "token_count"))).alias("p"))
    return grouped(each, max_tokens, overlap, overhead).select("doc", "grp", F.explode("p").alias("x")).select("doc", "grp", "x.page_idx")


def likely_scanned(pages: DataFrame, fewest: int = 30) -> DataFrame:
    """(doc, scanned): whether the upper median of words a page is under `fewest`. pages(doc, words)."""
    m = pages.groupBy("doc").agg(F.array_sort(F.collect_list("words")).alias("w"))
    return m.select("doc", (F.element_at("w", F.floor(F.size("w") / 2).cast("int") + 1) < fewest).alias("scanned"))


def expected_group_cap(total: int, max_tokens: int) -> int:
    """The cap that page_groups balances groups by; the driver's counterpart of its expression."""
    return math.ceil((total / max(1, math.ceil(total / max_tokens)) + max_tokens) / 2)


def sampled(toc: DataFrame, n: int | None, seed: int) -> DataFrame:
    """n rows of each document, the same for the same seed; all without n."""
    if n is None:
        return toc
    nth = F.row_number().over(W.partitionBy("doc").orderBy(F.xxhash64(F.lit(seed), "doc", "ord"), "ord"))
    return toc.withColumn("__nth", nth).where(F.col("__nth") <= n).drop("__nth")
