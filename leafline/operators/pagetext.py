"""Page text assembled as specs ask for it, and prompts rendered from specs; rows in, one row out for each.

specs(doc, key, spec): spec is a prompts.PAGE_SPEC. Pages are put one after another, raw or each between its tags, leader dots made
colons if asked; pages around them go before and after between marks, and section_only takes out what stands between. Pages
around others need raw pages; another kind of wrapping, or a page that the document lacks, is an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions import prompts, text

WRAPS = ("raw", "physical_index")
PARTS = ("indices", "overlap_pre", "overlap_post")


def assembled(specs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, key, text) of specs over pages(doc, page_idx, text)."""

    def listed(k: int, part: str) -> Column:
        return F.transform(F.coalesce(f"spec.{part}", F.array().cast("array<int>")), lambda i, n: F.struct(F.lit(k).alias("part"), n.alias("nth"), i.alias("page_idx")))

    all_of = F.flatten(F.array(*(listed(k, part) for k, part in enumerate(PARTS))))
    each = specs.select("doc", "key", F.explode(all_of).alias("x")).select("doc", "key", "x.*")
    missing = F.raise_error(F.format_string("document %s has no page %s", F.col("doc").cast("string"), "page_idx")).cast("string")
    found = each.join(pages.select("doc", "page_idx", F.coalesce("text", F.lit("")).alias("text")), ["doc", "page_idx"], "left").withColumn("text", F.coalesce("text", missing))
    got = found.groupBy("doc", "key").agg(F.array_sort(F.collect_list(F.struct("part", "nth", "page_idx", "text"))).alias("p"))
    out = specs.select("doc", "key", "spec").join(got, ["doc", "key"], "left").withColumn("p", F.coalesce("p", F.array().cast(got.schema["p"].dataType)))

    def joined(part: int, shown: Callable[[Column], Column] = lambda r: r["text"]) -> Column:
        return F.array_join(F.transform(F.filter("p", lambda r: r["part"] == part), shown), "")

    wrap, around = F.col("spec.wrap"), F.exists("p", lambda r: r["part"] > 0)
    core = F.when(wrap == "raw", joined(0)).when(wrap == "physical_index", joined(0, lambda r: text.wrap_page(r["text"], r["page_idx"] + 1)))
    core = core.otherwise(F.raise_error(F.concat(F.lit("wrap is raw or physical_index, not "), F.coalesce(wrap, F.lit("null")))).cast("string"))
    core = F.when(F.col("spec.dots"), text.transform_dots(core)).otherwise(core)
    marked = text.with_context(joined(1), core, joined(2))
    whole = F.when(wrap != "raw", F.raise_error(F.lit("pages around others need wrap raw")).cast("string")).when(F.col("spec.section_only"), text.section_block(marked)).otherwise(marked)
    return out.select("doc", "key", F.when(around, whole).otherwise(core).alias("text"))


def rendered(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, key, prompt) of rows(doc, key, spec), spec being a prompts.SPEC over the pages of its document."""
    each = rows.select("doc", "key", F.explode("spec.page").alias("field", "spec"))
    parts = assembled(each.select("doc", F.struct("key", "field").alias("key"), "spec"), pages)
    values = parts.groupBy("doc", F.col("key.key").alias("key")).agg(F.map_from_entries(F.collect_list(F.struct("key.field", "text"))).alias("own"))
    both = rows.join(values, ["doc", "key"], "left")
    named = F.map_concat("spec.small", F.coalesce("own", F.create_map().cast("map<string,string>")))
    return both.select("doc", "key", prompts.filled(F.col("spec.name"), F.col("spec.style"), named).alias("prompt"))
