"""From pages to trees: detection of printed tables of contents, three ways to a table of sections, and the cascade over them.

Each call is a batch of prompts over all documents that need it (building.asked_of), so documents go side by side, and each
document passes through as few ways as its verification allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import answers, prompts, providers, text
from leafline.operators import building, scratch, toc, trees
from leafline.operators.building import Options

# The ways in the order they are tried, and what a document without sections gets.
MODES = ("with_pages", "without_pages", "none")
WHOLE = ("1", "Document", 1)
GOOD_ENOUGH = 0.6
ROWS = ("doc", "ord", "structure", "title", "page", "physical_index")


def post_processed(sections: DataFrame, last_page: Column) -> DataFrame:
    """Sections as tree nodes (doc, parent, ord, title, start_index, end_index, is_leaf): ranges, parents by structure code, and
    runs of citations made one node. sections(doc, ord, structure, title, physical_index, appear_start)."""
    ranged = trees.section_ranges(sections, last_page).select("doc", "ord", "structure", "title", "start_index", "end_index")
    kin = trees.parents(ranged)
    # each row stands under its own ord and under its parent's, so that a node knows whether another names it; documents don't move
    node = F.struct(F.col("parent_ord").alias("parent"), "ord", "title", "start_index", "end_index")
    at = lambda key, names: F.struct(F.col(key).alias("key"), F.lit(names).alias("names"))
    each = kin.select("doc", node.alias("node"), F.explode(F.array(at("ord", False), at("parent_ord", True))).alias("at")).select("doc", "node", "at.*")
    named = each.withColumn("inner", F.max("names").over(W.partitionBy("doc", "key"))).where(~F.col("names"))
    return trees.citation_runs(named.select("doc", "node.*", (~F.col("inner")).alias("is_leaf")))


def content(wanted: DataFrame, pages: DataFrame, *key: str) -> DataFrame:
    """(doc, key, content): the tagged pages of wanted(doc, key, page_idx), in order."""
    tagged = text.wrap_page(F.col("text"), F.col("page_idx") + 1)
    got = wanted.join(pages.select("doc", "page_idx", "text"), ["doc", "page_idx"]).groupBy("doc", *key).agg(F.array_sort(F.collect_list(F.struct("page_idx", tagged.alias("t")))).alias("p"))
    return got.select("doc", *key, F.array_join(F.transform("p", lambda x: x["t"]), "").alias("content"))


def asked(rows: DataFrame, name: str, opt: Options, provider: providers.Provider, response: str | None = None, **values: Column) -> DataFrame:
    """rows with the answer to the prompt of that name."""
    return building.asked_of(rows.select("*", F.lit(opt.model).alias("model"), prompts.render(name, opt.style, **values).alias("prompt")), provider, response)


def answer(field: str, otherwise: str) -> Column:
    return F.when(F.col("ok"), F.coalesce(F.from_json("content", f"{field} string")[field], F.lit(otherwise))).otherwise(F.lit(otherwise))


def answered_rows(told: DataFrame, *keep: str) -> DataFrame:
    """(keep..., ROWS) of answers that list sections; page tags and bare numbers become physical indexes."""
    r = told.where("ok").select("doc", *keep, F.posexplode(answers.assembled_rows(text.without_fences(F.col("content")))).alias("n", "r"))
    index = F.coalesce(text.parse_page_tag(F.col("r.physical_index")), F.col("r.physical_index").try_cast("int"))
    return r.select("doc", *keep, (F.col("n") + 1).alias("ord"), "r.structure", "r.title", F.col("r.page").try_cast("int").alias("page"), index.alias("physical_index"))


def detected_pages(pages: DataFrame, opt: Options, provider: providers.Provider) -> DataFrame:
    """(doc, page_idx) of the printed table of contents: pages under the limit are asked at once, later ones one by one while the
    table goes on."""

    def flags(some: DataFrame) -> DataFrame:
        told = asked(some.select("doc", "page_idx", F.col("text").alias("body")), "toc_detector_single_page", opt, provider, "toc_detection", content=F.col("body"))
        return told.select("doc", "page_idx", answer("toc_detected", "no").alias("flag"))

    found = flags(pages.where(F.col("page_idx") < opt.toc_check_pages))
    last = found
    while True:
        ends = last.groupBy("doc").agg(F.max_by("flag", "page_idx").alias("flag"), F.max("page_idx").alias("last")).where("flag = 'yes'")
        more = scratch.stored(pages.join(ends.select("doc", (F.col("last") + 1).alias("page_idx")), ["doc", "page_idx"]), "next")
        if more.isEmpty():
            return toc.toc_pages(found, opt.toc_check_pages)
        last = flags(more)
        found = found.unionByName(last)


def printed_toc(found: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider) -> DataFrame:
    """(doc, toc, last, given): the table's text, leader dots as colons, its last page, and whether it has page numbers."""
    got = found.join(pages.select("doc", "page_idx", "text"), ["doc", "page_idx"]).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_idx", "text"))).alias("p"), F.max("page_idx").alias("last"))
    texts = got.select("doc", text.transform_dots(F.array_join(F.transform("p", lambda x: x["text"]), "")).alias("toc"), "last")
    told = asked(texts, "detect_page_index", opt, provider, "page_index_present", toc=F.col("toc"))
    return told.select("doc", "toc", "last", answer("page_index_given_in_toc", "no").alias("given"))


def listed(printed: DataFrame, opt: Options, provider: providers.Provider) -> DataFrame:
    """ROWS of printed tables, transformed into lists."""
    whole = building.transformed_toc(printed.select("doc", "toc"), opt, provider)
    return scratch.stored(answered_rows(whole.withColumn("ok", F.lit(True))).select(*ROWS), "listed")


def filled(sections: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider) -> DataFrame:
    """sections whose missing indexes are looked for between the known ones around them; only a page tag is accepted. A section
    without a later anchor has nowhere to be looked for."""
    gaps = toc.anchors(sections, F.lit(0), F.lit(-1)).where("physical_index is null and next_index >= prev_index")
    near = gaps.select("doc", "ord", F.explode(F.sequence("prev_index", "next_index")).alias("number")).where("number > 0").select("doc", "ord", (F.col("number") - 1).alias("page_idx"))
    ask = content(near, pages, "ord").withColumnRenamed("content", "body").join(gaps.select("doc", "ord", F.to_json(F.struct("structure", "title")).alias("item")), ["doc", "ord"])
    told = asked(ask, "add_page_number_to_toc", opt, provider, "toc_list", item=F.col("item"), content=F.col("body")).where("ok")
    first = told.select("doc", "ord", answers.assembled_rows(F.col("content"))[0]["physical_index"].alias("v")).where(F.startswith("v", F.lit(f"<{text.PAGE_TAG}")))
    return toc.corrected(sections, gaps, first.select("doc", "ord", text.parse_page_tag(F.col("v")).alias("fixed")))


def with_page_numbers(printed: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider) -> DataFrame:
    """ROWS by printed page numbers: sections found on the pages after the table give the offset between printed and physical
    numbers; what it leaves open is looked for between neighbours."""
    rows = listed(printed, opt, provider)
    after = pages.join(printed.select("doc", "last"), "doc").where((F.col("page_idx") > F.col("last")) & (F.col("page_idx") <= F.col("last") + opt.toc_check_pages)).select("doc", "page_idx")
    bare = rows.groupBy("doc").agg(F.to_json(F.array_sort(F.collect_list(F.struct("ord", "structure", "title")))).alias("items"))
    told = asked(content(after, pages).withColumnRenamed("content", "body").join(bare, "doc"), "toc_index_extractor", opt, provider, "toc_list", toc=F.col("items"), content=F.col("body"))
    pairs = toc.matching_pairs(rows.select("doc", "title", "page"), answered_rows(told).drop("page"))
    located = toc.with_offset(rows.withColumnRenamed("page", "page_number"), toc.page_offset(pairs)).withColumnRenamed("page_number", "page")
    return filled(scratch.stored(located.select(*ROWS), "located"), pages, opt, provider)


def without_page_numbers(printed: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider, budget: int = 10_000) -> DataFrame:
    """ROWS of tables without page numbers: group by group of pages, the sections so far go through a call that adds indexes. A
    call that fails, or lists nothing, leaves them as they are."""
    rows = listed(printed, opt, provider)
    groups = scratch.stored(toc.page_groups(pages.join(printed.select("doc"), "doc", "left_semi"), budget, 1, text.PAGE_OVERHEAD_TOKENS), "groups")
    last = groups.agg(F.max("grp")).first()[0]
    for g in range((last if last is not None else -1) + 1):
        so_far = rows.groupBy("doc").agg(F.to_json(F.array_sort(F.collect_list(F.struct("ord", "structure", "title", "physical_index")))).alias("items"))
        ask = content(groups.where(F.col("grp") == g).select("doc", "page_idx"), pages).withColumnRenamed("content", "body").join(so_far, "doc")
        new = answered_rows(asked(ask, "add_page_number_to_toc", opt, provider, "toc_list", item=F.col("items"), content=F.col("body"))).select(*ROWS)
        rows = scratch.stored(rows.join(new, "doc", "left_anti").unionByName(new), "sections")
    return rows


def checked(sections: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider | None = None, units: DataFrame | None = None) -> DataFrame:
    """sections with answer and appear_start, by a model's reading of their pages; without a provider by building.title_checks.
    units(doc, source): the document whose pages a unit's sections are on; without it a unit is a document."""
    rows = sections.withColumn("source", F.col("doc")) if units is None else sections.join(units.select("doc", "source"), "doc")
    if provider is None:
        return building.title_checks(rows, pages, "source").drop("source")
    page = pages.select(F.col("doc").alias("source"), (F.col("page_idx") + 1).alias("physical_index"), F.col("text").alias("body"))
    ask = rows.select("doc", "ord", "title", "physical_index", "source").join(page, ["source", "physical_index"])
    out = sections
    for name, schema, field, column in (("check_title_appearance", "title_appearance", "answer", "answer"), ("check_title_appearance_in_start", "title_starts_section", "start_begin", "appear_start")):
        told = asked(ask, name, opt, provider, schema, title=F.col("title"), page_text=F.col("body"))
        out = out.join(told.select("doc", "ord", answer(field, "no").alias(column)), ["doc", "ord"], "left").withColumn(column, F.coalesce(column, F.lit("no")))
    return out


def whole(pages: DataFrame) -> DataFrame:
    """(doc, source, first, last): each document as a unit of its own, pages from 1."""
    return pages.groupBy("doc").agg(F.count("*").cast("int").alias("last")).select("doc", F.col("doc").alias("source"), F.lit(1).alias("first"), "last")


def fixed(seen: DataFrame, pages: DataFrame, units: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None, rounds: int = building.FIX_ROUNDS) -> DataFrame:
    """Checked sections whose answer is no, moved to the page that a model names between the right ones around them, if a check
    finds the title there; otherwise they stay where they are and are asked for again, for so many rounds. seen(doc, ord,
    structure, title, physical_index, answer, appear_start); appear_start is that of the page where a section ends up."""
    rows = scratch.stored(seen.select("doc", "ord", "structure", "title", "physical_index", "appear_start", F.coalesce(F.col("answer") == "yes", F.lit(False)).alias("right")), "to-fix")
    for _ in range(rounds):
        wrong = rows.where("not right").select("doc", "ord", "title")
        if wrong.isEmpty():
            break
        known = rows.withColumn("physical_index", F.when(F.col("right"), F.col("physical_index"))).join(units, "doc")
        spans = toc.anchors(known, F.col("first") - 1, F.col("last")).join(wrong.select("doc", "ord"), ["doc", "ord"])
        low, high = F.greatest("prev_index", "first"), F.least("next_index", "last")
        near = spans.where(low <= high).select("doc", "ord", "source", F.explode(F.sequence(low, high)).alias("number"))
        near = near.select(F.col("source").alias("doc"), F.struct("doc", "ord").alias("at"), (F.col("number") - 1).alias("page_idx"))
        ask = content(near, pages, "at").select("at.doc", "at.ord", F.col("content").alias("body")).join(wrong, ["doc", "ord"])
        told = asked(ask, "single_toc_item_index_fixer", opt, provider, "physical_index_fix", section_title=F.col("title"), content=F.col("body"))
        v = answer("physical_index", "")
        found = told.select("doc", "ord", "title", F.coalesce(text.parse_page_tag(v), v.try_cast("int")).alias("physical_index")).where("physical_index is not null")
        found = checked(scratch.stored(found, "found"), pages, opt, checks, units).where("answer = 'yes'").select("doc", "ord", F.col("physical_index").alias("fixed"), F.col("appear_start").alias("opens"))
        moved = rows.join(found, ["doc", "ord"], "left")
        rows = scratch.stored(moved.select("doc", "ord", "structure", "title", F.coalesce("fixed", "physical_index").alias("physical_index"), F.coalesce("opens", "appear_start").alias("appear_start"), (F.col("right") | F.col("fixed").isNotNull()).alias("right")), "sections")
    return rows.drop("right")


def accepted(made: DataFrame, pages: DataFrame, units: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None, last_way: bool) -> DataFrame:
    """The sections of the units that stay with this way: all verified, or mostly and then fixed; with the last way all others
    too, as they are; with appear_start, as the check found it. made(doc, ord, structure, title, physical_index)."""
    own = made.select("doc", "ord", "structure", "title", "physical_index").join(units.select("doc", "first", (F.col("last") - F.col("first") + 1).alias("slice_pages")), "doc")
    own = scratch.stored(toc.located(toc.within_document(own, F.col("slice_pages"), F.col("first"))).drop("first"), "made")
    seen = scratch.stored(checked(own, pages, opt, checks, units), "checked")
    right, wrong = toc.accuracy(seen), seen.groupBy("doc").agg(F.count_if(F.col("answer") == "no").alias("errors"))
    verdict = F.when((F.col("accuracy") == 1) & (F.col("errors") == 0), "keep").when((F.col("accuracy") > GOOD_ENOUGH) & (F.col("errors") > 0), "fix").otherwise("keep" if last_way else "next")
    verdicts = scratch.stored(right.join(wrong, "doc").select("doc", verdict.alias("verdict")), "verdicts")
    some = lambda v: seen.join(verdicts.where(F.col("verdict") == v), "doc", "left_semi")
    kept = some("keep").select("doc", "ord", "structure", "title", "physical_index", "appear_start")
    mend = some("fix")
    return scratch.stored(kept if mend.isEmpty() else kept.unionByName(fixed(mend, pages, units, opt, provider, checks)), "accepted")


def without_toc(units: DataFrame, pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> DataFrame:
    """(doc, ord, structure, title, physical_index, appear_start) of units(doc, source, first, last), runs of a document's pages, by the
    way that needs no printed table; a unit without any section is one section, whose appear_start is null."""
    inside = (F.col("source") == F.col("pdoc")) & (F.col("page_idx") >= F.col("first") - 1) & (F.col("page_idx") < F.col("last"))
    own = toc.by_document(units.join(pages.withColumnRenamed("doc", "pdoc"), inside), "source")
    rows = accepted(building.generated_toc_of(own, opt, provider), pages, units, opt, provider, checks, True)
    bare = units.join(rows.select("doc").distinct(), "doc", "left_anti")
    return rows.unionByName(bare.select("doc", F.lit(1).alias("ord"), F.lit(WHOLE[0]).alias("structure"), F.lit(WHOLE[1]).alias("title"), F.col("first").alias("physical_index"), F.lit(None).cast("string").alias("appear_start")))


def sections(pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> DataFrame:
    """(doc, ord, structure, title, physical_index, mode) of every document's sections.

    A document begins with the way that its printed table allows. Sections that all verify stay; those that mostly do are fixed;
    others go to the next way. The last way keeps what it has; a document without any section is one section.
    """
    return sections_seen(scratch.stored(pages, "pages"), opt, provider, checks).drop("appear_start")


def sections_seen(pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> DataFrame:
    """`sections` of stored pages with appear_start, as the check found it; null for a document without any section."""
    units = scratch.stored(whole(pages), "units")
    printed = scratch.stored(printed_toc(detected_pages(pages, opt, provider), pages, opt, provider), "printed")
    begin = units.join(printed, "doc", "left").select("doc", F.when(F.col("toc").isNull(), 2).when(F.col("given") == "yes", 0).otherwise(1).alias("way"))
    pending, out = scratch.stored(begin, "ways"), []
    for way, mode in enumerate(MODES):
        docs = pending.where(F.col("way") <= way).select("doc")
        if docs.isEmpty():
            continue
        of = lambda df: df.join(docs, "doc", "left_semi")  # noqa: E731, B023
        if mode == "none":
            rows = without_toc(of(units), pages, opt, provider, checks)
        else:
            made = (with_page_numbers if way == 0 else without_page_numbers)(of(printed), of(pages), opt, provider)
            rows = accepted(made, pages, of(units), opt, provider, checks, False)
        out.append(rows.withColumn("mode", F.lit(mode)))
        pending = scratch.stored(pending.join(rows.select("doc").distinct(), "doc", "left_anti"), "ways")
    if not out:
        return without_toc(units, pages, opt, provider, checks).withColumn("mode", F.lit(MODES[-1]))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return scratch.stored(rows, "sections")


def processed(pages: DataFrame, opt: Options, provider: providers.Provider, checks: providers.Provider | None = None) -> DataFrame:
    """`sections` with appear_start: whether a section's title opens its page."""
    return checked(sections(pages, opt, provider, checks), pages, opt, checks).select("doc", "ord", "structure", "title", "physical_index", "appear_start", "mode")


def projected(nodes: DataFrame, order: list[str], drop: tuple[str, ...] = ("page_number",)) -> DataFrame:
    """nodes with the columns of `order` that they have, in that order, after doc and path; without `drop`."""
    return nodes.select("doc", "path", *(c for c in order if c in nodes.columns and c not in (*drop, "doc", "path")))


def outline(nodes: DataFrame) -> DataFrame:
    """What a description is written from: title, node_id and summary of each node."""
    return projected(nodes, ["title", "node_id", "summary"])
