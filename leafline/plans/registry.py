"""Registered queries and the SQL that must give the same rows. Each runs an operator over whole tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.functions import answers, ids, prompts, providers, text
from leafline.operators import batch, building, chunks, elements, history, hosts, index, intervals, ledger, pagetext, processing, reports, retrieval, scratch, series, toc, trees, treebuild
from leafline.plans import adapters as A
from leafline.sources import documents as sources
from leafline.sources import npy, queue, sinks
from leafline.streaming import ingest

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

# US dollars a million input and output tokens, by model.
PRICES = [("purchase", 3.0, 15.0), ("view", 0.8, 4.0), ("click", 2.5, 10.0), ("signup", 0.15, 0.6)]
SEEDS = ["EC", "PC", "hard carbon", "ionic conductivity", "NaPF6", "NASICON"]


def query(name: str, sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- call records

_TOTALS = "t AS (SELECT model, count(*) AS count, count(*) FILTER (WHERE errored) AS errors, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, coalesce(sum(ended_at - started_at) FILTER (WHERE NOT errored), 0) AS compute_s FROM calls GROUP BY model)"
_UNION = """m AS (SELECT model, started_at AS s, ended_at AS e, max(ended_at) OVER (PARTITION BY model ORDER BY started_at, ended_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM calls WHERE NOT errored),
i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b THEN 1 ELSE 0 END) OVER (PARTITION BY model ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM m),
u AS (SELECT model, sum(w) AS wall FROM (SELECT model, g, max(e) - min(s) AS w FROM i GROUP BY model, g) GROUP BY model)"""
_PEAK = """ev AS (SELECT model, started_at AS t, 1 AS d FROM calls WHERE NOT errored UNION ALL SELECT model, ended_at, -1 FROM calls WHERE NOT errored),
r AS (SELECT model, sum(d) OVER (PARTITION BY model ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS n FROM ev), p AS (SELECT model, CAST(greatest(max(n), 0) AS BIGINT) AS peak FROM r GROUP BY model)"""


@query("a1_call_totals", f"WITH {A.CALLS}, {_TOTALS} SELECT model, count, errors, input_tokens, output_tokens, round(compute_s, 3) AS compute_s FROM t")
def _(s, d):
    return intervals.call_totals(A.calls(s, d)).withColumn("compute_s", F.round("compute_s", 3))


@query("a2_model_summary", f"WITH {A.CALLS}, {_TOTALS}, {_UNION}, {_PEAK} SELECT model, count, errors, input_tokens, output_tokens, round(compute_s, 3) AS compute_time_s, round(coalesce(wall, 0), 3) AS wall_clock_time_s, round(compute_s / count, 3) AS avg_call_s, coalesce(peak, 0) AS max_concurrent FROM t LEFT JOIN u USING (model) LEFT JOIN p USING (model)")
def _(s, d):
    return intervals.summary(A.calls(s, d))


@query("a3_interval_union", f"WITH {A.CALLS}, {_UNION} SELECT model, round(wall, 3) AS wall_s FROM u")
def _(s, d):
    return intervals.union_length(A.calls(s, d).where("not errored")).withColumn("wall_s", F.round("wall_s", 3))


@query("a4_peak_concurrency", f"WITH {A.CALLS}, {_PEAK} SELECT model, peak FROM p")
def _(s, d):
    return intervals.peak_concurrency(A.calls(s, d).where("not errored"))


@query("a5_token_totals", f"WITH {A.CALLS} SELECT CAST(sum(input_tokens) AS BIGINT) AS input, CAST(sum(output_tokens) AS BIGINT) AS output, CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS total FROM calls")
def _(s, d):
    return intervals.token_totals(A.calls(s, d))


_PRICED = f"prices(pm, i, o) AS (VALUES {', '.join(f"('{m}', {i}, {o})" for m, i, o in PRICES)}), c AS (SELECT model, input_tokens, output_tokens, round(input_tokens / 1e6 * i + output_tokens / 1e6 * o, 6) AS cost_usd FROM (SELECT 'ocr:' || model AS model, input_tokens, output_tokens FROM t) LEFT JOIN prices ON pm = substr(model, 5))"


def _costs(s, d) -> DataFrame:
    t = intervals.call_totals(A.calls(s, d)).select(F.concat(F.lit("ocr:"), "model").alias("model"), "input_tokens", "output_tokens")
    return intervals.priced(t, s.createDataFrame(PRICES, "model string, input_rate double, output_rate double"))


@query("j12_price_lookup", f"WITH {A.CALLS}, {_TOTALS}, {_PRICED} SELECT * FROM c")
def _(s, d):
    return _costs(s, d)


@query("a21_total_cost", f"WITH {A.CALLS}, {_TOTALS}, {_PRICED} SELECT CASE WHEN bool_or(cost_usd IS NULL) THEN NULL ELSE round(sum(cost_usd), 6) END AS cost_usd, CASE WHEN bool_or(cost_usd IS NULL) THEN 'some models have no price' END AS note FROM c")
def _(s, d):
    return intervals.total_cost(_costs(s, d))


# --- sections

@query("w1_section_ranges", f"WITH {A.TOC} SELECT doc, ord, physical_index AS start_index, CAST(CASE WHEN lead(ord) OVER w IS NULL THEN 8 WHEN lead(appear_start) OVER w = 'yes' THEN lead(physical_index) OVER w - 1 ELSE lead(physical_index) OVER w END AS INTEGER) AS end_index FROM toc WINDOW w AS (PARTITION BY doc ORDER BY ord)")
def _(s, d):
    return trees.section_ranges(A.toc(s, d), F.lit(8)).select("doc", "ord", "start_index", "end_index")


@query("h2_preface", f"WITH {A.TOC}, t AS (SELECT doc, ord, structure, title, physical_index FROM toc) SELECT * FROM t UNION ALL SELECT doc, ord - 1, '0', 'Preface', 1 FROM t WHERE ord = 1 AND physical_index > 1")
def _(s, d):
    return trees.with_preface(A.toc(s, d).drop("line")).select("doc", "ord", "structure", "title", "physical_index")


@query("h1_list_to_tree", f"WITH {A.TOC} SELECT c.doc, c.ord, c.structure, max(p.ord) AS parent_ord FROM toc c LEFT JOIN toc p ON p.doc = c.doc AND p.ord < c.ord AND p.structure = CASE WHEN contains(c.structure, '.') THEN regexp_replace(c.structure, '\\.[^.]*$', '') END GROUP BY ALL")
def _(s, d):
    return trees.parents(A.toc(s, d).select("doc", "ord", "structure"))


_WALK = f"WITH RECURSIVE {A.PLACES}, w AS (SELECT doc, ord, parent_ord, title, 1 AS depth, [ord] AS path, [title] AS crumb FROM places WHERE parent_ord IS NULL UNION ALL SELECT p.doc, p.ord, p.parent_ord, p.title, depth + 1, list_append(path, p.ord), list_append(crumb, p.title) FROM places p JOIN w ON p.doc = w.doc AND p.parent_ord = w.ord), n AS (SELECT *, printf('%04d', row_number() OVER (PARTITION BY doc ORDER BY path) - 1) AS node_id FROM w)"


@query("w5_preorder_ids", f"{_WALK} SELECT doc, title, depth, node_id FROM n")
def _(s, d):
    return trees.preorder(A.places(s, d)).select("doc", "title", "depth", "node_id")


@query("h6_leaf_breadcrumbs", f"{_WALK} SELECT n.doc, n.title, array_to_string(crumb, ' > ') AS breadcrumb FROM n WHERE NOT EXISTS (SELECT 1 FROM places c WHERE c.doc = n.doc AND c.parent_ord = n.ord)")
def _(s, d):
    return trees.leaves(trees.preorder(A.places(s, d))).select("doc", "title", F.array_join("breadcrumb", " > ").alias("breadcrumb"))


@query("h7_postorder", f"{_WALK} SELECT doc, title, row_number() OVER (PARTITION BY doc ORDER BY depth DESC, path) AS visit FROM n")
def _(s, d):
    from pyspark.sql import Window as W

    return trees.preorder(A.places(s, d)).select("doc", "title", F.row_number().over(W.partitionBy("doc").orderBy(F.desc("depth"), "path")).cast("long").alias("visit"))


@query("a25_child_summaries", f"{_WALK} SELECT doc, parent_ord AS parent, string_agg('[' || node_id || '] ' || title || chr(10) || '(no summary)', chr(10) || chr(10) ORDER BY ord) AS block FROM n WHERE parent_ord IS NOT NULL GROUP BY ALL")
def _(s, d):
    n = trees.preorder(A.places(s, d)).where("parent_ord is not null").select("doc", F.col("parent_ord").alias("parent"), "ord", "node_id", "title", F.lit(None).cast("string").alias("summary"))
    return trees.summary_block(n)


@query("a23_node_count", f"WITH {A.PLACES} SELECT doc, count(*) AS nodes FROM places GROUP BY doc")
def _(s, d):
    return A.places(s, d).groupBy("doc").agg(F.count("*").alias("nodes"))


@query("h5_citation_collapse", f"""WITH {A.CITED}, c AS (SELECT *, is_leaf AND (regexp_matches(title, '^([A-Z]\\.\\s*){{1,3}}[A-Z][A-Za-z]+') OR regexp_matches(title, ',\\s*(19|20)\\d{{2}},\\s*\\d+,\\s*\\d+')) AS c FROM cited),
l AS (SELECT *, lag(c) OVER (PARTITION BY doc, parent ORDER BY ord) AS before FROM c), i AS (SELECT *, sum(CASE WHEN c AND coalesce(before, false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc, parent ORDER BY ord ROWS UNBOUNDED PRECEDING) AS g FROM l), n AS (SELECT *, count(*) OVER (PARTITION BY doc, parent, g) AS n FROM i)
SELECT doc, parent, ord, title, start_index, end_index, is_leaf FROM n WHERE NOT (c AND n >= 5) UNION ALL SELECT doc, parent, min(ord), 'References', min(start_index), max(end_index), true FROM n WHERE c AND n >= 5 GROUP BY doc, parent, g""")
def _(s, d):
    return trees.citation_runs(A.cited(s, d))


@query("h8_node_text", f"WITH {A.PAGES}, {A.RANGES} SELECT r.doc, key, coalesce(string_agg(text, '' ORDER BY page_idx), '') AS raw_text FROM ranges r LEFT JOIN pages_ p ON p.doc = r.doc AND page_idx BETWEEN greatest(start_index - 1, 0) AND end_index - 1 GROUP BY r.doc, key")
def _(s, d):
    return trees.node_text(A.ranges(s, d), A.pages(s, d)).select("doc", "key", "raw_text")


@query("j2_page_owner", f"WITH {A.RANGES}, e AS (SELECT doc, key, dfs, unnest(range(start_index, end_index + 1)) AS page FROM ranges WHERE end_index >= start_index) SELECT doc, CAST(page AS INTEGER) AS page, arg_max(key, dfs) AS key FROM e GROUP BY doc, page")
def _(s, d):
    return trees.page_owner(A.ranges(s, d))


@query("j4_node_images", f"WITH {A.PAGES}, {A.RANGES}, i AS (SELECT doc, page_idx + 1 AS page, 'p' || (page_idx + 1) || '.png' AS uri FROM pages_ WHERE page_idx % 2 = 0) SELECT r.doc, key, coalesce(string_agg(uri, ',' ORDER BY page), '') AS uris FROM ranges r LEFT JOIN i ON i.doc = r.doc AND page BETWEEN start_index AND end_index GROUP BY r.doc, key")
def _(s, d):
    i = A.pages(s, d).where("page_idx % 2 = 0").select("doc", (F.col("page_idx") + 1).alias("page"), F.concat(F.lit("p"), F.col("page_idx") + 1, F.lit(".png")).alias("uri"))
    return trees.node_images(A.ranges(s, d), i).select("doc", "key", F.array_join("page_image_uris", ",").alias("uris"))


@query("a27_distinct_pages", f"WITH {A.PAGES}, {A.RANGES}, n AS (SELECT doc, count(*) AS total FROM pages_ GROUP BY doc), e AS (SELECT DISTINCT doc, unnest(range(start_index, end_index + 1)) AS page FROM ranges WHERE end_index >= start_index) SELECT doc, CAST(page AS INTEGER) AS page FROM e JOIN n USING (doc) WHERE page BETWEEN 1 AND total")
def _(s, d):
    return trees.distinct_pages(A.ranges(s, d), A.pages(s, d).groupBy("doc").agg(F.count("*").alias("total")))


@query("p9_neighbour_pages", f"WITH {A.RANGES} SELECT doc, key, array_to_string(CASE WHEN start_index > 1 THEN range(greatest(1, start_index - 2) - 1, start_index - 1) ELSE [] END, ',') AS before, array_to_string(CASE WHEN end_index < 6 THEN range(end_index, least(6, end_index + 2)) ELSE [] END, ',') AS after, array_to_string(CASE WHEN end_index >= start_index THEN range(start_index - 1, end_index) ELSE [] END, ',') AS own FROM ranges")
def _(s, d):
    b, a = trees.neighbour_pages(F.col("start_index"), F.col("end_index"), 2, F.lit(6))
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return A.ranges(s, d).select("doc", "key", join(b).alias("before"), join(a).alias("after"), join(trees.page_indexes(F.col("start_index"), F.col("end_index"))).alias("own"))


@query("h3_post_processed", f"WITH {A.TOC}, r AS (SELECT doc, ord, structure, title, physical_index AS start_index, CAST(CASE WHEN lead(ord) OVER w IS NULL THEN 8 WHEN lead(appear_start) OVER w = 'yes' THEN lead(physical_index) OVER w - 1 ELSE lead(physical_index) OVER w END AS INTEGER) AS end_index FROM toc WINDOW w AS (PARTITION BY doc ORDER BY ord)), k AS (SELECT c.doc, c.ord, any_value(c.title) AS title, any_value(c.start_index) AS start_index, any_value(c.end_index) AS end_index, max(p.ord) AS parent FROM r c LEFT JOIN r p ON p.doc = c.doc AND p.ord < c.ord AND p.structure = CASE WHEN contains(c.structure, '.') THEN regexp_replace(c.structure, '\\.[^.]*$', '') END GROUP BY c.doc, c.ord) SELECT *, NOT EXISTS (SELECT 1 FROM k x WHERE x.doc = k.doc AND x.parent = k.ord) AS is_leaf FROM k")
def _(s, d):
    return processing.post_processed(A.toc(s, d), F.lit(8))


@query("p16_outline", f"{_WALK} SELECT doc, array_to_string(path, '/') AS path, title, node_id FROM n")
def _(s, d):
    n = trees.preorder(A.places(s, d)).withColumn("page_number", F.lit(1))
    return processing.outline(n).withColumn("path", F.array_join(F.transform("path", lambda x: x.cast("string")), "/"))


@query("h10_divide", f"WITH {A.RANGES} SELECT doc, key, (end_index - start_index > 3) AND (n_chars >= 1000) AND dfs < 3 AS divide FROM ranges JOIN documents ON doc_id = doc")
def _(s, d):
    n = A.ranges(s, d).join(A.table(s, d, "documents").select(F.col("doc_id").alias("doc"), F.col("n_chars").alias("tokens")), "doc").withColumn("depth", F.col("dfs"))
    return trees.too_large(n, 3, 1000).select("doc", "key", "divide")


#: Lines that begin with a capital up to R are headings, those up to D of sections, the others of subsections. The reader lists
#: both, as it sees one page group at a time; which of them a document's list keeps is settled over all groups (Options.outer).
READER = providers.heading_reader("[A-R]", "[A-R]")


@query("h10_tree_structure", f"""WITH {A.PAGES}, p AS (SELECT doc, page_idx + 1 AS n, text, len(regexp_extract_all(text, '[A-Za-z0-9]{{1,4}}|[^\\sA-Za-z0-9]')) AS tokens FROM pages_), docs AS (SELECT doc, count(*) AS total FROM p GROUP BY doc),
h AS (SELECT doc, n, array_to_string(string_split(text, ' ')[:4], ' ') AS title, regexp_matches(text, '^[A-D]') AS coarse FROM p WHERE regexp_matches(text, '^[A-R]') AND length(title) BETWEEN 5 AND 300),
listed AS (SELECT doc, n, title FROM h JOIN (SELECT doc, bool_or(coarse AND n > 1) AS any_coarse FROM h GROUP BY doc) USING (doc) WHERE coarse OR NOT any_coarse),
top AS (SELECT * FROM listed UNION ALL SELECT doc, 1, 'Document' FROM docs WHERE doc NOT IN (SELECT doc FROM listed) UNION ALL SELECT doc, 1, 'Preface' FROM listed GROUP BY doc HAVING min(n) > 1),
node AS (SELECT doc, n, title, coalesce(lead(n) OVER (PARTITION BY doc ORDER BY n) - 1, total) AS last FROM top JOIN docs USING (doc)),
big AS (SELECT node.doc, node.n, node.title, last FROM node JOIN p ON p.doc = node.doc AND p.n BETWEEN node.n AND last WHERE last - node.n > 3 GROUP BY ALL HAVING sum(tokens) >= 100),
inner_ AS (SELECT big.doc, big.n AS up, big.title AS own, last, h.n, h.title FROM big JOIN h ON h.doc = big.doc AND h.n BETWEEN big.n AND last),
below AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, up ORDER BY n) AS nth FROM inner_) WHERE NOT (nth = 1 AND trim(title) = trim(own)) UNION ALL SELECT doc, n, title, last, n, 'Document', 1 FROM big WHERE title <> 'Document' AND NOT EXISTS (SELECT 1 FROM inner_ WHERE inner_.doc = big.doc AND up = big.n)),
child AS (SELECT doc, up, n, title, coalesce(lead(n) OVER (PARTITION BY doc, up ORDER BY n) - 1, last) AS last FROM below),
cut AS (SELECT doc, up, min(n) AS cut FROM below GROUP BY doc, up),
both_ AS (SELECT node.doc, node.n AS up, 0 AS below, node.n, title, coalesce(cut, last) AS last, 1 AS depth FROM node LEFT JOIN cut ON cut.doc = node.doc AND cut.up = node.n UNION ALL SELECT doc, up, n, n, title, last, 2 FROM child)
SELECT doc, printf('%04d', row_number() OVER (PARTITION BY doc ORDER BY up, below) - 1) AS node_id, depth, title, CAST(n AS INTEGER) AS start_index, CAST(last AS INTEGER) AS end_index FROM both_""")
def _(s, d):
    opt = building.Options(toc_check_pages=1, max_pages=3, max_tokens=100, outer="^[A-D]")
    return treebuild.structured(A.pages(s, d), opt, READER).select("doc", "node_id", F.size("path").alias("depth"), "title", "start_index", "end_index")


# --- tables of contents

@query("p11_within_document", f"WITH {A.TOC} SELECT doc, ord, CASE WHEN physical_index <= 5 THEN physical_index END AS physical_index FROM toc")
def _(s, d):
    return toc.within_document(A.toc(s, d), F.lit(5)).select("doc", "ord", "physical_index")


@query("p14_located", f"WITH {A.TOC} SELECT doc, ord, physical_index FROM toc WHERE physical_index IS NOT NULL")
def _(s, d):
    return toc.located(A.toc(s, d)).select("doc", "ord", "physical_index")


@query("p12_parse_tags", f"WITH {A.TOC}, t AS (SELECT doc, ord, CASE ord % 3 WHEN 0 THEN '<physical_index_' || line || '>' WHEN 1 THEN 'physical_index_' || line ELSE 'p. ' || line END AS v FROM toc) SELECT doc, ord, TRY_CAST(regexp_extract(v, '^<?physical_index_(\\d+)>?$', 1) AS INTEGER) AS n FROM t")
def _(s, d):
    v = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("<physical_index_"), "line", F.lit(">"))).when(F.col("ord") % 3 == 1, F.concat(F.lit("physical_index_"), "line")).otherwise(F.concat(F.lit("p. "), "line"))
    return A.toc(s, d).select("doc", "ord", text.parse_page_tag(v).alias("n"))


@query("p13_page_numbers", f"WITH {A.TOC} SELECT doc, ord, TRY_CAST(CASE WHEN ord % 2 = 0 THEN CAST(line AS VARCHAR) ELSE 'iv' END AS INTEGER) AS page_number FROM toc")
def _(s, d):
    return toc.parsed_pages(A.toc(s, d).withColumn("page", F.when(F.col("ord") % 2 == 0, F.col("line").cast("string")).otherwise("iv"))).select("doc", "ord", "page_number")


_PAIRS = f"{A.TOC}, pairs AS (SELECT f.doc, f.ord, f.title, p.line AS page, f.physical_index FROM toc f JOIN toc p ON p.doc = f.doc AND p.title IS NOT DISTINCT FROM f.title WHERE f.physical_index >= 2)"
_OFFSET = "c AS (SELECT doc, physical_index - page AS o, count(*) AS n, min(ord) AS first FROM pairs GROUP BY 1, 2), o AS (SELECT doc, o AS \"offset\" FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n DESC, first, o) AS k FROM c) WHERE k = 1)"


def _pairs(s, d) -> DataFrame:
    t = A.toc(s, d)
    return toc.matching_pairs(t.select("doc", "title", F.col("line").alias("page")), t, 2)


@query("j1_title_pairs", f"WITH {_PAIRS} SELECT doc, title, page, physical_index, ord FROM pairs")
def _(s, d):
    return _pairs(s, d)


@query("a7_page_offset", f"WITH {_PAIRS}, c AS (SELECT doc, physical_index - page AS o, count(*) AS n, min(ord * 1000 + page) AS first FROM pairs GROUP BY 1, 2) SELECT doc, o AS \"offset\" FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n DESC, first) AS k FROM c) WHERE k = 1")
def _(s, d):
    return toc.page_offset(_pairs(s, d).withColumn("ord", F.col("ord") * 1000 + F.col("page")))


@query("h13_apply_offset", f"WITH {_PAIRS}, c AS (SELECT doc, physical_index - page AS o, count(*) AS n, min(ord * 1000 + page) AS first FROM pairs GROUP BY 1, 2), b AS (SELECT doc, o FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n DESC, first) AS k FROM c) WHERE k = 1) SELECT doc, ord, coalesce(line + o, physical_index) AS physical_index FROM toc LEFT JOIN b USING (doc)")
def _(s, d):
    o = toc.page_offset(_pairs(s, d).withColumn("ord", F.col("ord") * 1000 + F.col("page")))
    return toc.with_offset(A.toc(s, d).withColumn("page_number", F.col("line")), o).select("doc", "ord", "physical_index")


@query("j9_anchors", f"WITH {A.TOC} SELECT doc, ord, coalesce(last_value(physical_index IGNORE NULLS) OVER (PARTITION BY doc ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_index, coalesce(first_value(physical_index IGNORE NULLS) OVER (PARTITION BY doc ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), -1) AS next_index FROM toc")
def _(s, d):
    return toc.anchors(A.toc(s, d), F.lit(0), F.lit(-1)).select("doc", "ord", "prev_index", "next_index")


@query("j8_corrections", f"WITH {A.TOC} SELECT doc, ord, CASE WHEN appear_start = 'yes' AND ord % 2 = 0 THEN line + 100 ELSE physical_index END AS physical_index FROM toc")
def _(s, d):
    t = A.toc(s, d)
    return toc.corrected(t, t.where("appear_start = 'yes'"), t.where("ord % 2 = 0").select("doc", "ord", (F.col("line") + 100).alias("fixed"))).select("doc", "ord", "physical_index")


@query("a8_accuracy", f"WITH {A.TOC}, g AS (SELECT doc, avg(CASE WHEN appear_start = 'yes' THEN 1.0 ELSE 0.0 END) FILTER (WHERE physical_index IS NOT NULL) AS a, arg_max(physical_index, ord) FILTER (WHERE physical_index IS NOT NULL) AS last FROM toc GROUP BY doc) SELECT doc, round(CASE WHEN last IS NULL OR last < 4 THEN 0.0 ELSE a END, 9) AS accuracy FROM g")
def _(s, d):
    return toc.accuracy(A.toc(s, d).select("doc", "ord", F.col("appear_start").alias("answer"), "physical_index", F.lit(8).alias("slice_pages"))).withColumn("accuracy", F.round("accuracy", 9))


@query("h12_decision", f"WITH {A.TOC}, g AS (SELECT doc, avg(CASE WHEN appear_start = 'yes' THEN 1.0 ELSE 0.0 END) AS a, count(*) % 5 AS rounds, count(*) FILTER (WHERE physical_index IS NULL) AS errors FROM toc GROUP BY doc) SELECT doc, CASE WHEN a = 1 AND errors = 0 THEN 'keep' WHEN a > 0.6 AND rounds < 3 THEN 'fix' ELSE 'next' END AS decision FROM g")
def _(s, d):
    g = A.toc(s, d).groupBy("doc").agg(F.avg((F.col("appear_start") == "yes").cast("double")).alias("a"), (F.count("*") % 5).alias("rounds"), F.count_if(F.col("physical_index").isNull()).alias("errors"))
    return g.select("doc", toc.decision(F.col("a"), F.col("errors"), F.col("rounds")).alias("decision"))


@query("w9_toc_pages", f"WITH {A.TOC}, b AS (SELECT doc, ord, appear_start AS f, max(CASE WHEN appear_start = 'yes' AND ord < 4 THEN 1 ELSE 0 END) OVER w AS began FROM toc WINDOW w AS (PARTITION BY doc ORDER BY ord ROWS UNBOUNDED PRECEDING)), z AS (SELECT *, max(CASE WHEN began = 1 AND f = 'no' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS stopped FROM b) SELECT doc, ord AS page_idx FROM z WHERE f = 'yes' AND began = 1 AND stopped = 0")
def _(s, d):
    return toc.toc_pages(A.toc(s, d).select("doc", F.col("ord").alias("page_idx"), F.col("appear_start").alias("flag")), 4)


@query("h11_strategy", f"WITH {A.TOC} SELECT doc, CASE WHEN NOT bool_or(appear_start = 'yes') THEN 'none' WHEN bool_or(physical_index IS NOT NULL) THEN 'with_pages' ELSE 'without_pages' END AS strategy FROM toc GROUP BY doc")
def _(s, d):
    g = A.toc(s, d).groupBy("doc").agg(F.bool_or(F.col("appear_start") == "yes").alias("a"), F.bool_or(F.col("physical_index").isNotNull()).alias("b"))
    return g.select("doc", toc.strategy(F.col("a"), F.col("b")).alias("strategy"))


@query("l4_search_limit", "SELECT doc_id AS doc, CAST(least(20, greatest(3, floor(n_chars / 300))) AS INTEGER) AS pages FROM documents")
def _(s, d):
    return A.table(s, d, "documents").select(F.col("doc_id").alias("doc"), toc.search_limit(20, F.col("n_chars") / 100).cast("int").alias("pages"))


@query("w8_page_groups", f"""WITH RECURSIVE {A.PAGES}, p AS (SELECT doc, list(len(regexp_extract_all(text, '[A-Za-z0-9]{{1,4}}|[^\\sA-Za-z0-9]')) + 15 ORDER BY page_idx) AS t FROM pages_ GROUP BY doc),
c AS (SELECT doc, t, CASE WHEN list_sum(t) > 400 THEN ceil((list_sum(t) / ceil(list_sum(t) / 400) + 400) / 2) END AS cap FROM p),
r AS (SELECT doc, 0 AS k, t[1] AS n, 0 AS g FROM c UNION ALL SELECT r.doc, k + 1, CASE WHEN n + t[k + 2] > cap THEN t[k + 1] + t[k + 2] ELSE n + t[k + 2] END, CASE WHEN n + t[k + 2] > cap THEN g + 1 ELSE g END FROM r JOIN c USING (doc) WHERE k + 2 <= len(t))
SELECT doc, g AS grp, k AS page_idx FROM r UNION ALL SELECT a.doc, b.g, a.k FROM r AS a JOIN r AS b ON a.doc = b.doc AND b.k = a.k + 1 AND b.g > a.g""")
def _(s, d):
    return toc.page_groups(A.pages(s, d), 400, 1, text.PAGE_OVERHEAD_TOKENS)


@query("p2_likely_scanned", f"WITH {A.PAGES}, w AS (SELECT doc, list_sort(list(len(regexp_extract_all(text, '\\S+')))) AS w FROM pages_ GROUP BY doc) SELECT doc, w[len(w) // 2 + 1] < 30 AS scanned FROM w")
def _(s, d):
    return toc.likely_scanned(A.pages(s, d))


# --- text

@query("p1_token_counts", "SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9]{1,4}|[^\\sA-Za-z0-9]')) AS BIGINT) AS tokens FROM documents")
def _(s, d):
    return A.table(s, d, "documents").select("doc_id", text.count_tokens(F.col("text")).alias("tokens"))


@query("s1_text_pages", f"WITH {A.PAGES} SELECT CAST(doc AS VARCHAR) AS doc, page_idx, text, CAST(len(regexp_extract_all(text, '[A-Za-z0-9]{{1,4}}|[^\\sA-Za-z0-9]')) AS BIGINT) AS token_count FROM pages_")
def _(s, d):
    return sources.text_pages(A.table(s, d, "documents"))


@query("p8_assembled", f"WITH {A.PAGES}, c AS (SELECT doc, string_agg('<physical_index_' || (page_idx + 1) || '>' || chr(10) || text || chr(10) || '<physical_index_' || (page_idx + 1) || '>' || chr(10) || chr(10), '' ORDER BY page_idx) AS core FROM pages_ GROUP BY doc) SELECT doc, regexp_replace(regexp_replace(core, '\\.{{5,}}', ': ', 'g'), '(?:\\. ){{5,}}\\.?', ': ', 'g') AS core FROM c")
def _(s, d):
    p = A.pages(s, d).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_idx", text.wrap_page(F.col("text"), F.col("page_idx") + 1).alias("t")))).alias("p"))
    return p.select("doc", text.transform_dots(F.array_join(F.transform("p", lambda x: x["t"]), "")).alias("core"))


@query("p7_section_block", "SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS block FROM documents")
def _(s, d):
    t = text.with_context(F.lit("before"), F.col("text"), F.lit("after"))
    return A.table(s, d, "documents").select("doc_id", text.section_block(t).alias("block"))


@query("p22_slugs", "SELECT page_id, CASE WHEN s = '' THEN 'unknown' ELSE s END AS slug FROM (SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM pages)")
def _(s, d):
    return A.table(s, d, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query("p30_without_tags", "SELECT page_id, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS chunked, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS spaced FROM pages")
def _(s, d):
    return A.table(s, d, "pages").select("page_id", F.md5(text.without_tags(F.col("html"))).alias("chunked"), F.md5(text.tags_to_space(F.col("html"))).alias("spaced"))


@query("p18_yes_no", "SELECT conv_id, turn, CASE WHEN lower(trim(role)) IN ('yes', 'y', 'true', '1') THEN 'yes' ELSE 'no' END AS a, 'no' AS b, CASE WHEN turn = 1 THEN 'yes' ELSE 'no' END AS c, CASE WHEN turn IN (1, 2) THEN 'yes' ELSE 'no' END AS d FROM conversations")
def _(s, d):
    return A.table(s, d, "conversations").select("conv_id", "turn", text.yes_no(F.col("role")).alias("a"), text.yes_no(F.col("turn")).alias("b"), text.yes_no(F.col("turn") == 1).alias("c"), text.yes_no(F.when(F.col("turn") == 2, " Yes ").otherwise(F.col("turn").cast("string"))).alias("d"))


@query("p28_truncated", f"WITH {A.RESULTS} SELECT document_id, CASE WHEN length(error) > 2000 THEN substr(error, 1, 2000) || '…[+' || (length(error) - 2000) || ' more chars]' ELSE error END AS error FROM results")
def _(s, d):
    return batch.shortened(A.results(s, d)).select("document_id", "error")


@query("f1_entities", """WITH t AS (SELECT doc_id, text || ' NaPF6 in EC, 3.5 eV and hard carbon' AS x FROM documents), seeds(e) AS (VALUES ('EC'), ('PC'), ('hard carbon'), ('ionic conductivity'), ('NaPF6'), ('NASICON')),
m AS (SELECT doc_id, e FROM t, seeds WHERE contains(x, e) OR (NOT regexp_matches(e, '^[A-Z]') AND contains(lower(x), e)) UNION SELECT doc_id, trim(unnest(regexp_extract_all(x, 'Na(?:PF6|BF4|ClO4|FSI|TFSI|DFOB|BOB|FP|OTf|Tf|N\\(SO2F\\)2|N\\(CF3SO2\\)2)'))) FROM t
UNION SELECT doc_id, trim(unnest(regexp_extract_all(x, '\\d+\\.?\\d*\\s*(?:mS/cm|S/cm|mAh/g|Wh/kg|V\\s*vs\\.?\\s*Na\\+?/?Na|μS/cm|eV|GPa|MPa|kPa|mA/cm[²2]|μA/cm[²2]|mol/L|M\\b|wt\\.?%|vol\\.?%)'))) FROM t)
SELECT doc_id, bool_or(e = 'EC') AS ec, bool_or(e = 'NaPF6') AS salt, bool_or(e = '3.5 eV') AS value, bool_or(e = 'hard carbon') AS carbon, bool_or(e = 'PC') AS pc FROM m GROUP BY doc_id""")
def _(s, d):
    e = A.table(s, d, "documents").select("doc_id", text.entities(F.concat("text", F.lit(" NaPF6 in EC, 3.5 eV and hard carbon")), SEEDS).alias("e"))
    return e.select("doc_id", *(F.array_contains("e", v).alias(n) for n, v in (("ec", "EC"), ("salt", "NaPF6"), ("value", "3.5 eV"), ("carbon", "hard carbon"), ("pc", "PC"))))


@query("f2_citations", f"WITH {A.CITED} SELECT ord, regexp_matches(title, '^([A-Z]\\.\\s*){{1,3}}[A-Z][A-Za-z]+') OR regexp_matches(title, ',\\s*(19|20)\\d{{2}},\\s*\\d+,\\s*\\d+') AS cited FROM cited")
def _(s, d):
    return A.cited(s, d).select("ord", text.looks_like_citation(F.col("title")).alias("cited"))


@query("f13_element_text", "SELECT conv_id, turn, concat_ws(' ', nullif(CASE WHEN turn % 2 = 0 THEN '' ELSE text END, ''), nullif(role, '')) AS t FROM conversations")
def _(s, d):
    return A.table(s, d, "conversations").select("conv_id", "turn", text.element_text(F.when(F.col("turn") % 2 == 0, "").otherwise(F.col("text")), F.col("role")).alias("t"))


# --- elements

@query("p24_detections", f"WITH {A.BOXES} SELECT ord, label, x0 / width AS nx0, y0 / height AS ny0, x1 / width AS nx1, y1 / height AS ny1 FROM boxes WHERE label IN ('figure', 'table') AND confidence >= 0.4")
def _(s, d):
    return elements.kept_detections(A.boxes(s, d), ["figure", "table"], 0.4).select("ord", "label", "nx0", "ny0", "nx1", "ny1")


@query("p24_suppressed", f"""WITH RECURSIVE {A.BOXES}, o AS (SELECT doc, page, ord, label, confidence, x0, y0, x1, y1, row_number() OVER (PARTITION BY doc, page, label ORDER BY confidence DESC, ord) AS k FROM boxes),
i AS (SELECT b.doc, b.page, b.label, b.k, a.k AS j, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS both_, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS area FROM o AS a JOIN o AS b ON a.doc = b.doc AND a.page = b.page AND a.label = b.label AND a.k < b.k),
v AS (SELECT doc, page, label, k, list(j) AS over_ FROM i WHERE both_ > 0.3 * (area - both_) GROUP BY ALL),
r AS (SELECT doc, page, label, 1 AS k, [CAST(1 AS BIGINT)] AS kept FROM o WHERE k = 1 UNION ALL
SELECT r.doc, r.page, r.label, CAST(o.k AS INTEGER), CASE WHEN list_has_any(coalesce(over_, []), kept) THEN kept ELSE list_append(kept, o.k) END FROM r JOIN o ON o.doc = r.doc AND o.page = r.page AND o.label = r.label AND o.k = r.k + 1 LEFT JOIN v ON v.doc = o.doc AND v.page = o.page AND v.label = o.label AND v.k = o.k)
SELECT o.doc, o.page, o.ord, o.label, o.confidence, o.x0, o.y0, o.x1, o.y1 FROM o JOIN r USING (doc, page, label, k) WHERE list_contains(kept, o.k)""")
def _(s, d):
    return elements.suppressed(A.boxes(s, d).select("doc", "page", "ord", "label", "confidence", "x0", "y0", "x1", "y1"), 0.3)


@query("m2_pixel_box", f"WITH {A.BOXES} SELECT ord, CAST(trunc(x0 * 1.37) AS INTEGER) AS x0, CAST(trunc(y0 * 1.37) AS INTEGER) AS y0 FROM boxes")
def _(s, d):
    return elements.pixel_box(A.boxes(s, d), 1.37).select("ord", "x0", "y0")


_CAND = f"""{A.BOXES}, c AS (SELECT * FROM boxes WHERE label IN ('figure', 'table', 'isolate_formula')), k AS (SELECT * FROM boxes WHERE label IN ('figure_caption', 'table_caption')),
j AS (SELECT c.doc, c.page, c.ord AS content, k.ord AS caption, CASE WHEN k.y0 - c.y1 BETWEEN 0 AND 80 THEN k.y0 - c.y1 WHEN c.y0 - k.y1 BETWEEN 0 AND 80 THEN c.y0 - k.y1 END AS gap FROM c JOIN k ON k.doc = c.doc AND k.page = c.page AND abs((c.x0 + c.x1) / 2 - (k.x0 + k.x1) / 2) <= (c.x1 - c.x0) * 0.6)"""


@query("j6_caption_candidates", f"WITH {_CAND} SELECT * FROM j WHERE gap IS NOT NULL")
def _(s, d):
    return elements.caption_candidates(A.boxes(s, d))


@query("j6_caption_pairs", f"""WITH RECURSIVE {_CAND}, l AS (SELECT doc, page, content, list(caption ORDER BY gap, caption) AS near FROM j WHERE gap IS NOT NULL GROUP BY ALL),
g AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY content) AS k FROM l),
r AS (SELECT DISTINCT doc, page, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS taken, CAST(NULL AS BIGINT) AS content, CAST(NULL AS BIGINT) AS caption FROM g UNION ALL
SELECT doc, page, k, CASE WHEN free IS NULL THEN taken ELSE list_append(taken, free) END, content, free FROM (SELECT g.doc, g.page, g.k, taken, g.content, list_filter(near, lambda x: NOT list_contains(taken, x))[1] AS free FROM r JOIN g ON g.doc = r.doc AND g.page = r.page AND g.k = r.k + 1))
SELECT doc, page, content, caption FROM r WHERE caption IS NOT NULL""")
def _(s, d):
    return elements.paired_captions(A.boxes(s, d))


@query("w6_element_ids", f"WITH {A.BOXES} SELECT ord, CASE label WHEN 'figure' THEN 'fig' WHEN 'table' THEN 'tbl' WHEN 'isolate_formula' THEN 'eq' ELSE 'el' END || '_' || node_id || '_' || printf('%04d', page) || '_' || printf('%03d', row_number() OVER (PARTITION BY doc, page, label ORDER BY ord)) AS element_id FROM boxes")
def _(s, d):
    return elements.numbered(A.boxes(s, d)).select("ord", "element_id")


def _elements(s, d) -> DataFrame:
    b = A.boxes(s, d)
    return b.select("doc", F.col("page").alias("page_idx"), "ord", F.col("label").alias("element_type"), F.concat(F.lit("e"), "ord").alias("element_id"), F.when(F.col("ord") % 4 != 0, F.concat(F.lit("a/"), "ord")).alias("asset_uri"), F.when(F.col("ord") % 3 == 0, F.col("name")).alias("caption"), F.lit(None).cast("string").alias("ocr_text"))


_ELEMENTS = f"{A.BOXES}, e AS (SELECT doc, page AS page_idx, ord, label AS element_type, 'e' || ord AS element_id, CASE WHEN ord % 4 <> 0 THEN 'a/' || ord END AS asset_uri, CASE WHEN ord % 3 = 0 THEN name END AS caption, row_number() OVER (PARTITION BY doc, page ORDER BY ord) - 1 AS elem_idx FROM boxes)"


@query("p25_readable", f"WITH {_ELEMENTS} SELECT doc, page_idx, CAST(elem_idx AS INTEGER) AS elem_idx, element_id FROM e WHERE asset_uri IS NOT NULL")
def _(s, d):
    return elements.readable(_elements(s, d)).select("doc", "page_idx", "elem_idx", "element_id")


@query("a6_type_counts", f"WITH {_ELEMENTS} SELECT element_type, count(*) AS n FROM e GROUP BY element_type")
def _(s, d):
    return elements.type_counts(_elements(s, d))


@query("j5_merged_updates", f"WITH {_ELEMENTS} SELECT element_id, CASE WHEN asset_uri IS NULL THEN caption WHEN ord % 5 <> 0 THEN 'second ' || ord ELSE 'first ' || ord END AS caption FROM e")
def _(s, d):
    e = elements.readable(_elements(s, d))
    u = e.select("doc", "page_idx", "elem_idx", "element_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"), F.col("ord").alias("o"))
    u = u.select("doc", "page_idx", "elem_idx", "element_id", F.col("k").alias("ord"), F.when(F.col("k") == 1, F.concat(F.lit("first "), "o")).when(F.col("o") % 5 != 0, F.concat(F.lit("second "), "o")).alias("caption"))
    rest = _elements(s, d).where("asset_uri is null").select("element_id", "caption")
    return elements.merged_updates(e, u, ["caption"]).select("element_id", "caption").unionByName(rest)


@query("h9_assigned", f"WITH {_ELEMENTS} SELECT element_id, CASE WHEN page_idx = 2 THEN 'b' WHEN page_idx IN (1, 3) THEN 'a' END AS key FROM e WHERE page_idx BETWEEN 1 AND 3")
def _(s, d):
    e = _elements(s, d).withColumnRenamed("page_idx", "page")
    n = e.select("doc").distinct().select("doc", F.explode(F.array(F.struct(F.lit("a").alias("key"), F.lit(0).alias("dfs"), F.lit(1).alias("start_index"), F.lit(3).alias("end_index")), F.struct(F.lit("b").alias("key"), F.lit(1).alias("dfs"), F.lit(2).alias("start_index"), F.lit(2).alias("end_index")))).alias("x")).select("doc", "x.*")
    return elements.assigned(e, trees.page_owner(n)).select("element_id", "key")


@query("a26_figure_blocks", f"WITH {_ELEMENTS} SELECT doc, 'k' AS key, string_agg('- ' || element_id || ' (' || element_type || ', p.' || page_idx || ')' || coalesce(' caption: ' || caption, ''), chr(10) ORDER BY page_idx, ord) AS block FROM e GROUP BY doc")
def _(s, d):
    e = _elements(s, d).withColumnRenamed("page_idx", "page").withColumns({"key": F.lit("k"), "chem_entities": F.array().cast("array<string>")})
    return elements.figure_blocks(e)


@query("f4_table_markdown", r"""WITH l AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS x FROM pages),
t AS (SELECT page_id, list_transform(x, lambda c: replace(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(c, '(?i)<br[^>]*>', ' ', 'g'), '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&'), '[\s\x{00a0}]+', ' ', 'g')), '|', '\|')) AS c FROM l)
SELECT page_id, CASE WHEN len(c) = 0 THEN '' ELSE '| ' || c[1] || ' |' || chr(10) || '| --- |' || array_to_string(list_transform(c[2:], lambda x: chr(10) || '| ' || x || ' |'), '') END AS md FROM t""")
def _(s, d):
    # the pages hold lists but no tables: each list item becomes a row of one cell
    row = F.regexp_replace(F.regexp_replace("html", "<li>", "<tr><td>"), "</li>", "</td></tr>")
    return A.table(s, d, "pages").select("page_id", elements.table_markdown(row).alias("md"))


@query("f5_vision_parse")
def _(s, d):
    scratch.small_batches(s)
    return A.table(s, d, "pages").select("page_id", elements.vision_json(F.concat(F.lit('<div data-label="Text" data-bbox="1 2 3 4">'), "html", F.lit("</div>"))).alias("parsed"))


# --- chunks and index

def _units(s, d) -> DataFrame:
    docs = A.table(s, d, "documents").select(F.col("doc_id").cast("string").alias("paper"), "text")
    papers = docs.select("paper", F.when(F.col("paper").cast("long") % 2 == 0, F.substring("text", 1, 80)).alias("abstract"), F.lit(2).alias("total_pages"))
    leaves = docs.select("paper", F.lit("0000").alias("node_id"), F.lit("Body").alias("title"), F.array(F.lit("Body")).alias("breadcrumb"), F.lit(1).alias("start_index"), F.lit(2).alias("end_index"), F.col("text").alias("raw_text"))
    e = docs.where(F.col("paper").cast("long") % 3 == 0).select("paper", F.lit("0000").alias("node_id"), F.lit(0).alias("ord"), F.lit("tbl_1").alias("element_id"), F.lit("table").alias("element_type"), F.lit(2).alias("page_index"), F.lit("<b>| a |</b>").alias("structured_data"), F.concat(F.lit("Table "), "paper").alias("caption"))
    return chunks.units(papers, leaves, e)


@query("c1_chunk_units", """WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS paper, doc_id, text FROM documents)
SELECT paper, 'abstract' AS node_id, 'Abstract' AS node_title, 1 AS page_start, 2 AS page_end, 'abstract' AS kind, substr(text, 1, 80) AS text FROM p WHERE doc_id % 2 = 0 AND substr(text, 1, 80) <> ''
UNION ALL SELECT paper, '0000', 'Body', 1, 2, 'section_text', text FROM p WHERE trim(text) <> '' UNION ALL SELECT paper, '0000:tbl_1', 'Table ' || paper, 2, 2, 'table', '| a |' FROM p WHERE doc_id % 3 = 0
UNION ALL SELECT paper, '0000:tbl_1', 'Caption for table on p.2', 2, 2, 'caption', 'Table ' || paper FROM p WHERE doc_id % 3 = 0""")
def _(s, d):
    return _units(s, d).select("paper", "node_id", "node_title", "page_start", "page_end", "kind", "text")


@query("c2_chunks")
def _(s, d):
    return chunks.chunk(_units(s, d)).select("doc_id", "paper", "node_id", "sub_index", "position", "kind", "depth", "page_start", "page_end", "token_count", "text")


@query("a22_chunk_totals")
def _(s, d):
    return chunks.totals(chunks.chunk(_units(s, d)))


@query("c3_chunk_ids", "SELECT conv_id, turn, conv_id || ':' || role || ':' || turn AS id FROM conversations")
def _(s, d):
    return A.table(s, d, "conversations").select("conv_id", "turn", ids.chunk_id(F.col("conv_id").cast("string"), F.col("role"), F.col("turn")).alias("id"))


_TERMS = "w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents), x AS (SELECT doc_id, len(w) AS length, unnest(w) AS term FROM w), c AS (SELECT doc_id, term, count(*) AS n, CAST(any_value(length) AS INTEGER) AS length FROM x GROUP BY doc_id, term)"


@query("c6_term_weights", f"WITH {_TERMS} SELECT doc_id, term, n, length, round(n * 2.2 / (n + 1.2 * (1 - 0.75 + 0.75 * length / 256.0)), 9) AS weight FROM c")
def _(s, d):
    return index.term_weights(index.terms(A.table(s, d, "documents"))).withColumn("weight", F.round("weight", 9))


@query("c7_document_frequency", f"WITH {_TERMS}, t AS (SELECT count(DISTINCT doc_id) AS total FROM c) SELECT term, count(*) AS df, round(ln(1 + (any_value(total) - count(*) + 0.5) / (count(*) + 0.5)), 9) AS idf FROM c, t GROUP BY term")
def _(s, d):
    return index.document_frequency(index.terms(A.table(s, d, "documents"))).withColumn("idf", F.round("idf", 9))


@query("c8_cosine", "WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)) SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(q.e AS DOUBLE[])), 6) AS cosine FROM embeddings, q")
def _(s, d):
    e = A.table(s, d, "embeddings")
    q = e.agg(F.min_by("embedding", "vec_id").alias("e"))
    return e.join(F.broadcast(q)).select("vec_id", F.round(index.cosine(F.col("embedding"), F.col("e")), 6).alias("cosine"))


@query("m4_point_ids", "SELECT conv_id, turn, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST((position(substr(h, 17, 1) IN '0123456789abcdef') - 1) % 4 + 1 AS INTEGER), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM (SELECT conv_id, turn, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(conv_id || ':' || turn)) AS h FROM conversations)")
def _(s, d):
    return A.table(s, d, "conversations").select("conv_id", "turn", ids.uuid5(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("id"))


@query("j7_zip", "SELECT CAST(label AS VARCHAR) AS paper, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS position, vec_id, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings WHERE label IS NOT NULL")
def _(s, d):
    from pyspark.sql import Window as W

    e = A.table(s, d, "embeddings").where("label is not null").select(F.col("label").cast("string").alias("paper"), (F.row_number().over(W.partitionBy("label").orderBy("vec_id")) - 1).cast("long").alias("position"), "vec_id", "embedding")
    return index.zipped(e.select("paper", "position", "vec_id"), e.select("paper", "position", "embedding"), e.select("paper", "position", F.lit(1).alias("sparse"))).select("paper", "position", "vec_id", F.size("embedding").alias("dim"))


@query("s6_checked_vectors", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings")
def _(s, d):
    return index.checked(A.table(s, d, "embeddings"), 64).select("vec_id", F.size("embedding").alias("dim"))


#: A number rounded to 11 significant bits, ties to even, as 16-bit floats do (their subnormal steps included).
_HALF = "CASE WHEN x = 0 THEN 0.0 ELSE round_even(x / pow(2, greatest(floor(log2(abs(x))), -14) - 10), 0) * pow(2, greatest(floor(log2(abs(x))), -14) - 10) END"
_HALVES = f"CAST(list_transform(CAST(embedding AS DOUBLE[]), lambda x: {_HALF}) AS FLOAT[])"


@query("m5_half_precision", f"SELECT vec_id, {_HALVES} AS embedding FROM embeddings")
def _(s, d):
    return A.table(s, d, "embeddings").select("vec_id", index.half_precision("embedding").alias("embedding"))


@query("p27_payload", """SELECT CAST(conv_id AS VARCHAR) || ':' || turn AS doc_id, '{"doc_id":"' || conv_id || ':' || turn || '","role":"' || role || '","breadcrumb":["a","' || role || '"],"breadcrumb_text":"a > ' || role || '"}' AS payload FROM conversations""")
def _(s, d):
    c = A.table(s, d, "conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"), "role", F.lit(None).cast("string").alias("caption"), F.array(F.lit("a"), "role").alias("breadcrumb"))
    return index.payload(c)


@query("k5_chunk_json", """SELECT CAST(conv_id AS VARCHAR) AS doc_id, '{"doc_id":"' || conv_id || '","turn":' || turn || '}' AS json FROM conversations""")
def _(s, d):
    return sinks.chunk_json(A.table(s, d, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), "turn", F.lit(None).cast("string").alias("abstract")))


@query("k4_nested_trees", f"{_WALK}, s AS (SELECT m.doc, m.ord, '{{\"title\":\"' || m.title || '\",\"node_id\":\"' || m.node_id || '\",\"nodes\":[' || string_agg('{{\"title\":\"' || l.title || '\",\"node_id\":\"' || l.node_id || '\"}}', ',' ORDER BY l.ord) || ']}}' AS j FROM n m JOIN n l ON l.doc = m.doc AND l.parent_ord = m.ord WHERE m.depth = 2 GROUP BY m.doc, m.ord, m.title, m.node_id UNION ALL SELECT doc, ord, '{{\"title\":\"' || title || '\",\"node_id\":\"' || node_id || '\"}}' FROM n m WHERE depth = 2 AND NOT EXISTS (SELECT 1 FROM n l WHERE l.doc = m.doc AND l.parent_ord = m.ord)) SELECT r.doc, '[{{\"title\":\"' || r.title || '\",\"node_id\":\"' || r.node_id || '\",\"nodes\":[' || string_agg(s.j, ',' ORDER BY s.ord) || ']}}]' AS tree FROM n r JOIN s ON s.doc = r.doc WHERE r.depth = 1 GROUP BY r.doc, r.title, r.node_id")
def _(s, d):
    n = trees.preorder(A.places(s, d)).withColumns({"start_index": F.lit(None).cast("int"), "end_index": F.lit(None).cast("int")})
    return sinks.nested_trees(n)


# --- run history

def _stat(value: str) -> str:
    return f"count({value}) AS n, max({value}) AS max, round(quantile_cont({value}, 0.5), 6) AS p50, round(quantile_cont({value}, 0.95), 6) AS p95, round(quantile_cont({value}, 0.99), 6) AS p99"


def _flat(c: str) -> list:
    return [F.coalesce(f"{c}.count", F.lit(0)).cast("long").alias("n"), F.col(f"{c}.max").alias("max"), *(F.round(f"{c}.{p}", 6).alias(p) for p in ("p50", "p95", "p99"))]


_SECONDS = "(epoch_us({b}) - epoch_us({a})) / 1e6"


@query("a10_workflow_stats", f"WITH {A.WORKFLOWS} SELECT type, count(*) AS count, count(*) FILTER (WHERE status = 'COMPLETED') AS success_count, count(*) FILTER (WHERE status = 'FAILED') AS failure_count, count(*) FILTER (WHERE status NOT IN ('COMPLETED', 'FAILED')) AS other_count, {_stat(_SECONDS.format(a='started_at', b='closed_at'))} FROM workflows GROUP BY type")
def _(s, d):
    return history.workflow_stats(A.workflows(s, d)).select("type", "count", "success_count", "failure_count", "other_count", *_flat("duration"))


@query("s14_folded_history", f"WITH {A.ACTIVITIES} SELECT workflow_id, scheduled_id, activity_type, attempts, outcome, CAST(epoch_us(closed_at) AS BIGINT) AS closed_us FROM activities")
def _(s, d):
    return history.folded(A.run_events(s, d)).select("workflow_id", "scheduled_id", "activity_type", "attempts", "outcome", F.unix_micros("closed_at").alias("closed_us"))


@query("a11_activity_stats", f"WITH {A.ACTIVITIES} SELECT activity_type, count(*) AS count, count(*) FILTER (WHERE outcome = 'success') AS success_count, count(*) FILTER (WHERE outcome IN ('failure', 'timed_out')) AS failure_count, CAST(sum(greatest(attempts - 1, 0)) AS BIGINT) AS retry_count, {_stat(_SECONDS.format(a='scheduled_at', b='closed_at'))} FROM activities GROUP BY activity_type")
def _(s, d):
    return history.activity_stats(history.folded(A.run_events(s, d))).select("activity_type", "count", "success_count", "failure_count", "retry_count", *_flat("schedule_to_close"))


@query("s12_subtree", f"WITH {A.WORKFLOWS} SELECT workflow_id, type FROM workflows WHERE workflow_id = 20 OR parent_id = 20")
def _(s, d):
    w = A.workflows(s, d)
    return history.subtree(w.withColumn("workflow_id", F.col("workflow_id")), 20).select("workflow_id", "type")


@query("s13_closed_between", f"WITH {A.WORKFLOWS}, b AS (SELECT min(closed_at) AS lo FROM workflows) SELECT workflow_id FROM workflows, b WHERE type = 'ProcessPdfWorkflow' AND closed_at BETWEEN lo AND lo + INTERVAL 5 DAY")
def _(s, d):
    w = A.workflows(s, d)
    lo = w.agg(F.min("closed_at")).first()[0]
    return history.closed_between(w, history.ITEM_TYPE, F.lit(lo), F.lit(lo) + F.expr("INTERVAL 5 DAYS")).select("workflow_id")


@query("a18_items", f"WITH {A.WORKFLOWS} SELECT count(*) AS items, count(*) FILTER (WHERE status = 'COMPLETED') AS succeeded, count(*) FILTER (WHERE status <> 'COMPLETED') AS failed FROM workflows WHERE type = 'ProcessPdfWorkflow'")
def _(s, d):
    return history.items(history.workflow_stats(A.workflows(s, d)))


@query("a19_batch_window", f"WITH {A.WORKFLOWS} SELECT CAST(epoch_us(started_at) AS BIGINT) AS started_us, status FROM workflows WHERE workflow_id = 20")
def _(s, d):
    return history.batch_window(A.workflows(s, d), 20).select(F.unix_micros("started_at").alias("started_us"), "status")


@query("q4_flags", f"WITH {A.ACTIVITIES}, g AS (SELECT activity_type AS a, count(*) AS n, count(*) FILTER (WHERE outcome IN ('failure', 'timed_out')) AS f, CAST(sum(greatest(attempts - 1, 0)) AS BIGINT) AS r FROM activities GROUP BY 1), {A.WORKFLOWS}, w AS (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'FAILED') AS f FROM workflows WHERE type = 'ProcessPdfWorkflow'), {A.METRICS}, h AS (SELECT CAST(instance AS VARCHAR) AS i, quantile_cont(value, 0.95) AS p95, max(value) AS m FROM metrics GROUP BY 1) SELECT a AS subject, 'Activity ' || a || ': ' || f || '/' || n || ' terminal failures' AS flag FROM g WHERE f > 0 UNION ALL SELECT a, 'Activity ' || a || ': ' || r || ' total retries across ' || n || ' invocations' FROM g WHERE r > 0 UNION ALL SELECT 'ProcessPdfWorkflow', f || '/' || n || ' ProcessPdfWorkflow runs failed' FROM w WHERE f > 0 UNION ALL SELECT i, 'Instance ' || i || ': CPU p95=' || CAST(round(p95) AS BIGINT) || '% — saturated' FROM h WHERE p95 > 95 UNION ALL SELECT i, 'Instance ' || i || ': memory max=' || CAST(round(m) AS BIGINT) || '% — near limit' FROM h WHERE m > 90")
def _(s, d):
    a = history.activity_stats(history.folded(A.run_events(s, d)))
    h = A.metrics(s, d).groupBy(F.col("instance").cast("string").alias("instance")).agg(intervals.stat_summary(F.col("value")).alias("cpu"), intervals.stat_summary(F.col("value")).alias("memory"))
    return history.flags(a.withColumn("start_to_close", F.lit(None).cast(a.schema["start_to_close"].dataType)), history.workflow_stats(A.workflows(s, d)), h)


@query("j11_compared", f"WITH {A.WORKFLOWS}, l AS (SELECT type, avg(workflow_id) AS v FROM workflows WHERE workflow_id % 2 = 0 GROUP BY 1), b AS (SELECT type, avg(workflow_id) AS v FROM workflows WHERE workflow_id % 2 = 1 GROUP BY 1) SELECT coalesce(l.type, b.type) AS type, round(coalesce(l.v, 0), 6) AS live, round(coalesce(b.v, 0), 6) AS batch, round(coalesce(l.v, 0) - coalesce(b.v, 0), 6) AS delta, coalesce(b.v, 0) = 0 AS no_ratio FROM l FULL JOIN b ON l.type = b.type")
def _(s, d):
    side = lambda k: A.workflows(s, d).where(f"workflow_id % 2 = {k}").groupBy("type").agg(F.avg("workflow_id").alias("v"))
    c = history.compared(side(0), side(1), "type", "v")
    return c.select("type", *(F.round(x, 6).alias(x) for x in ("live", "batch", "delta")), F.isnan("ratio").alias("no_ratio"))


@query("a20_rates", f"WITH {A.WORKFLOWS} SELECT type, count(*) / (max(epoch_us(started_at)) - min(epoch_us(started_at))) * 3600e6 AS per_hour, count(*) FILTER (WHERE status = 'FAILED') / count(*) AS error_rate FROM workflows GROUP BY type")
def _(s, d):
    g = A.workflows(s, d).groupBy("type").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "FAILED").alias("f"), ((F.max(F.unix_micros("started_at")) - F.min(F.unix_micros("started_at"))) / 1e6).alias("span"))
    return g.select("type", history.per_hour(F.col("n"), F.col("span")).alias("per_hour"), history.rate(F.col("f"), F.col("n")).alias("error_rate"))


# --- hosts

@query("a12_host_summaries", f"WITH {A.METRICS} SELECT instance, metric, {_stat('value')} FROM metrics GROUP BY instance, metric")
def _(s, d):
    return hosts.summaries(A.metrics(s, d)).select("instance", "metric", *_flat("summary"))


@query("a14_throughput", f"WITH {A.METRICS}, a AS (SELECT instance, ts, sum(value) AS v FROM metrics WHERE interface <> 'lo' GROUP BY 1, 2) SELECT instance, {_stat('v')} FROM a GROUP BY instance")
def _(s, d):
    return hosts.throughput(A.metrics(s, d)).select("instance", *_flat("summary"))


@query("a15_seen", f"WITH {A.METRICS} SELECT instance, min(ts) AS first_seen, max(ts) AS last_seen FROM metrics GROUP BY instance")
def _(s, d):
    return hosts.seen(A.metrics(s, d)).select("instance", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"), F.col("last_seen").cast("timestamp_ntz").alias("last_seen"))


@query("a16_last_value", f"WITH {A.METRICS} SELECT instance, metric, arg_max(value, ts) AS value FROM metrics GROUP BY instance, metric")
def _(s, d):
    return hosts.last_value(A.metrics(s, d))


@query("a17_average_p95", f"WITH {A.METRICS}, p AS (SELECT instance, metric, quantile_cont(value, 0.95) AS p FROM metrics GROUP BY 1, 2) SELECT metric, round(avg(p), 3) AS avg_p95 FROM p GROUP BY metric")
def _(s, d):
    return hosts.average_p95(hosts.summaries(A.metrics(s, d))).withColumn("avg_p95", F.round("avg_p95", 3))


@query("s15_sampled", f"WITH {A.METRICS} SELECT instance, metric, time_bucket(INTERVAL 1 HOUR, ts) AS ts, round(avg(value), 6) AS value FROM metrics GROUP BY 1, 2, 3")
def _(s, d):
    return hosts.sampled(A.metrics(s, d), 3600).select("instance", "metric", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("value", 6).alias("value"))


@query("s15_rates", f"WITH {A.METRICS}, g AS (SELECT instance, metric, interface, ts, sum(value) AS value FROM metrics GROUP BY ALL), r AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt, value - lag(value) OVER w AS dv FROM g WINDOW w AS (PARTITION BY instance, metric, interface ORDER BY ts)) SELECT instance, metric, interface, ts, round(dv / dt, 9) AS rate FROM r WHERE dt > 0")
def _(s, d):
    m = A.metrics(s, d).groupBy("instance", "metric", "interface", "ts").agg(F.sum("value").alias("value"))
    return hosts.rates(m).select("instance", "metric", "interface", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("rate", 9).alias("rate"))


@query("s16_interfaces", f"WITH {A.METRICS} SELECT DISTINCT instance, interface FROM metrics WHERE interface <> 'lo'")
def _(s, d):
    return hosts.interfaces(A.metrics(s, d))


@query("d3_periods", "SELECT event_id, CASE WHEN user_id % 100 <= 15 THEN 60 WHEN user_id % 100 <= 63 THEN 300 ELSE 3600 END AS period FROM events")
def _(s, d):
    return A.table(s, d, "events").select("event_id", hosts.period(F.col("user_id") % 100).alias("period"))


@query("d4_padded", f"WITH {A.METRICS}, t AS (SELECT instance, min(ts) AS a, max(ts) AS b FROM metrics GROUP BY 1) SELECT instance, a - INTERVAL 60 SECOND AS a, b + INTERVAL 120 SECOND AS b FROM t")
def _(s, d):
    a, b = hosts.padded(F.col("first_seen"), F.col("last_seen"))
    return hosts.seen(A.metrics(s, d)).select("instance", a.cast("timestamp_ntz").alias("a"), b.cast("timestamp_ntz").alias("b"))


# --- batches

@query("w10_shards", "SELECT document_id, shard, 'b-shard-' || printf('%04d', shard) AS shard_id FROM (SELECT 'doc-' || o_orderkey AS document_id, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 50) AS BIGINT) AS shard FROM orders)")
def _(s, d):
    return batch.sharded(A.results(s, d).select("item_ord", "document_id"), "b").select("document_id", "shard", "shard_id")


@query("a9_counts", f"WITH {A.RESULTS} SELECT shard, count(*) FILTER (WHERE status = 'success') AS succeeded, count(*) FILTER (WHERE status <> 'success') AS failed FROM results GROUP BY ROLLUP (shard)")
def _(s, d):
    return batch.counts(A.results(s, d))


@query("p21_manifest_errors", "SELECT item_ord, document_id, CASE WHEN coalesce(document_id, '') = '' THEN 'empty id' WHEN NOT regexp_matches(document_id, '^[A-Za-z0-9_-]+$') THEN 'bad id' WHEN n > 1 THEN 'repeated id' END AS error FROM (SELECT *, count(*) OVER (PARTITION BY document_id) AS n FROM (SELECT c_custkey AS item_ord, CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN 'a/b' WHEN c_custkey % 23 = 0 THEN 'same' ELSE 'c' || c_custkey END AS document_id FROM customer)) WHERE coalesce(document_id, '') = '' OR NOT regexp_matches(document_id, '^[A-Za-z0-9_-]+$') OR n > 1")
def _(s, d):
    k = F.col("c_custkey")
    return batch.manifest_errors(A.table(s, d, "customer").select(k.alias("item_ord"), F.when(k % 17 == 0, "").when(k % 19 == 0, "a/b").when(k % 23 == 0, "same").otherwise(F.concat(F.lit("c"), k)).alias("document_id")))


@query("o3_failed_shards", f"WITH {A.RESULTS} SELECT item_ord, document_id, shard, CASE WHEN shard % 5 = 0 OR item_ord % 7 = 0 THEN 'failure' ELSE status END AS status, CASE WHEN shard % 5 = 0 THEN 'shard-level failure: lost ' || shard WHEN item_ord % 7 = 0 THEN 'no result' ELSE error END AS error FROM results")
def _(s, d):
    r = A.results(s, d)
    failed = r.where("shard % 5 = 0").select("shard", F.concat(F.lit("lost "), "shard").alias("error")).distinct()
    return batch.with_failed_shards(r, r.where("item_ord % 7 <> 0"), failed)


@query("t4_pending", "SELECT DISTINCT event_type || '-' || user_id AS name FROM events WHERE event_type <> 'click' EXCEPT SELECT event_type || '-' || user_id FROM events WHERE event_id % 2 = 0")
def _(s, d):
    e = A.table(s, d, "events").select("event_type", "event_id", F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("name"))
    return batch.pending(e.where("event_type <> 'click'"), e.where("event_id % 2 = 0"))


@query("l7_preview", "SELECT o_orderkey AS item_ord, 'doc-' || o_orderkey AS document_id FROM orders ORDER BY o_orderkey LIMIT 5")
def _(s, d):
    return batch.preview(A.results(s, d).select("item_ord", "document_id"))


@query("j15_source_images", "WITH n AS (SELECT DISTINCT 'doc' || (p_partkey % 10) AS pdf, CAST(p_partkey % 40 AS INTEGER) AS page, 'img' || (p_partkey % 3) AS image FROM part) SELECT pdf, page, image, CASE WHEN page % 3 = 0 THEN 'r/' || pdf || '/' || page || '/doclayout_yolo/figures/' || image || '.png' WHEN page % 3 = 1 THEN 'r/' || pdf || '/' || page || '/doclayout_yolo/figures/' || image || '.jpg' END AS source FROM n")
def _(s, d):
    k = F.col("p_partkey")
    n = A.table(s, d, "part").select(F.concat(F.lit("doc"), k % 10).alias("pdf"), (k % 40).cast("int").alias("page"), F.concat(F.lit("img"), k % 3).alias("image")).distinct()
    at = F.concat(F.lit("r/"), "pdf", F.lit("/"), "page", F.lit("/doclayout_yolo/figures/"), "image")
    files = n.where("page % 3 = 0").select(F.explode(F.array(F.concat(at, F.lit(".png")), F.concat(at, F.lit(".jpg")))).alias("path")).unionByName(n.where("page % 3 = 1").select(F.concat(at, F.lit(".jpg")).alias("path")))
    return sources.source_images(n, files, "r")


@query("p26_indexable", f"WITH {A.RESULTS} SELECT document_id, tree_path FROM results WHERE status = 'success' AND coalesce(tree_path, '') <> ''")
def _(s, d):
    return batch.indexable(A.results(s, d)).select("document_id", "tree_path")


@query("p23_tree_ids", f"WITH {A.RESULTS} SELECT document_id, coalesce(regexp_extract(tree_path, '([^/]+)/tree\\.json$', 1), '') AS tree FROM results")
def _(s, d):
    return A.results(s, d).select("document_id", F.coalesce(text.tree_id(F.col("tree_path")), F.lit("")).alias("tree"))


@query("p29_report_rows", f"WITH {A.RESULTS} SELECT CAST(item_ord AS VARCHAR) AS item_ord, document_id, CAST(shard AS VARCHAR) AS shard, status, coalesce(tree_path, '') AS tree_path, substr(replace(coalesce(error, ''), chr(10), ' '), 1, 500) AS error FROM results")
def _(s, d):
    return batch.report_rows(A.results(s, d))


@query("k10_failures", f"WITH {A.RESULTS} SELECT document_id, error FROM results WHERE status <> 'success'")
def _(s, d):
    return batch.failures(A.results(s, d))


@query("d2_durations", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN user_id WHEN 1 THEN user_id * 60 WHEN 2 THEN user_id * 3600 WHEN 3 THEN user_id * 86400 END AS seconds FROM events")
def _(s, d):
    unit = F.element_at(F.array(*map(F.lit, "smhdx")), (F.col("event_id") % 5 + 1).cast("int"))
    return A.table(s, d, "events").select("event_id", batch.duration(F.concat("user_id", unit)).alias("seconds"))


@query("d5_human_durations", "SELECT event_id, CASE WHEN user_id * 36 < 60 THEN printf('%.1fs', CAST(user_id * 36 AS DOUBLE)) WHEN user_id * 36 < 3600 THEN printf('%.1fm', user_id * 36 / 60) ELSE printf('%.2fh', user_id * 36 / 3600) END AS t FROM events")
def _(s, d):
    return A.table(s, d, "events").select("event_id", batch.human_duration((F.col("user_id") * 36).cast("double")).alias("t"))


@query("e9_ids", "SELECT o_orderkey, printf('b-shard-%04d', o_orderkey % 20000) AS shard_id, 'b-pdf-d' || o_orderkey AS item_id, printf('%04d', o_orderkey) AS node_id FROM orders")
def _(s, d):
    k = F.col("o_orderkey")
    return A.table(s, d, "orders").select("o_orderkey", ids.shard_id(F.lit("b"), k % 20000).alias("shard_id"), ids.item_id(F.lit("b"), F.concat(F.lit("d"), k)).alias("item_id"), ids.node_id(k).alias("node_id"))


@query("s17_result_names", "SELECT path, regexp_extract(path, '([^/]+)_p(\\d+)_(.+)_([^_/]+)_([^_/]+)\\.md$', 1) AS pdf, CAST(regexp_extract(path, '([^/]+)_p(\\d+)_(.+)_([^_/]+)_([^_/]+)\\.md$', 2) AS INTEGER) AS page, regexp_extract(path, '([^/]+)_p(\\d+)_(.+)_([^_/]+)_([^_/]+)\\.md$', 4) AS model FROM (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'x/' || p_partkey || '.txt' ELSE 'x/doc' || (p_partkey % 10) || '_p' || p_partkey || '_img_1_m' || (p_partkey % 3) || '_ocr.md' END AS path FROM part) WHERE regexp_matches(path, '([^/]+)_p(\\d+)_(.+)_([^_/]+)_([^_/]+)\\.md$')")
def _(s, d):
    k = F.col("p_partkey")
    p = F.when(k % 9 == 0, F.concat(F.lit("x/"), k, F.lit(".txt"))).otherwise(F.concat(F.lit("x/doc"), k % 10, F.lit("_p"), k, F.lit("_img_1_m"), k % 3, F.lit("_ocr.md")))
    return sources.result_names(A.table(s, d, "part").select(p.alias("path"))).select("path", "pdf", "page", "model")


@query("a28_grouped_results", "WITH n AS (SELECT 'doc' || (p_partkey % 10) AS pdf, CAST(p_partkey % 40 AS INTEGER) AS page, 'm' || (p_partkey % 3) AS model, 'ocr' || (p_partkey % 2) AS task FROM part) SELECT pdf, page, 'img' AS image, string_agg(model || ':' || task, ',' ORDER BY model, task) AS results FROM n GROUP BY pdf, page")
def _(s, d):
    k = F.col("p_partkey")
    n = A.table(s, d, "part").select(F.concat(F.lit("doc"), k % 10).alias("pdf"), (k % 40).cast("int").alias("page"), F.lit("img").alias("image"), F.concat(F.lit("m"), k % 3).alias("model"), F.concat(F.lit("ocr"), k % 2).alias("task"))
    return sources.grouped_results(n).select("pdf", "page", "image", F.array_join(F.transform("results", lambda x: F.concat(x["model"], F.lit(":"), x["task"])), ",").alias("results"))


@query("f12_render_kinds", "WITH x AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN html WHEN 1 THEN '<analyze>' || html WHEN 2 THEN html || '<analyze>[]</analyze>' WHEN 3 THEN html || ' data-label=x' WHEN 4 THEN url || ' | b' || chr(10) || 'c' ELSE url || ' | b<0x0A>' END AS h FROM pages), b AS (SELECT *, regexp_replace(replace(h, '<0x0A>', chr(10)), '^\\s+|\\s+$', '', 'g') AS t FROM x) SELECT page_id, CASE WHEN contains(substr(h, position('<analyze>' IN h)), '</analyze>') AND contains(h, '<analyze>') THEN 'analyze' WHEN contains(h, 'data-bbox=') OR contains(h, 'data-label=') THEN 'layout' WHEN contains(h, ' | ') AND (contains(h, '<0x0A>') OR contains(h, chr(10))) AND len(string_split(t, chr(10))) >= 2 THEN 'table' ELSE 'pre' END AS kind FROM b")
def _(s, d):
    n, h, u = F.col("page_id") % 6, F.col("html"), F.col("url")
    x = F.when(n == 0, h).when(n == 1, F.concat(F.lit("<analyze>"), h)).when(n == 2, F.concat(h, F.lit("<analyze>[]</analyze>"))).when(n == 3, F.concat(h, F.lit(" data-label=x"))).when(n == 4, F.concat(u, F.lit(" | b\nc"))).otherwise(F.concat(u, F.lit(" | b<0x0A>")))
    return A.table(s, d, "pages").select("page_id", text.render_kind(x).alias("kind"))


@query("d1_stamps", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS compact, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM events")
def _(s, d):
    t = F.col("ts").cast("timestamp")
    return A.table(s, d, "events").select("event_id", text.compact_stamp(t).alias("compact"), text.iso_stamp(t).alias("iso"))


@query("l3_sampled_toc")
def _(s, d):
    return toc.sampled(A.toc(s, d), 3, 7).select("doc", "ord", "title")


_TITLES = "t AS (SELECT doc_id AS doc, CAST(1 AS INTEGER) AS ord, substr(text, 1, 12) AS title, CAST(1 AS INTEGER) AS page FROM documents UNION ALL SELECT doc_id, 2, 'No Such Title Here', 2 FROM documents UNION ALL SELECT doc_id, 3, 'x', NULL FROM documents)"


def _titles(s, d) -> DataFrame:
    docs = A.table(s, d, "documents").select(F.col("doc_id").alias("doc"), "text")
    rows = F.array(F.struct(F.lit(1).alias("ord"), F.substring("text", 1, 12).alias("title"), F.lit(1).alias("physical_index")), F.struct(F.lit(2).alias("ord"), F.lit("No Such Title Here").alias("title"), F.lit(2).alias("physical_index")), F.struct(F.lit(3).alias("ord"), F.lit("x").alias("title"), F.lit(None).cast("int").alias("physical_index")))
    return docs.select("doc", F.explode(rows).alias("x")).select("doc", "x.*")


_SQUEEZE = "regexp_replace(lower({c}), '\\s+', '', 'g')"


@query("h14_title_checks", f"WITH {A.PAGES}, {_TITLES} SELECT t.doc, ord, CASE WHEN coalesce(contains({_SQUEEZE.format(c='text')}, {_SQUEEZE.format(c='title')}), false) THEN 'yes' ELSE 'no' END AS answer, CASE WHEN coalesce(starts_with({_SQUEEZE.format(c='text')}, {_SQUEEZE.format(c='title')}), false) THEN 'yes' ELSE 'no' END AS appear_start FROM t LEFT JOIN pages_ p ON p.doc = t.doc AND page_idx + 1 = page")
def _(s, d):
    return building.title_checks(_titles(s, d), A.pages(s, d)).select("doc", "ord", "answer", "appear_start")


@query("h12_repaired_toc")
def _(s, d):
    return building.repaired(_titles(s, d), A.pages(s, d)).select("doc", "ord", "title", "physical_index")


@query("e5_section_text", f"WITH {A.PAGES}, {A.RANGES}, n AS (SELECT doc, count(*) AS total FROM pages_ GROUP BY doc), r AS (SELECT ranges.*, total FROM ranges JOIN n USING (doc) WHERE key <> 'none'), x AS (SELECT r.doc, key, any_value(start_index > 1 OR end_index < total) AS around, coalesce(string_agg(text, '' ORDER BY page_idx) FILTER (WHERE page_idx BETWEEN greatest(start_index - 2, 0) AND start_index - 2), '') AS b, coalesce(string_agg(text, '' ORDER BY page_idx) FILTER (WHERE page_idx BETWEEN start_index - 1 AND end_index - 1), '') AS c, coalesce(string_agg(text, '' ORDER BY page_idx) FILTER (WHERE page_idx = end_index), '') AS a, count(*) FILTER (WHERE page_idx = start_index - 2 OR page_idx = end_index) AS near, count(p.doc) FILTER (WHERE page_idx BETWEEN start_index - 2 AND end_index) AS got FROM r LEFT JOIN pages_ p ON p.doc = r.doc GROUP BY r.doc, key) SELECT doc, key, md5(CASE WHEN got = 0 THEN '' WHEN near = 0 THEN c ELSE '<<<context-before>>>' || chr(10) || b || chr(10) || '<<<section-content>>>' || chr(10) || c || chr(10) || '<<<context-after>>>' || chr(10) || a END) AS h FROM x")
def _(s, d):
    return building.section_text(A.ranges(s, d).where("key <> 'none'"), A.pages(s, d), 1).select("doc", "key", F.md5("node_text").alias("h"))


@query("f10_assembled_toc", "SELECT conv_id, turn, role AS title, CAST(turn AS VARCHAR) AS page FROM conversations")
def _(s, d):
    item = F.concat(F.lit('[{"title":"'), "role", F.lit('","page":'), F.col("turn"), F.lit("}]"))
    body = F.when(F.col("turn") % 3 == 0, item).when(F.col("turn") % 3 == 1, F.concat(F.lit('{"contents":'), item, F.lit("}"))).otherwise(F.concat(F.lit('{"rows":'), item, F.lit("}")))
    return A.table(s, d, "conversations").select("conv_id", "turn", F.explode(answers.assembled_rows(body)).alias("r")).select("conv_id", "turn", "r.title", "r.page")


@query("p19_toc_errors", "SELECT page_id, array_to_string(list_filter([CASE WHEN length(url) NOT BETWEEN 5 AND 300 THEN 'title' END, CASE WHEN length(url) > 16 THEN 'structure' END, CASE WHEN length(url) > 32 THEN 'physical_index' END], lambda x: x IS NOT NULL), ',') AS errors FROM pages")
def _(s, d):
    return A.table(s, d, "pages").select("page_id", F.array_join(answers.toc_errors(F.col("url"), F.col("url"), F.col("url"), F.lit(None).cast("string")), ",").alias("errors"))


@query("f11_prompts", "SELECT page_id, 'Rewrite this table of contents as a JSON list of structure, title and page.' || chr(10) || url AS prompt FROM pages")
def _(s, d):
    return A.table(s, d, "pages").select("page_id", prompts.render("toc_transformer", "upstream", toc=F.col("url")).alias("prompt"))


@query("x1_model_calls", "SELECT page_id, true AS ok, CAST(1 AS INTEGER) AS attempts, 'stop' AS finish_reason FROM pages")
def _(s, d):
    return providers.call(A.table(s, d, "pages").select("page_id", F.lit("stub").alias("model"), F.col("url").alias("prompt"))).select("page_id", "ok", "attempts", "finish_reason")


@query("h15_summaries")
def _(s, d):
    n = A.ranges(s, d).where("key <> 'none'").withColumns({"title": F.col("key"), "summary": F.lit(None).cast("string")})
    return building.summarised(n, A.pages(s, d), building.Options()).select("doc", "key", "summary")


# --- charts and retrieval

_POINTS = """pt AS (SELECT o_custkey AS key, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth, o_orderstatus AS series, o_orderkey AS x, o_orderpriority AS p, o_orderkey % 2 = 1 AS odd FROM orders)"""


@query("a29_series_tables", f"""WITH {_POINTS}, c AS (SELECT key, min(CASE WHEN odd THEN nth END) AS y, min(CASE WHEN NOT odd THEN nth END) AS z FROM pt GROUP BY key),
o AS (SELECT *, min(nth) OVER (PARTITION BY key, series) AS began FROM pt), r AS (SELECT *, dense_rank() OVER (PARTITION BY key ORDER BY began) AS series_nth, row_number() OVER (PARTITION BY key, series ORDER BY nth) AS row_nth FROM o)
SELECT r.key, CASE series WHEN 'P' THEN 'data' ELSE series END AS series, CAST(series_nth AS INTEGER) AS series_nth, CAST(row_nth AS INTEGER) AS row_nth,
'x,' || CASE WHEN z IS NULL THEN 'y' WHEN y IS NULL THEN 'z' WHEN y < z THEN 'y,z' ELSE 'z,y' END AS columns,
x || ',' || CASE WHEN z IS NULL THEN p WHEN y IS NULL THEN p WHEN (y < z) = odd THEN p || ',' ELSE ',' || p END AS cells FROM r JOIN c USING (key)""")
def _(s, d):
    o = A.table(s, d, "orders")
    first = {"series": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), "panel": F.lit("a"), "x": F.col("o_orderkey")}
    odd = F.col("o_orderkey") % 2 == 1
    point = F.to_json(F.struct(*(v.alias(k) for k, v in first.items()), F.when(odd, F.col("o_orderpriority")).alias("y"), F.when(~odd, F.col("o_orderpriority")).alias("z")))
    each = o.groupBy(F.col("o_custkey").alias("key")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", point.alias("j")))), lambda x: x["j"]).alias("p"))
    head, tail = F.get("p", F.lit(0)), F.array_join(F.slice("p", 2, 1 << 30), ",")
    data = each.select("key", F.concat(F.lit("["), head, F.when(F.size("p") > 1, F.concat(F.lit(",["), tail, F.lit("]"))).otherwise(""), F.lit("]")).alias("data"))
    t = series.tables(data)
    return t.select("key", "series", "series_nth", "row_nth", F.array_join("columns", ",").alias("columns"), F.array_join("cells", ",").alias("cells"))


@query("c9_hybrid_retrieval", """WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents), t AS (SELECT doc_id, len(w) AS length, unnest(w) AS term FROM w),
n AS (SELECT doc_id, term, count(*) AS n, first(length) AS length FROM t GROUP BY doc_id, term), total AS (SELECT count(DISTINCT doc_id) AS total FROM n),
idf AS (SELECT term, ln(1 + (total - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM n, total GROUP BY term, total), q AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
lex AS (SELECT a.doc_id AS query_id, b.doc_id AS id, round(sum(b.n * 2.2 / (b.n + 1.2 * (0.25 + 0.75 * b.length / 256.0)) * a.n * idf), 6) AS score FROM n AS a JOIN n AS b USING (term) JOIN idf USING (term) WHERE a.doc_id % 20 = 0 AND a.doc_id IN (SELECT id FROM q) GROUP BY 1, 2),
den AS (SELECT a.id AS query_id, b.id AS id, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM q AS a, q AS b WHERE a.id % 20 = 0 AND a.id IN (SELECT doc_id FROM documents)),
l AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM lex QUALIFY rank <= 50), v AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM den QUALIFY rank <= 50),
f AS (SELECT query_id, id, round(sum(1.0 / (60 + rank)), 12) AS score FROM (SELECT query_id, id, rank FROM l UNION ALL SELECT query_id, id, rank FROM v) GROUP BY 1, 2)
SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM f QUALIFY rank <= 10""")
def _(s, d):
    docs = A.table(s, d, "documents").select("doc_id", "text")
    vectors = A.table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    asked = docs.join(vectors, F.col("doc_id") == F.col("id")).where(F.col("id") % 20 == 0).select(F.col("id").alias("query_id"), "text", "embedding")
    parts = max(1, -(-docs.count() // 4096))  # so many documents a task, which needn't move again
    return retrieval.hybrid(docs.repartition(parts, "doc_id"), vectors, asked)


@query("a13_selected_percentiles", f"WITH {A.METRICS} SELECT metric, count(value) AS n, round(max(value), 6) AS max, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM metrics GROUP BY metric")
def _(s, d):
    found = intervals.selected(A.metrics(s, d).select("metric", F.col("value").cast("double").alias("v")), ["metric"], "summary")
    return found.select("metric", F.col("summary.count").alias("n"), *(F.round(f"summary.{c}", 6).alias(c) for c in ("max", "p50", "p95", "p99")))


@query("e13_merged_partials", f"WITH {A.CALLS}, {_TOTALS}, {_UNION}, {_PEAK} SELECT model, count, errors, input_tokens, output_tokens, round(compute_s, 3) AS compute_time_s, round(coalesce(wall, 0), 3) AS wall_clock_time_s, round(compute_s / count, 3) AS avg_call_s, coalesce(peak, 0) AS max_concurrent FROM t LEFT JOIN u USING (model) LEFT JOIN p USING (model)")
def _(s, d):
    shard = F.pmod(F.xxhash64("started_at", "ended_at"), F.lit(3))
    return ledger.finished(ledger.merged([ledger.partial(A.calls(s, d).where(shard == k)) for k in range(3)]))


_MARKS = lambda x: f"max({x}), quantile_cont({x}, 0.5), quantile_cont({x}, 0.95), quantile_cont({x}, 0.99)"
_NAMED = lambda *n: ", ".join(f"'{c}_{p}'" for c in n for p in ("max", "p50", "p95", "p99"))


@query("q2_live_report", f"""WITH {A.ACTIVITIES}, {A.WORKFLOWS}, {A.METRICS},
ch AS (SELECT *, {_SECONDS.format(a='started_at', b='closed_at')} AS sec FROM workflows WHERE type = 'ProcessPdfWorkflow' AND closed_at IS NOT NULL),
ac AS (SELECT *, {_SECONDS.format(a='scheduled_at', b='closed_at')} AS x, {_SECONDS.format(a='last_started_at', b='closed_at')} AS y FROM activities WHERE workflow_id IN (SELECT workflow_id FROM ch)),
r AS (SELECT 'workflows' AS section, type AS subject, ['count', 'success_count', 'failure_count', 'other_count', {_NAMED('duration')}] AS name,
CAST([count(*), count(*) FILTER (WHERE status = 'COMPLETED'), count(*) FILTER (WHERE status = 'FAILED'), count(*) FILTER (WHERE status NOT IN ('COMPLETED', 'FAILED')), {_MARKS('sec')}] AS DOUBLE[]) AS value FROM ch GROUP BY type
UNION ALL SELECT 'activities', activity_type, ['count', 'success_count', 'failure_count', 'retry_count', {_NAMED('schedule_to_close', 'start_to_close')}],
CAST([count(*), count(*) FILTER (WHERE outcome = 'success'), count(*) FILTER (WHERE outcome IN ('failure', 'timed_out')), sum(greatest(attempts - 1, 0)), {_MARKS('x')}, {_MARKS('y')}] AS DOUBLE[]) FROM ac GROUP BY activity_type
UNION ALL SELECT 'hosts', CAST(instance AS VARCHAR), [{_NAMED('cpu', 'memory')}], CAST([{_MARKS("CASE WHEN metric = 'view' THEN value END")}, {_MARKS("CASE WHEN metric = 'click' THEN value END")}] AS DOUBLE[]) FROM metrics GROUP BY instance
UNION ALL SELECT 'items', 'all', ['items', 'succeeded', 'failed'], CAST([count(*), count(*) FILTER (WHERE status = 'COMPLETED'), count(*) FILTER (WHERE status <> 'COMPLETED')] AS DOUBLE[]) FROM ch)
SELECT section, subject, name, round(value, 6) AS value FROM (SELECT section, subject, unnest(name) AS name, unnest(value) AS value FROM r)""")
def _(s, d):
    metric = F.col("metric")
    m = A.metrics(s, d).withColumn("metric", F.when(metric == "view", "cpu").when(metric == "click", "memory").otherwise(metric))
    since, until = (datetime(y, 1, 1, tzinfo=UTC) for y in (1970, 2200))
    pulled = reports.side_by_side({"runs": lambda: A.workflows(s, d), "events": lambda: A.run_events(s, d), "hosts": lambda: m})
    return reports.rows(reports.live_report(pulled["runs"], pulled["events"], pulled["hosts"], since, until)).withColumn("value", F.round("value", 6))


@query("k6_npy_round_trip", f"SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, {_HALVES} AS embedding FROM embeddings")
def _(s, d):
    s.dataSource.register(npy.NpySource)
    path = f"{scratch.folder(s)}/vectors-{uuid.uuid4().hex}"
    ordered = A.table(s, d, "embeddings").select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    ordered.select("embedding").write.format("npy").mode("append").save(path)
    return s.read.format("npy").load(path)


@query("s11_queue_runs", """WITH n AS (SELECT trim(url) AS uri, regexp_replace(regexp_extract(trim(url), '([^/]+)$', 1), '\\.[^.]+$', '') AS name FROM pages WHERE trim(coalesce(url, '')) <> ''),
g AS (SELECT uri, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM n)
SELECT CASE WHEN slug = '' THEN 'unknown' ELSE slug END AS document_id, uri, CAST(1 AS INTEGER) AS receives FROM g""")
def _(s, d):
    where = f"{scratch.folder(s)}/queue-{uuid.uuid4().hex}"

    def send(rows) -> None:
        q = queue.Queue(f"{where}/q")
        for r in rows:
            q.send(r["url"] or "")

    urls = A.table(s, d, "pages").select("url")
    urls.foreachPartition(send)
    ingest.served(s, f"{where}/q", f"{where}/runs", f"{where}/checkpoint", most=urls.count() + 1).awaitTermination()
    return ingest.started(s, f"{where}/runs").select("document_id", "uri", "receives")


@query("h7_walk", f"{_WALK} SELECT doc, title, row_number() OVER (PARTITION BY doc ORDER BY list_append(path, 2147483647)) AS visit FROM n")
def _(s, d):
    return trees.postorder(trees.preorder(A.places(s, d))).select("doc", "title", F.col("visit").cast("long").alias("visit"))


@query("p8_prompt_specs", f"""WITH {A.PAGES}, t AS (SELECT doc, list(text ORDER BY page_idx) AS p, list('<physical_index_' || (page_idx + 1) || '>' || chr(10) || text || chr(10) || '<physical_index_' || (page_idx + 1) || '>' || chr(10) || chr(10) ORDER BY page_idx) AS w FROM pages_ GROUP BY doc),
k AS (SELECT doc, 'toc' AS key, 'List the sections of these pages as JSON with structure, title and physical_index.' || chr(10) || regexp_replace(regexp_replace(array_to_string(w, ''), '\\.{{5,}}', ': ', 'g'), '(?:\\. ){{5,}}\\.?', ': ', 'g') AS prompt FROM t
UNION ALL SELECT doc, 'summary', 'Write a concise summary of the main points of this section.' || chr(10) || '<<<context-before>>>' || chr(10) || p[1] || chr(10) || '<<<section-content>>>' || chr(10) || array_to_string(p[2:len(p) - 1], '') || chr(10) || '<<<context-after>>>' || chr(10) || p[len(p)] FROM t WHERE len(p) > 2
UNION ALL SELECT doc, 'title', 'Does the section ' || doc || '{{x}} open this page? Answer as JSON with start_begin yes or no.' || chr(10) || p[1] FROM t)
SELECT doc, key, md5(prompt) AS prompt FROM k""")
def _(s, d):
    pages = A.pages(s, d)
    of = pages.groupBy("doc").agg(F.count("*").cast("int").alias("n"))
    last, uri = F.col("n") - 1, F.concat(F.lit("pages/"), "doc")
    every = prompts.page_spec(F.sequence(F.lit(0), last), "physical_index", dots=True)
    inner = prompts.page_spec(F.sequence(F.lit(1), last - 1), before=F.array(F.lit(0)), after=F.array(last))
    first = prompts.page_spec(F.array(F.lit(0)))
    specs = of.select("doc", F.lit("toc").alias("key"), prompts.spec("generate_toc_init", "local", uri, page={"content": every}).alias("spec"))
    specs = specs.unionAll(of.where("n > 2").select("doc", F.lit("summary"), prompts.spec("generate_node_summary", "upstream", uri, page={"node_text": inner})))
    specs = specs.unionAll(of.select("doc", F.lit("title"), prompts.spec("check_title_appearance_in_start", "local", uri, small={"title": F.concat(F.col("doc"), F.lit("{x}"))}, page={"page_text": first})))
    return pagetext.rendered(specs, pages).select("doc", "key", F.md5("prompt").alias("prompt"))


# --- written and read back

def _place(s, name: str) -> str:
    return f"{scratch.folder(s)}/{name}-{uuid.uuid4().hex}"


@query("s5_pages_json", f"WITH {A.PAGES} SELECT CAST(doc AS VARCHAR) AS doc, page_idx, text, CAST(len(regexp_extract_all(text, '[A-Za-z0-9]{{1,4}}|[^\\sA-Za-z0-9]')) AS BIGINT) AS token_count FROM pages_")
def _(s, d):
    path = _place(s, "pages")
    sources.text_pages(A.table(s, d, "documents")).write.json(path)
    return sources.pages(s, path)


@query("k2_run_pages", f"WITH {A.PAGES}, g AS (SELECT 'd' || doc % 40 AS document_id, doc, page_idx, text FROM pages_) SELECT document_id, r AS run_id, doc, page_idx, CASE r WHEN 'second' THEN 'x' || text ELSE text END AS text FROM g, (VALUES ('first'), ('second')) v(r) WHERE r = 'first' OR doc % 40 < 10")
def _(s, d):
    # documents of 40 groups have a first run, those of ten groups a second, which is written again and so replaced
    path, pages = _place(s, "runs"), A.pages(s, d).select(F.concat(F.lit("d"), F.col("doc") % 40).alias("document_id"), "doc", "page_idx", "text")
    some = pages.where(F.col("doc") % 40 < 10).withColumn("run_id", F.lit("second"))
    for rows in (pages.withColumn("run_id", F.lit("first")), some, some.withColumn("text", F.concat(F.lit("x"), "text"))):
        sinks.run_pages(rows.repartition("document_id"), path)
    return s.read.option("basePath", path).schema("doc long, page_idx int, text string, document_id string, run_id string").parquet(path)


@query("k3_page_elements", f"WITH {A.BOXES} SELECT doc, page, ord, label, x0, y0 FROM boxes")
def _(s, d):
    path = _place(s, "elements")
    rows = A.boxes(s, d).select("doc", "page", "ord", "label", "x0", "y0")
    sinks.page_elements(rows, path, "raw")
    return s.read.schema(rows.schema).json(f"{path}/raw")


@query("k8_points_replaced", "SELECT vec_id AS n, 'p' || (vec_id % 20) AS paper FROM embeddings WHERE vec_id % 20 <> 7 AND (vec_id % 20 >= 5 OR vec_id // 20 % 2 = 0)")
def _(s, d):
    # all papers, then every other vector of five of them as their whole, then a paper and one that isn't there deleted
    path = _place(s, "index")
    rows = A.table(s, d, "embeddings").select(F.col("vec_id").alias("n"), F.concat(F.lit("p"), F.col("vec_id") % 20).alias("paper"), F.col("embedding"))
    dim = rows.agg(F.max(F.size("embedding"))).first()[0]
    sinks.index_chunks(s, rows, path, dim)
    sinks.index_chunks(s, rows.where((F.col("n") % 20 < 5) & (F.floor(F.col("n") / 20) % 2 == 0)), path, dim)
    sinks.delete_papers(s, f"{path}/points", ["p7", "nobody"])
    return s.read.parquet(f"{path}/points").select("n", "paper")


@query("f3_first_table", "SELECT page_id, md5(nullif(regexp_extract(replace(replace(html, '<ul', '<TABLE'), '</ul>', '</table>'), '(?is)<table.*?</table>', 0), '')) AS found FROM pages")
def _(s, d):
    listed = F.regexp_replace(F.regexp_replace("html", "<ul", "<TABLE"), "</ul>", "</table>")
    return A.table(s, d, "pages").select("page_id", F.md5(text.first_table(listed)).alias("found"))


@query("f9_without_fences", "SELECT doc_id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS inside FROM documents WHERE NOT contains(text, '```')")
def _(s, d):
    docs = A.table(s, d, "documents").where(~F.contains("text", F.lit("```")))
    fenced = F.concat(F.lit("Here it is:\n```json\n"), "text", F.lit("\n```\nDone."))
    return docs.select("doc_id", F.md5(text.without_fences(fenced)).alias("inside"))


@query("l5_abstracts", f"WITH {A.PAGES} SELECT doc, md5('Copy the abstract from these pages, or null. Answer as JSON with abstract.' || chr(10) || string_agg(text, '' ORDER BY page_idx)) AS abstract FROM pages_ WHERE page_idx < 3 GROUP BY doc")
def _(s, d):
    digest = lambda m, p: json.dumps({"abstract": hashlib.md5(p.encode()).hexdigest()})
    return building.abstracts(A.pages(s, d), building.Options(), digest)


@query("x2_structured_calls", "SELECT conv_id, turn, CAST(to_json({'answer': CASE WHEN turn % 3 = 1 AND lower(trim(role)) IN ('yes', 'y', 'true', '1') OR turn % 3 = 2 THEN 'yes' ELSE 'no' END}) AS VARCHAR) AS content, CAST(CASE WHEN turn % 3 = 0 THEN 3 ELSE 1 END AS INTEGER) AS attempts, turn % 3 <> 0 AS ok FROM conversations WHERE turn % 3 <> 0 UNION ALL SELECT conv_id, turn, 'invalid', 3, false FROM conversations WHERE turn % 3 = 0")
def _(s, d):
    # the provider gives the prompt back: a role, a truth value, or no JSON at all
    turn = F.col("turn")
    prompt = F.when(turn % 3 == 1, F.to_json(F.struct(F.col("role").alias("answer")))).when(turn % 3 == 2, '{"answer": true, "more": 1}').otherwise("yes, it does")
    told = providers.call(A.table(s, d, "conversations").select("conv_id", "turn", F.lit("echo").alias("model"), prompt.alias("prompt")), lambda m, p: p, "title_appearance")
    return told.select("conv_id", "turn", F.when(F.col("ok"), F.regexp_replace("content", " ", "")).otherwise("invalid").alias("content"), "attempts", "ok")
