"""Retrieval chunks: emission units of a tree, the token-budget splitter, stable ids and dense positions."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import ids, text
from leafline.operators import scratch

MAX_TOKENS, OVERLAP_TOKENS = 512, 64
# Kinds and sources of chunks.
ABSTRACT, SECTION, TABLE, CAPTION = "abstract", "section_text", "table", "caption"
_TOKEN = re.compile(r"[A-Za-z0-9]{1,4}|[^\sA-Za-z0-9]")
_LEVELS = (re.compile(r"(?<=\n\n)"), re.compile(r"(?<=[.!?])\s+"), re.compile(r"\s+"))


def tokens(s: str) -> int:
    return len(_TOKEN.findall(s))


def _pieces(s: str, at: list[int], budget: int, start: int, end: int, level: int = 0) -> Iterator[tuple[int, int, int]]:
    """(start, end, tokens) of s[start:end] cut at paragraphs, then sentences, then words, then characters, until each piece is
    within the budget; at: where the tokens of s start."""
    n = bisect_left(at, end) - bisect_left(at, start)
    if n <= budget:
        yield start, end, n
    elif level == len(_LEVELS):
        for i in range(start, end, budget):
            yield i, min(i + budget, end), tokens(s[i : min(i + budget, end)])
    else:
        for m in _LEVELS[level].finditer(s, start, end):
            if m.end() > start:
                yield from _pieces(s, at, budget, start, m.end(), level + 1)
                start = m.end()
        if start < end:
            yield from _pieces(s, at, budget, start, end, level + 1)


def split(s: str, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP_TOKENS) -> list[str]:
    """Chunks of at most max_tokens, each beginning with the last pieces of the one before, up to `overlap` tokens."""
    if not s or not s.strip():
        return []
    out: list[str] = []
    held: list[tuple[int, int]] = []  # where each piece starts, and its tokens; pieces follow each other without gaps
    total = 0
    for start, _, n in _pieces(s, [m.start() for m in _TOKEN.finditer(s)], max(1, max_tokens - overlap), 0, len(s)):
        if held and total + n > max_tokens:
            out.append(s[held[0][0] : start].strip())
            cut, total = len(held), 0
            while cut and total + held[cut - 1][1] <= min(overlap, max_tokens - n):
                cut -= 1
                total += held[cut][1]
            held = held[cut:]
        held.append((start, n))
        total += n
    out.append(s[held[0][0] :].strip())
    return [x for x in out if x]


def units(papers: DataFrame, leaves: DataFrame, elements: DataFrame) -> DataFrame:
    """What chunks are cut from, with an emission key: abstract, then per leaf in preorder its text, then per element its table and its caption.

    papers(paper, abstract, total_pages); leaves(paper, node_id, title, breadcrumb, start_index, end_index, raw_text);
    elements(paper, node_id, ord, element_id, element_type, page_index, structured_data, caption).
    """
    crumb = F.array().cast("array<string>")
    cols = ["paper", "key", "node_id", "node_title", "breadcrumb", "page_start", "page_end", "kind", "source_kind", "text"]
    key = lambda rank, node, ord_, branch: F.struct(F.lit(rank).alias("rank"), F.length(node).alias("digits"), node.cast("string").alias("leaf"), ord_.cast("long").alias("elem"), F.lit(branch).alias("branch"))
    zero = F.lit(0)
    a = papers.where(F.coalesce("abstract", F.lit("")) != "").select("paper", key(0, F.lit(""), zero, 0).alias("key"), F.lit("abstract").alias("node_id"), F.lit("Abstract").alias("node_title"), crumb.alias("breadcrumb"), F.lit(1).alias("page_start"), F.least(F.lit(3), "total_pages").alias("page_end"), F.lit(ABSTRACT).alias("kind"), F.lit("llm_abstract").alias("source_kind"), F.col("abstract").alias("text"))
    s = leaves.where(F.trim("raw_text") != "").select("paper", key(1, F.col("node_id"), zero, 0).alias("key"), "node_id", F.col("title").alias("node_title"), "breadcrumb", F.col("start_index").alias("page_start"), F.col("end_index").alias("page_end"), F.lit(SECTION).alias("kind"), F.lit("pymupdf").alias("source_kind"), F.col("raw_text").alias("text"))
    e = elements.join(leaves.select("paper", "node_id", "breadcrumb"), ["paper", "node_id"])
    where = F.concat(F.col("element_type"), F.lit(" on p."), F.col("page_index").cast("string"))
    own = F.concat_ws(":", "node_id", "element_id")
    strip = lambda c: F.trim(text.without_tags(F.col(c)))
    t = e.where(F.coalesce(strip("structured_data"), F.lit("")) != "").select("paper", key(1, F.col("node_id"), F.col("ord") + 1, 1).alias("key"), own.alias("node_id"), F.coalesce(F.nullif("caption", F.lit("")), where).alias("node_title"), "breadcrumb", F.col("page_index").alias("page_start"), F.col("page_index").alias("page_end"), F.lit(TABLE).alias("kind"), F.lit("chandra_markdown").alias("source_kind"), strip("structured_data").alias("text"))
    c = e.where(F.coalesce(strip("caption"), F.lit("")) != "").select("paper", key(1, F.col("node_id"), F.col("ord") + 1, 2).alias("key"), own.alias("node_id"), F.concat(F.lit("Caption for "), where).alias("node_title"), "breadcrumb", F.col("page_index").alias("page_start"), F.col("page_index").alias("page_end"), F.lit(CAPTION).alias("kind"), F.lit("layout_caption").alias("source_kind"), strip("caption").alias("text"))
    return a.select(cols).unionByName(s.select(cols)).unionByName(t.select(cols)).unionByName(c.select(cols))


def chunk(unit_rows: DataFrame, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP_TOKENS) -> DataFrame:
    """Units cut into chunks with doc_id, sub_index, position (dense from 0 within the paper), depth and token_count."""
    if max_tokens <= overlap:
        raise ValueError(f"max_tokens ({max_tokens}) must exceed overlap ({overlap})")

    @F.pandas_udf("array<string>")
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda s: split(s, max_tokens, overlap))

    scratch.small_batches(unit_rows.sparkSession)
    each = unit_rows.withColumn("parts", parts("text")).select(*[c for c in unit_rows.columns if c != "text"], F.posexplode("parts").alias("sub_index", "text"))
    position = F.row_number().over(W.partitionBy("paper").orderBy("key", "sub_index")) - 1
    return each.withColumns({"doc_id": ids.chunk_id(F.col("paper"), F.col("node_id"), F.col("sub_index")), "position": position, "depth": F.size("breadcrumb"), "token_count": text.count_tokens(F.col("text"))})


def totals(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("tokens"))


