"""Prompt templates by name and style, in our own words. A style that lacks a name falls back to the local one.

A prompt is rendered from columns (`render`), or from a spec: a row's choice of template and style, its small values, and which pages
its page values are assembled from (operators.pagetext).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STYLES = ("local", "upstream")
_LOCAL = {
    "toc_detector_single_page": "Does this page hold a table of contents? Answer as JSON with toc_detected yes or no.\n{content}",
    "detect_page_index": "Does this table of contents give page numbers? Answer as JSON with page_index_given_in_toc yes or no.\n{toc}",
    "toc_transformer": "Rewrite this table of contents as a JSON list of structure, title and page.\n{toc}",
    "toc_completion": "Is the rewritten table complete? Answer as JSON with completed yes or no.\n{toc}\n{rewritten}",
    "generate_toc_init": "List the sections of these pages as JSON with structure, title and physical_index.\n{content}",
    "generate_toc_continue": "Continue this list of sections with those of the next pages.\n{previous}\n{content}",
    "toc_index_extractor": "Give each section the tag of the page where it starts.\n{toc}\n{content}",
    "add_page_number_to_toc": "Find the page where this section starts.\n{item}\n{content}",
    "check_title_appearance": "Does the section {title} appear on this page? Answer as JSON with answer yes or no.\n{page_text}",
    "check_title_appearance_in_start": "Does the section {title} open this page? Answer as JSON with start_begin yes or no.\n{page_text}",
    "single_toc_item_index_fixer": "On which of these pages does {section_title} start? Answer as JSON with physical_index.\n{content}",
    "generate_node_summary": "Summarise the section between the marks.\n{node_text}",
    "verify_node_summary": "Is this summary of {title} faithful, and what does it miss? Answer as JSON with faithful and missed_topics.\n{summary}\n{section_text}",
    "regenerate_summary_with_missed_topics": "Rewrite this summary so that it covers {missed_topics}.\n{prior_summary}\n{node_text}",
    "generate_doc_description": "Describe the document of this outline in a sentence.\n{structure}",
    "extract_abstract": "Copy the abstract from these pages, or null. Answer as JSON with abstract.\n{content}",
    "resummarise_leaf": "Summarise the section with its figures.\n{node_text}\n{figures}",
    "resummarise_parent": "Summarise the section from its parts.\n{title}\n{children}",
    "vision_figure": "Describe the figure as JSON panels.",
    "vision_layout": "Transcribe the picture as labelled blocks.",
}
_UPSTREAM = {
    "toc_detector_single_page": "You are given one page. Decide whether it belongs to a table of contents; lists of figures and of tables don't count. Reply with JSON: toc_detected, yes or no.\nPage:\n{content}",
    "detect_page_index": "You are given a table of contents. Decide whether its entries carry page numbers. Reply with JSON: page_index_given_in_toc, yes or no.\nTable:\n{toc}",
    "toc_completion": "You are given a table of contents and its rewritten form. Decide whether every entry was carried over. Reply with JSON: completed, yes or no.\nTable:\n{toc}\nRewritten:\n{rewritten}",
    "generate_toc_init": "You are an expert in the structure of documents. List the sections that start on the tagged pages, in order, as JSON entries with structure, title and physical_index, the tag of the page.\nPages:\n{content}",
    "generate_toc_continue": "You are an expert in the structure of documents. The list so far ends where the tagged pages begin; give the further entries only, in the same form.\nSo far:\n{previous}\nPages:\n{content}",
    "toc_index_extractor": "You are given a table of contents and tagged pages. Add physical_index, the tag of the page where it starts, to the entries that start there; leave others as they are.\nTable:\n{toc}\nPages:\n{content}",
    "add_page_number_to_toc": "You are given entries of a table of contents and tagged pages. Where an entry starts on one of them, set its physical_index to the tag; otherwise leave it empty.\nEntries:\n{item}\nPages:\n{content}",
    "check_title_appearance": "Decide whether a section of this title starts or appears on the page. Compare loosely, white space aside. Reply with JSON: answer, yes or no.\nTitle: {title}\nPage:\n{page_text}",
    "check_title_appearance_in_start": "Decide whether the section of this title starts at the very top of the page, with nothing of another section before it. Reply with JSON: start_begin, yes or no.\nTitle: {title}\nPage:\n{page_text}",
    "single_toc_item_index_fixer": "Find the page on which the section starts. Reply with JSON: physical_index, its tag.\nTitle: {section_title}\nPages:\n{content}",
    "generate_node_summary": "Write a concise summary of the main points of this section.\n{node_text}",
    "verify_node_summary": "Compare the summary with the section. Reply with JSON: faithful, yes or no, and missed_topics, what the section covers and the summary leaves out.\nTitle: {title}\nSummary:\n{summary}\nSection:\n{section_text}",
    "regenerate_summary_with_missed_topics": "A summary left out some topics. Write it again, as concise as before, with these covered: {missed_topics}.\nSummary:\n{prior_summary}\nSection:\n{node_text}",
    "generate_doc_description": "Write one sentence that tells this document from others, from its outline.\nOutline:\n{structure}",
    "extract_abstract": "If the pages hold an abstract, copy it word for word. Reply with JSON: abstract, the text or null.\nPages:\n{content}",
    "resummarise_leaf": "Write a concise summary of the section that takes its figures and tables into account.\nSection:\n{node_text}\nFigures:\n{figures}",
    "resummarise_parent": "Write a concise summary of the section from those of its subsections.\nTitle: {title}\nSubsections:\n{children}",
    "vision_figure": "Analyse the figure. Reply with a JSON list with an object for each panel: titles, axis labels, ticks, legends and series.",
    "vision_layout": "Transcribe the picture as HTML, one labelled div with its box for each block.",
}
TEMPLATES = {"local": _LOCAL, "upstream": _UPSTREAM}


def template(name: str, style: str = "local") -> str:
    if style not in STYLES:
        raise ValueError(f"style is local or upstream, not {style!r}")
    found = TEMPLATES[style].get(name) or TEMPLATES["local"].get(name)
    if found is None:
        raise KeyError(f"unknown prompt {name!r}")
    return found


def render(name: str, style: str = "local", **values: Column) -> Column:
    """The prompt as a column; every field of the template needs a value."""
    out: list[Column] = []
    rest = template(name, style)
    while "{" in rest:
        head, _, rest = rest.partition("{")
        field, _, rest = rest.partition("}")
        out += [F.lit(head), F.coalesce(values[field].cast("string"), F.lit(""))]
    return F.concat(*out, F.lit(rest))


PAGE_SPEC = "struct<indices: array<int>, wrap: string, dots: boolean, overlap_pre: array<int>, overlap_post: array<int>, section_only: boolean>"
SPEC = f"struct<name: string, style: string, small: map<string, string>, page: map<string, {PAGE_SPEC}>, pages_uri: string>"


def page_spec(indices: Column, wrap: str = "raw", dots: bool = False, before: Column | None = None, after: Column | None = None, section_only: bool = False) -> Column:
    """Which pages, 0-based and in this order, a value is assembled from, and how."""
    none = F.array().cast("array<int>")
    kept = {"indices": indices, "wrap": F.lit(wrap), "dots": F.lit(dots), "overlap_pre": none if before is None else before, "overlap_post": none if after is None else after, "section_only": F.lit(section_only)}
    return F.struct(*(v.alias(k) for k, v in kept.items())).cast(PAGE_SPEC)


def spec(name: str, style: str, pages_uri: Column, small: dict[str, Column] | None = None, page: dict[str, Column] | None = None) -> Column:
    """A prompt's spec; the pages' address is kept only if the prompt has page values."""
    template(name, style)
    pairs = lambda values, kind: F.create_map(*(x for k, v in (values or {}).items() for x in (F.lit(k), v.cast(kind)))) if values else F.create_map().cast(f"map<string, {kind}>")
    kept = {"name": F.lit(name), "style": F.lit(style), "small": pairs(small, "string"), "page": pairs(page, PAGE_SPEC), "pages_uri": pages_uri if page else F.lit(None)}
    return F.struct(*(v.alias(k) for k, v in kept.items())).cast(SPEC)


def filled(name: Column, style: Column, values: Column) -> Column:
    """The template of each row with its values put in, left to right, so that a value's own braces stay. An unknown template or
    a field without a value is an error."""
    known = F.create_map(*(x for s in STYLES for n in sorted({*_LOCAL, *TEMPLATES[s]}) for x in (F.lit(f"{s}/{n}"), F.lit(template(n, s)))))
    found = F.try_element_at(known, F.concat_ws("/", style, name))
    text = F.coalesce(found, F.raise_error(F.concat(F.lit("unknown prompt "), style, F.lit("/"), name)).cast("string"))
    field = lambda x: F.regexp_extract(x, r"^\{(\w+)\}$", 1)
    value = lambda x: F.coalesce(F.try_element_at(values, field(x)), F.raise_error(F.concat(F.lit("no value for "), x)).cast("string"))
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\{\w+\}|[^{]+|\{"), F.lit(0)), lambda x: F.when(field(x) != "", value(x)).otherwise(x)), "")
