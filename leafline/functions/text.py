"""Text functions as column expressions. Patterns carry (?U) where white space, digits or words are meant in Unicode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and limits that results must agree with.
PAGE_TAG = "physical_index"
PAGE_OVERHEAD_TOKENS = 15
BEFORE_MARK = "<<<context-before>>>"
SECTION_MARK = "<<<section-content>>>"
AFTER_MARK = "<<<context-after>>>"
LONG_DOTS = r"\.{5,}"
SPACED_DOTS = r"(?:\. ){5,}\.?"
CITATION_INITIALS = r"^([A-Z]\.[\s ]*){1,3}[A-Z][A-Za-zÀ-ſ´'’`\-]+"
CITATION_JOURNAL = r",\s*(19|20)\d{2},\s*\d+,\s*\d+"
NASICON = r"Na[1-9]?\+?[x-z]?Zr\d?Si[0-9x-z]?P[0-9x-z]?O\d{1,2}"
SODIUM_SALT = r"Na(?:PF6|BF4|ClO4|FSI|TFSI|DFOB|BOB|FP|OTf|Tf|N\(SO2F\)2|N\(CF3SO2\)2)"
LAYERED_OXIDE = r"(?:P2|P3|O3|O2)-type\s*Na[x0-9\.]*[A-Z][a-z]?\d?O\d"
GENERAL_FORMULA = r"\b(?:Na|Li|K|Mg|Ca|Al|Zr|Ti|Mn|Co|Ni|Fe|Cr|V|P|S|O|Cl|F|N|C)(?:[a-z])?(?:\d+\.?\d*)?(?:[A-Z][a-z]?(?:\d+\.?\d*)?){1,8}\b"
MEASURED_VALUE = r"\d+\.?\d*\s*(?:mS/cm|S/cm|mAh/g|Wh/kg|V\s*vs\.?\s*Na\+?/?Na|μS/cm|eV|GPa|MPa|kPa|mA/cm[²2]|μA/cm[²2]|mol/L|M\b|wt\.?%|vol\.?%)"
YES = ("yes", "y", "true", "1")
LINE_MARK = "<0x0A>"


def word_count(text: Column) -> Column:
    """Words between white space; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0)).cast("long")


def count_tokens(text: Column) -> Column:
    """A deterministic stand-in for a subword count: words cut into runs of up to four letters or digits, other signs one each."""
    # one sign stands for each token, so that no text is made for it
    return F.coalesce(F.length(F.regexp_replace(text, r"([A-Za-z0-9])[A-Za-z0-9]{0,3}|\s+", "$1")), F.lit(0)).cast("long")


def wrap_page(text: Column, number: Column) -> Column:
    """A page between its 1-based page tags."""
    tag = F.concat(F.lit(f"<{PAGE_TAG}_"), number.cast("string"), F.lit(">"))
    return F.concat(tag, F.lit("\n"), text, F.lit("\n"), tag, F.lit("\n\n"))


def transform_dots(text: Column) -> Column:
    """Leader dots, tight or spaced, as a colon."""
    return F.regexp_replace(F.regexp_replace(text, LONG_DOTS, ": "), SPACED_DOTS, ": ")


def with_context(before: Column, core: Column, after: Column) -> Column:
    return F.concat(F.lit(BEFORE_MARK + "\n"), before, F.lit("\n" + SECTION_MARK + "\n"), core, F.lit("\n" + AFTER_MARK + "\n"), after)


def section_block(text: Column) -> Column:
    """What stands between the section marks, trimmed; the text itself without a mark."""
    at = F.instr(text, SECTION_MARK)
    tail = F.substring(text, at + len(SECTION_MARK), F.length(text))
    end = F.instr(tail, AFTER_MARK)
    body = F.when(end > 0, F.substring(tail, F.lit(1), end - 1)).otherwise(tail)
    return F.when(at == 0, text).otherwise(F.regexp_replace(body, r"(?U)^\s+|\s+$", ""))


def parse_page_tag(value: Column) -> Column:
    """The number of a page tag, with or without brackets; null for anything else."""
    return F.expr("null").cast("int") if value is None else F.regexp_extract(value, rf"^<?{PAGE_TAG}_(\d+)>?$", 1).try_cast("int")


def yes_no(value: Column) -> Column:
    """Yes for true and for YES in any case, no for anything else; values that are neither text nor boolean are no."""
    kind = F.typeof(value).isin("string", "boolean")
    bare = F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(kind & F.lower(bare).isin(*YES), "yes").otherwise("no")


def slug(name: Column) -> Column:
    """An id from a name: lower case, runs of other signs as one hyphen, none at the ends; 'unknown' if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", "unknown").otherwise(s)


def tree_id(uri: Column) -> Column:
    """The last folder of a .../tree.json address."""
    return F.regexp_extract(uri, r"([^/]+)/tree\.json$", 1)


def truncated(text: Column, limit: int) -> Column:
    """At most `limit` characters, followed by how many more there were."""
    more = F.length(text) - limit
    return F.when(more > 0, F.concat(F.substring(text, 1, limit), F.lit("…[+"), more.cast("string"), F.lit(" more chars]"))).otherwise(text)


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def tags_to_space(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"(?U)\s+", " "))


def first_table(html: Column) -> Column:
    """The first table element, null without one."""
    m = F.regexp_extract(html, r"(?is)<table.*?</table>", 0)
    return F.when(m != "", m)


def without_fences(text: Column) -> Column:
    """The inside of a json fence: after the first opening, before the last closing mark."""
    at = F.instr(text, "```json")
    body = F.when(at > 0, F.substring(text, at + 7, F.length(text))).otherwise(text)
    back = F.instr(F.reverse(body), "```")
    cut = F.when(back > 0, F.substring(body, F.lit(1), F.length(body) - back - 2)).otherwise(body)
    return F.regexp_replace(cut, r"(?U)^\s+|\s+$", "")


def looks_like_citation(title: Column) -> Column:
    return F.coalesce(F.rlike(title, F.lit("(?U)" + CITATION_INITIALS)) | F.rlike(title, F.lit("(?U)" + CITATION_JOURNAL)), F.lit(False))


def entities(text: Column, seeds: list[str]) -> Column:
    """Sorted distinct entities: seeds that occur (names that start small in any case), and formulas and measured values.

    Single signs and bare numbers are left out.
    """
    lower = F.lower(text)
    hits = [F.when(F.contains(text, F.lit(s)) | (F.contains(lower, F.lit(s.lower())) if not s[0].isupper() else F.lit(False)), F.lit(s)) for s in seeds]
    found = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    for p in (NASICON, SODIUM_SALT, LAYERED_OXIDE, GENERAL_FORMULA, MEASURED_VALUE):
        found = F.array_union(found, F.transform(F.regexp_extract_all(text, F.lit("(?U)" + p), F.lit(0)), lambda m: F.regexp_replace(m, r"(?U)^\s+|\s+$", "")))
    kept = F.filter(F.array_distinct(found), lambda e: (F.length(e) > 1) & ~F.rlike(e, F.lit(r"(?U)^\d+\.?\d*$")))
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_sort(kept))


def element_text(ocr: Column, caption: Column) -> Column:
    """Recognised text and caption, the non-empty ones, with a space between."""
    return F.concat_ws(" ", F.nullif(ocr, F.lit("")), F.nullif(caption, F.lit("")))


def render_kind(content: Column) -> Column:
    """How a recognised block is to be shown: a closed analysis, blocks with layout attributes, a table of two lines or more
    with spaced pipes, or as it is."""
    has = lambda s: F.contains(content, F.lit(s))
    lines = F.regexp_replace(F.replace(content, F.lit(LINE_MARK), F.lit("\n")), r"(?U)^\s+|\s+$", "")
    return (
        F.when(F.rlike(content, F.lit("(?s)<analyze>.*?</analyze>")), "analyze")
        .when(has("data-bbox=") | has("data-label="), "layout")
        .when(has(" | ") & (has(LINE_MARK) | has("\n")) & F.contains(lines, F.lit("\n")), "table")
        .otherwise("pre")
    )


def compact_stamp(at: Column) -> Column:
    """A UTC time as 20240131T235959Z; the session's zone is UTC."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")


def iso_stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
