"""Structured answers of models: their fields by key, validation with defaults, and tables of contents in any of their spellings."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafline.functions.text import YES

# Answer keys, their fields and kinds, and the limits of table-of-contents rows.
RESPONSES = {
    "toc_detection": {"toc_detected": "yes_no"},
    "page_index_present": {"page_index_given_in_toc": "yes_no"},
    "toc_completion": {"completed": "yes_no"},
    "toc_list": {"toc": "rows"},
    "toc_list_initial": {"toc": "some_rows"},
    "title_appearance": {"answer": "yes_no"},
    "title_starts_section": {"start_begin": "yes_no"},
    "physical_index_fix": {"physical_index": "any"},
    "summary_verdict": {"faithful": "yes_no", "missed_topics": "list"},
    "abstract": {"abstract": "any"},
}
TITLE_LENGTHS, STRUCTURE_LENGTH, INDEX_LENGTH = (5, 300), 16, 32
ROW_KEYS = {"title", "structure", "physical_index", "page"}
TOC_KEYS = ("toc", "table_of_contents", "contents")
TOC_ROW = "structure string, title string, physical_index string, page string"


def known(key: str) -> dict[str, str]:
    if key not in RESPONSES:
        raise KeyError(f"unknown response schema {key!r}; known: {', '.join(sorted(RESPONSES))}")
    return RESPONSES[key]


def row_errors(row: dict) -> list[str]:
    """What is wrong with one table-of-contents row."""
    title, structure = row.get("title"), row.get("structure")
    out = [f"unknown key {k}" for k in sorted(row.keys() - ROW_KEYS)]
    if not isinstance(title, str) or not TITLE_LENGTHS[0] <= len(title) <= TITLE_LENGTHS[1]:
        out.append("title")
    if structure is not None and (not isinstance(structure, str) or len(structure) > STRUCTURE_LENGTH):
        out.append("structure")
    return out + [k for k in ("physical_index", "page") if isinstance(row.get(k), str) and len(row[k]) > INDEX_LENGTH]


def normalised(key: str, content: str) -> str:
    """A model's answer as JSON of the key's fields only, defaults filled in; ValueError where it doesn't validate."""
    data = json.loads(content)
    if not isinstance(data, dict):
        raise ValueError("an object is expected")
    out: dict = {}
    for field, kind in known(key).items():
        v = data.get(field)
        if kind == "yes_no":
            v = "yes" if v is True or isinstance(v, str) and v.strip().lower() in YES else "no"
        elif kind != "any":
            v = [] if v is None and kind != "some_rows" else v
            if not isinstance(v, list) or kind == "some_rows" and not v:
                raise ValueError(f"{field} must be a list" + " with a row" * (kind == "some_rows"))
            bad = [f"row {n}: {', '.join(e)}" for n, r in enumerate(v) if kind != "list" and (e := row_errors(r))]
            if bad:
                raise ValueError("; ".join(bad))
        out[field] = v
    return json.dumps(out, ensure_ascii=False)


def toc_errors(title: Column, structure: Column, physical_index: Column, page: Column) -> Column:
    """row_errors as a column, for rows that are already columns of text."""
    bad_title = ~F.coalesce(F.length(title).between(*TITLE_LENGTHS), F.lit(False))
    long = lambda c, n: F.coalesce(F.length(c) > n, F.lit(False))
    return F.array_compact(F.array(F.when(bad_title, F.lit("title")), F.when(long(structure, STRUCTURE_LENGTH), F.lit("structure")), F.when(long(physical_index, INDEX_LENGTH), F.lit("physical_index")), F.when(long(page, INDEX_LENGTH), F.lit("page"))))


def assembled_rows(content: Column) -> Column:
    """Rows (TOC_ROW) of an assembled table of contents: a bare list, a list under one of TOC_KEYS, or the one list of an
    object with one key; none from anything else."""
    v = F.try_parse_json(content)
    raw = lambda path: F.try_variant_get(v, path, "string")
    is_list = lambda c: F.when(F.startswith(F.trim(c), F.lit("[")), c)
    only = F.map_values(F.from_json(content, "map<string,string>"))
    single = F.when(F.size(only) == 1, is_list(only[0]))
    found = F.coalesce(is_list(raw("$")), *(is_list(raw(f"$.{k}")) for k in TOC_KEYS), single)
    return F.coalesce(F.from_json(found, f"array<struct<{TOC_ROW.replace(' string', ':string')}>>"), F.array().cast(f"array<struct<{TOC_ROW.replace(' string', ':string')}>>"))
