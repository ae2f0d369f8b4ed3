"""The queries of this subpackage and their SQL, as __spark_entry__ registers them."""

from __future__ import annotations

from leafline.llm import collocations, decontamination, jaccard, licenses, lines, lm, mixing, packing, periods, quality, search, urls, vectors

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_quality": quality.op2_quality,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_mixing": mixing.op4_mixing,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_topk_search": search.op6_topk_search,
    "op7_url_filters": urls.op7_url_filters,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_lm_scoring": lm.op9_lm_scoring,
    "op10_embedding_dedup": vectors.op10_embedding_dedup,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_collocations": collocations.op12_collocations,
    "op13_periodic_runs": periods.op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op3_license_scan": licenses.OP3_SQL,
    "op6_topk_search": search.OP6_SQL,
    "op7_url_filters": urls.OP7_SQL,
    "op8_line_dedup": lines.OP8_SQL,
    "op11_decontamination": decontamination.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_periodic_runs": periods.OP13_SQL,
}
