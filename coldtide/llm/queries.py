"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from coldtide.llm import html, imatch, jaccard, langid, linededup, packing, pieces, quality, sharding, urls

QUERIES = {
    "op1_sharding": sharding.op1,
    "op2_line_dedup": linededup.op2,
    "op3_i_match": imatch.op3,
    "op4_quality_rules": quality.op4,
    "op5_best_two_fit": packing.op5,
    "op6_sentencepiece": pieces.op6,
    "op7_url_filter": urls.op7,
    "op8_html_main_text": html.op8,
    "op9_ngram_jaccard": jaccard.op9,
    "op10_language_id": langid.op10,
}

ORACLES = {
    "op1_sharding": sharding.SQL,
    "op4_quality_rules": quality.SQL,
}
