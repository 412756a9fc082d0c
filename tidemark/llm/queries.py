"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import checks
from tidemark.llm.ann import op5_ann
from tidemark.llm.codes import op11_codes
from tidemark.llm.html import op4_html
from tidemark.llm.jaccard import op10_jaccard
from tidemark.llm.licenses import op2_licenses
from tidemark.llm.linededup import op9_line_dedup
from tidemark.llm.mixing import op8_mixing
from tidemark.llm.packing import op12_packing
from tidemark.llm.pieces import op1_sentencepiece
from tidemark.llm.quality import op6_quality
from tidemark.llm.runs import op13_runs
from tidemark.llm.topk import op7_topk
from tidemark.llm.urls import op3_urls

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_licenses": op2_licenses,
    "op3_urls": op3_urls,
    "op4_html": op4_html,
    "op5_ann": op5_ann,
    "op6_quality": op6_quality,
    "op7_topk": op7_topk,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_jaccard": op10_jaccard,
    "op11_codes": op11_codes,
    "op12_packing": op12_packing,
    "op13_runs": op13_runs,
}

SQL: dict[str, str] = {
    "op7_topk": checks.TOPK,
    "op8_mixing": checks.MIXING,
    "op9_line_dedup": checks.LINE_DEDUP,
    "op10_jaccard": checks.JACCARD,
    "op11_codes": checks.CODES,
}
