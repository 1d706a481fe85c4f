"""Registered queries of the operators for training data."""

from __future__ import annotations

from tidemark.llm.alignment import op13_alignment
from tidemark.llm.fingerprints import op3_fingerprints
from tidemark.llm.html import op8_html
from tidemark.llm.language import op11_language
from tidemark.llm.lines import OP1_SQL, op1_line_dedup
from tidemark.llm.mixing import op6_mixing
from tidemark.llm.packing import op2_packing
from tidemark.llm.periods import op12_periods
from tidemark.llm.quality import op9_quality
from tidemark.llm.simhash import op5_simhash
from tidemark.llm.substrings import OP7_SQL, op7_substrings
from tidemark.llm.tokencount import op10_token_counts
from tidemark.llm.topk import OP4_SQL, op4_topk

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_topk": op4_topk,
    "op5_simhash": op5_simhash,
    "op6_mixing": op6_mixing,
    "op7_substrings": op7_substrings,
    "op8_html": op8_html,
    "op9_quality": op9_quality,
    "op10_token_counts": op10_token_counts,
    "op11_language": op11_language,
    "op12_periods": op12_periods,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op4_topk": OP4_SQL,
    "op7_substrings": OP7_SQL,
}
