"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from evidar.llm.audio import op8_chroma_fingerprints
from evidar.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from evidar.llm.fill_middle import OP11_SQL, op11_fill_in_middle
from evidar.llm.filter_audit import OP12_SQL, op12_filter_audit
from evidar.llm.language_id import op6_language_id
from evidar.llm.lm_scoring import op7_lm_scoring
from evidar.llm.mixing import op10_source_mixing
from evidar.llm.near_dedup import op5_simhash_near_dedup
from evidar.llm.packing import op4_packing
from evidar.llm.pieces import op13_sentencepiece
from evidar.llm.substring_dedup import op2_substring_dedup
from evidar.llm.token_counts import op1_token_counts
from evidar.llm.warc import OP3_SQL, op3_warc_salvage

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc_salvage": op3_warc_salvage,
    "op4_packing": op4_packing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_chroma_fingerprints": op8_chroma_fingerprints,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_source_mixing": op10_source_mixing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL = {
    "op3_warc_salvage": OP3_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}
