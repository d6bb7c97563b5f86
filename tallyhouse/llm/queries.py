"""Registered queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from tallyhouse.llm import op9_mixing, op10_topk, op11_filter_audit, op12_jaccard_join, op13_vector_codes
from tallyhouse.llm.op1_token_counts import op1_token_counts
from tallyhouse.llm.op2_repeats import op2_super_kmer_dedup
from tallyhouse.llm.op3_main_text import op3_min_cut_text
from tallyhouse.llm.op4_quality_rules import op4_decision_list
from tallyhouse.llm.op5_toxicity import op5_boosted_toxicity
from tallyhouse.llm.op6_near_dups import op6_tensored_minhash
from tallyhouse.llm.op7_quotes import op7_quote_linking
from tallyhouse.llm.op8_sentencepiece import op8_sentencepiece
from tallyhouse.llm.op9_mixing import op9_fair_queue_mix
from tallyhouse.llm.op10_topk import op10_va_file_topk

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_super_kmer_dedup": op2_super_kmer_dedup,
    "op3_min_cut_text": op3_min_cut_text,
    "op4_decision_list": op4_decision_list,
    "op5_boosted_toxicity": op5_boosted_toxicity,
    "op6_tensored_minhash": op6_tensored_minhash,
    "op7_quote_linking": op7_quote_linking,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_fair_queue_mix": op9_fair_queue_mix,
    "op10_va_file_topk": op10_va_file_topk,
    "op11_filter_audit": op11_filter_audit.op11_filter_audit,
    "op12_jaccard_join": op12_jaccard_join.op12_jaccard_join,
    "op13_vector_codes": op13_vector_codes.op13_vector_codes,
}
ORACLES: dict[str, str] = {
    "op9_fair_queue_mix": op9_mixing.oracle(),
    "op10_va_file_topk": op10_topk.oracle(),
    "op11_filter_audit": op11_filter_audit.oracle(),
    "op12_jaccard_join": op12_jaccard_join.oracle(),
    "op13_vector_codes": op13_vector_codes.oracle(),
}
