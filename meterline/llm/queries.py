"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from .bpe import op10_bpe_codec
from .conversations import op12_conversation_repair
from .exact import OP2_SQL, op2_exact_dedup
from .line_templates import OP8_SQL, op8_line_templates
from .minhash import op5_minhash_near_dedup
from .packing import op3_best_fit_packing
from .pii import op13_pii
from .repetition import op9_repetition_rules
from .search import OP11_SQL, op11_ranked_search
from .substring import op6_substring_dedup
from .suffix_array import op1_suffix_array_dedup
from .toxicity import op7_toxicity
from .warc import OP4_SQL, op4_warc

QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_exact_dedup, op3_best_fit_packing, op4_warc,
    op5_minhash_near_dedup, op6_substring_dedup, op7_toxicity,
    op8_line_templates,
    op9_repetition_rules, op10_bpe_codec, op11_ranked_search, op12_conversation_repair, op13_pii,
)}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op4_warc": OP4_SQL,
    "op8_line_templates": OP8_SQL,
    "op11_ranked_search": OP11_SQL,
}
