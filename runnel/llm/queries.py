"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from runnel.llm.ann_search import op7_ann_search
from runnel.llm.chat_format import OP3_SQL, op3_chat_format
from runnel.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from runnel.llm.html_extract import op5_html_extract
from runnel.llm.importance_resampling import OP12_SQL, op12_importance_resampling
from runnel.llm.language_id import op4_language_id
from runnel.llm.near_dedup import OP8_SQL, op8_near_dedup
from runnel.llm.packing import op10_pack
from runnel.llm.pu_toxicity import op13_toxicity
from runnel.llm.source_divergence import OP11_SQL, op11_source_divergence
from runnel.llm.source_mix import OP6_SQL, op6_source_mix
from runnel.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from runnel.llm.token_files import op9_token_files

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_language_id": op4_language_id,
    "op5_html_extract": op5_html_extract,
    "op6_source_mix": op6_source_mix,
    "op7_ann_search": op7_ann_search,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_files": op9_token_files,
    "op10_pack": op10_pack,
    "op11_source_divergence": op11_source_divergence,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_toxicity": op13_toxicity,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op2_substring_dedup": OP2_SQL,
    "op3_chat_format": OP3_SQL,
    "op6_source_mix": OP6_SQL,
    "op8_near_dedup": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_importance_resampling": OP12_SQL,
}
