"""The operators' registered queries (and the SQL that some of them must equal)."""

from __future__ import annotations

import corpus_pipeline
from flotilla.llm.byte_bpe import op11_byte_bpe
from flotilla.llm.conversation_repair import op12_conversation_repair
from flotilla.llm.decontaminate import op2_decontaminate
from flotilla.llm.langid import op8_language
from flotilla.llm.line_dedup import op9_line_dedup
from flotilla.llm.near_dup import op5_near_duplicates
from flotilla.llm.oracles import ORACLES  # noqa: F401
from flotilla.llm.packing import op3_packing
from flotilla.llm.quality import op6_quality
from flotilla.llm.suffix_dedup import op1_suffix_dedup
from flotilla.llm.token_counts import op7_token_counts
from flotilla.llm.token_store import op4_token_store
from flotilla.llm.toxicity import op10_toxicity
from flotilla.llm.vector_codes import op13_vector_codes

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_packing": op3_packing,
    "op4_token_store": op4_token_store,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_language": op8_language,
    "op9_line_dedup": op9_line_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}
