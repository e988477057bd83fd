"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from fleetlens.llm import op1_substring_dedup as op1
from fleetlens.llm import op2_language_id as op2
from fleetlens.llm import op3_lm_score as op3
from fleetlens.llm import op4_mix_sources as op4
from fleetlens.llm import op5_decontaminate as op5
from fleetlens.llm import op6_toxicity as op6
from fleetlens.llm import op7_minhash_dedup as op7
from fleetlens.llm import op8_embedding_dedup as op8
from fleetlens.llm import op9_html_extract as op9
from fleetlens.llm import op10_quality as op10
from fleetlens.llm import op11_fill_middle as op11
from fleetlens.llm import op12_spelling_variants as op12
from fleetlens.llm import op13_packing as op13

QUERIES = {
    "op1_substring_dedup": op1.op1_substring_dedup,
    "op2_language_id": op2.op2_language_id,
    "op3_lm_score": op3.op3_lm_score,
    "op4_mix_sources": op4.op4_mix_sources,
    "op5_decontaminate": op5.op5_decontaminate,
    "op6_toxicity": op6.op6_toxicity,
    "op7_minhash_dedup": op7.op7_minhash_dedup,
    "op8_embedding_dedup": op8.op8_embedding_dedup,
    "op9_html_extract": op9.op9_html_extract,
    "op10_quality": op10.op10_quality,
    "op11_fill_middle": op11.op11_fill_middle,
    "op12_spelling_variants": op12.op12_spelling_variants,
    "op13_packing": op13.op13_packing,
}
#: What SQL can't express is tested against brute force and held-out labels.
ORACLES = {
    "op1_substring_dedup": op1.SQL,
    "op4_mix_sources": op4.SQL,
    "op5_decontaminate": op5.SQL,
    "op7_minhash_dedup": op7.SQL,
    "op8_embedding_dedup": op8.SQL,
    "op11_fill_middle": op11.SQL,
    "op12_spelling_variants": op12.SQL,
}
