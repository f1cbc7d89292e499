"""One registered query per operator, over its whole tables."""

from __future__ import annotations

from .bpe_replay import op8_byte_bpe
from .chat_format import op6_chat_format
from .cws import op3_fingerprints
from .divergence import op12_source_divergence
from .exact_dedup import op9_exact_dedup
from .lm import op2_lm_scoring
from .ngram_join import op10_ngram_join
from .packing import op7_packing
from .quality import op5_quality
from .spelling import op11_spelling_variants
from .suffix_dedup import op1_suffix_dedup
from .tensor_minhash import op13_tensor_minhash
from .toxicity import op4_toxicity

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_chat_format": op6_chat_format,
    "op7_packing": op7_packing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_source_divergence": op12_source_divergence,
    "op13_tensor_minhash": op13_tensor_minhash,
}
