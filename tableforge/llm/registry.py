"""Queries of the corpus operators, by name."""

from tableforge.llm.bpe import op7_bpe_encode_decode
from tableforge.llm.dedup import op8_minhash_near_dedup
from tableforge.llm.langid import op10_language_id
from tableforge.llm.license import op1_license_scan
from tableforge.llm.line_rules import op6_line_frequency_rules
from tableforge.llm.media import op4_telephony_audio
from tableforge.llm.oracles import ORACLES
from tableforge.llm.packing import op2_best_fit_packing
from tableforge.llm.parity_join import op13_parity_sketch_join
from tableforge.llm.quality_crf import op5_line_crf_quality
from tableforge.llm.secret_scan import op3_secret_scan
from tableforge.llm.spelling import op11_spelling_variants
from tableforge.llm.toxicity import op9_toxicity
from tableforge.llm.whitening import op12_embedding_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_best_fit_packing, op3_secret_scan, op4_telephony_audio, op5_line_crf_quality,
        op6_line_frequency_rules, op7_bpe_encode_decode, op8_minhash_near_dedup, op9_toxicity, op10_language_id,
        op11_spelling_variants, op12_embedding_whitening, op13_parity_sketch_join,
    )
}
#: The other results hold values of trained models, token ids, hashes of media or matches of patterns with look-ahead;
#: tests/llm holds every query against a brute-force version, an exact round trip or held-out accuracy.
__all__ = ["ORACLES", "QUERIES"]
