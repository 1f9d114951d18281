"""The registered queries of this subpackage."""

from vintara.llm.bpe import op8_bpe_round_trip
from vintara.llm.divergence import op11_source_divergence_audit
from vintara.llm.exact_dedup import op2_exact_dedup
from vintara.llm.jaccard import op5_ngram_jaccard_join
from vintara.llm.line_dedup import op7_line_dedup
from vintara.llm.minhash import op13_minhash_near_dedup
from vintara.llm.packing import op4_best_fit_packing
from vintara.llm.quality import op10_quality_rules
from vintara.llm.substring import op3_substring_dedup
from vintara.llm.tokens import op1_token_counts
from vintara.llm.toxicity import op9_toxicity
from vintara.llm.vector_codes import op12_vector_code_compression
from vintara.llm.warc import op6_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_exact_dedup,
        op3_substring_dedup,
        op4_best_fit_packing,
        op5_ngram_jaccard_join,
        op6_warc,
        op7_line_dedup,
        op8_bpe_round_trip,
        op9_toxicity,
        op10_quality_rules,
        op11_source_divergence_audit,
        op12_vector_code_compression,
        op13_minhash_near_dedup,
    )
}
