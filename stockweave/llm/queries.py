"""The registered queries of this package."""

from __future__ import annotations

from stockweave.llm.alignment import op13_tokenizer_alignment
from stockweave.llm.byte_bpe import op1_byte_bpe
from stockweave.llm.embeddings import op3_embedding_near_dedup
from stockweave.llm.exact_dedup import op5_exact_dedup
from stockweave.llm.filter_audit import op11_filter_audit
from stockweave.llm.html_extract import op2_html_main_text
from stockweave.llm.mixing import op7_mix_sources
from stockweave.llm.personal_data import op12_personal_data
from stockweave.llm.pitman_yor import op8_lm_scoring
from stockweave.llm.quality import op4_quality_classifier
from stockweave.llm.simhash import op10_simhash_near_dedup
from stockweave.llm.token_counts import op9_token_counts
from stockweave.llm.url_filter import op6_url_filter

QUERIES = {
    query.__name__: query
    for query in (
        op1_byte_bpe, op2_html_main_text, op3_embedding_near_dedup, op4_quality_classifier, op5_exact_dedup,
        op6_url_filter, op7_mix_sources, op8_lm_scoring, op9_token_counts, op10_simhash_near_dedup,
        op11_filter_audit, op12_personal_data, op13_tokenizer_alignment,
    )
}
