"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from nightgrid.llm.bpe import op2_bpe
from nightgrid.llm.decontamination import OP5_SQL, op5_decontamination
from nightgrid.llm.language_id import op6_language_id
from nightgrid.llm.lm_scoring import op13_lm_scoring
from nightgrid.llm.pii import op7_pii
from nightgrid.llm.prefix_trie import op12_conversation_prefix_trie
from nightgrid.llm.quality import OP4_SQL, op4_quality_rules
from nightgrid.llm.simhash import op1_simhash_near_dedup
from nightgrid.llm.substring_dedup import op10_substring_dedup
from nightgrid.llm.token_counts import op9_token_counts
from nightgrid.llm.warc import OP3_SQL, op3_warc
from nightgrid.llm.url_filter import OP8_SQL, op8_url_filters
from nightgrid.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_bpe": op2_bpe,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_url_filters": op8_url_filters,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_lm_scoring": op13_lm_scoring,
}
SQL = {"op3_warc": OP3_SQL, "op4_quality_rules": OP4_SQL, "op5_decontamination": OP5_SQL, "op8_url_filters": OP8_SQL}
