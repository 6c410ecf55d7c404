"""The queries of the operators, by name, and the SQL that checks them."""

from __future__ import annotations

from .chat import op7_repair_chats
from .fingerprints import op5_fingerprint_documents
from .jaccard_join import op8_link_near_texts
from .mixing import op9_mix_sources
from .packing import op2_pack_documents
from .passages import SQL as PASSAGES_SQL
from .passages import op12_remove_passages
from .pii import op10_find_personal_data
from .quality import op3_quality_votes
from .ranked_search import SQL as RANKED_SQL
from .ranked_search import op13_rank_documents
from .sharding import op4_shard_documents
from .substrings import op6_remove_repeats
from .token_counts import op1_count_tokens
from .whitening import op11_whiten_embeddings

QUERIES = {
    "op1_count_tokens": op1_count_tokens,
    "op2_pack_documents": op2_pack_documents,
    "op3_quality_votes": op3_quality_votes,
    "op4_shard_documents": op4_shard_documents,
    "op5_fingerprint_documents": op5_fingerprint_documents,
    "op6_remove_repeats": op6_remove_repeats,
    "op7_repair_chats": op7_repair_chats,
    "op8_link_near_texts": op8_link_near_texts,
    "op9_mix_sources": op9_mix_sources,
    "op10_find_personal_data": op10_find_personal_data,
    "op11_whiten_embeddings": op11_whiten_embeddings,
    "op12_remove_passages": op12_remove_passages,
    "op13_rank_documents": op13_rank_documents,
}

ORACLE: dict[str, str] = {
    "op12_remove_passages": PASSAGES_SQL,
    "op13_rank_documents": RANKED_SQL,
}
