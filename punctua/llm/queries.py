"""Registered queries of the training-data operators."""

from punctua.llm import chats, lines, ranking, rules
from punctua.llm.bpe import op2_byte_bpe
from punctua.llm.codes import op6_token_codes
from punctua.llm.minhash import op4_near_duplicates
from punctua.llm.pii import op10_pii
from punctua.llm.pivots import op7_near_vectors
from punctua.llm.postings import op9_decontamination
from punctua.llm.quality import op5_quality
from punctua.llm.runs import op13_periodic_runs
from punctua.llm.shards import op3_sharding

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_sharding": op3_sharding,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_quality": op5_quality,
    "op6_token_codes": op6_token_codes,
    "op7_near_vectors": op7_near_vectors,
    "op8_chat_formatting": chats.op8_chat_formatting,
    "op9_decontamination": op9_decontamination,
    "op10_pii": op10_pii,
    "op11_quality_rules": rules.op11_quality_rules,
    "op12_lexical_search": ranking.op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}

# The others have no plain SQL: they are tested against brute force.
SQL = {
    "op1_line_dedup": lines.SQL,
    "op8_chat_formatting": chats.SQL,
    "op11_quality_rules": rules.SQL,
    "op12_lexical_search": ranking.SQL,
}
