"""The registered queries of these operators, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from brasstally.llm.conversation_trie import OP12_SQL, op12_conversation_trie
from brasstally.llm.embedding_dedup import OP2_SQL, op2_embedding_dedup
from brasstally.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from brasstally.llm.html_extract import op6_html_extract
from brasstally.llm.language_id import op7_language_id
from brasstally.llm.lexical_search import OP13_SQL, op13_lexical_search
from brasstally.llm.mixing import OP1_SQL, op1_mix_sources
from brasstally.llm.packing import op8_packing
from brasstally.llm.pii import op3_pii
from brasstally.llm.secrets import op10_secret_scan
from brasstally.llm.simhash import op4_simhash
from brasstally.llm.substring_dedup import op9_substring_dedup
from brasstally.llm.toxicity import op11_toxicity

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_language_id": op7_language_id,
    "op8_packing": op8_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE = {
    "op1_mix_sources": OP1_SQL,
    "op2_embedding_dedup": OP2_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op12_conversation_trie": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
