"""Registered queries of the operators and of the pipeline."""

from __future__ import annotations

import corpus_pipeline
from scriptorium.llm.dart_minhash import op2_dart_minhash
from scriptorium.llm.decontamination import OP8_SQL, op8_benchmark_decontamination
from scriptorium.llm.embedding_dedup import op7_embedding_dedup
from scriptorium.llm.html_extraction import op5_html_extraction
from scriptorium.llm.language_id import op6_language_id
from scriptorium.llm.lexical_search import OP13_SQL, op13_lexical_search
from scriptorium.llm.lm_scoring import op10_lm_scoring
from scriptorium.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from scriptorium.llm.sentencepiece_encoding import op3_sentencepiece
from scriptorium.llm.sharding import op11_sharding
from scriptorium.llm.token_counts import op1_token_counts
from scriptorium.llm.toxicity import op9_toxicity
from scriptorium.llm.url_filter import op4_url_filter

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_dart_minhash": op2_dart_minhash,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_url_filter": op4_url_filter,
    "op5_html_extraction": op5_html_extraction,
    "op6_language_id": op6_language_id,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_sharding": op11_sharding,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op8_benchmark_decontamination": OP8_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
