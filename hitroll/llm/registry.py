"""The queries of this subpackage and their SQL, read by ``__spark_entry__.py``."""

from __future__ import annotations

from hitroll.llm import (chat, collocations, embedding_dedup, html_extract, lexical_search,
                         line_dedup, mixing, ngram_join, packing, pii, quality, secret_scan, suffix_dedup)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_source_mixing": mixing.op2_source_mixing,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_suffix_array_dedup": suffix_dedup.op4_suffix_array_dedup,
    "op5_ngram_jaccard": ngram_join.op5_ngram_jaccard,
    "op6_html_extraction": html_extract.op6_html_extraction,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_embedding_near_dedup": embedding_dedup.op9_embedding_near_dedup,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_collocations": collocations.op11_collocations,
    "op12_pii": pii.op12_pii,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op5_ngram_jaccard": ngram_join.OP5_SQL,
    "op7_chat_formatting": chat.OP7_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "op9_embedding_near_dedup": embedding_dedup.OP9_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
