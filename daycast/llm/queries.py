"""Registry of the operators' queries and their DuckDB SQL."""

from __future__ import annotations

from daycast.llm import (alignment, chat, classifier, covertree, jaccard, mixing, neighbours, pages, pieces, quality, secrets,
                         substring, whitening)

QUERIES = {
    "op1_chat": chat.op1_chat,
    "op2_substring": substring.op2_substring,
    "op3_quality": quality.op3_quality,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_pieces": pieces.op5_pieces,
    "op6_pages": pages.op6_pages,
    "op7_secrets": secrets.op7_secrets,
    "op8_neighbours": neighbours.op8_neighbours,
    "op9_classifier": classifier.op9_classifier,
    "op10_mixing": mixing.op10_mixing,
    "op11_whitening": whitening.op11_whitening,
    "op12_alignment": alignment.op12_alignment,
    "op13_neardups": covertree.op13_neardups,
}

ORACLE = {
    "op1_chat": chat.OP1_SQL,
    "op2_substring": substring.OP2_SQL,
    "op4_jaccard": jaccard.OP4_SQL,
}
