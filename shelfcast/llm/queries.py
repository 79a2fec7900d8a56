"""The queries of the language-model operators and their SQL twins."""

from __future__ import annotations

from shelfcast.llm.chat import OP7_SQL, op7_chat
from shelfcast.llm.decontaminate import OP10_SQL, op10_decontamination
from shelfcast.llm.language import op3_language
from shelfcast.llm.pieces import op5_pieces
from shelfcast.llm.privacy import op8_pii
from shelfcast.llm.quality import op4_quality
from shelfcast.llm.simhash import op6_simhash
from shelfcast.llm.tokens import op1_token_counts
from shelfcast.llm.topk import OP2_SQL, op2_topk
from shelfcast.llm.toxicity import op9_toxicity
from shelfcast.llm.vectorcodes import OP12_SQL, op12_vector_codes
from shelfcast.llm.whitening import op11_whitening
from shelfcast.llm.wordbpe import op13_word_bpe

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_topk": op2_topk,
    "op3_language": op3_language,
    "op4_quality": op4_quality,
    "op5_pieces": op5_pieces,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_word_bpe": op13_word_bpe,
}
ORACLE_SQL = {
    "op2_topk": OP2_SQL,
    "op7_chat": OP7_SQL,
    "op10_decontamination": OP10_SQL,
    "op12_vector_codes": OP12_SQL,
}
