"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from tenurecast.llm.alignment import op11_token_alignment
from tenurecast.llm.brown import op9_class_ngram_score
from tenurecast.llm.chat import OP6_SQL, op6_chat_format
from tenurecast.llm.divergence import OP13_SQL, op13_source_divergence
from tenurecast.llm.fingerprint import op4_document_fingerprints
from tenurecast.llm.jaccard import OP8_SQL, op8_ngram_jaccard_join
from tenurecast.llm.language import op10_language_id
from tenurecast.llm.packing import op1_best_fit_packing
from tenurecast.llm.pieces import op5_sampled_pieces
from tenurecast.llm.quality import op7_quality_rules
from tenurecast.llm.secrets import op2_secret_scan
from tenurecast.llm.slack import op12_slack_packing
from tenurecast.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_warc": op3_warc,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_sampled_pieces": op5_sampled_pieces,
    "op6_chat_format": op6_chat_format,
    "op7_quality_rules": op7_quality_rules,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_class_ngram_score": op9_class_ngram_score,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_slack_packing": op12_slack_packing,
    "op13_source_divergence": op13_source_divergence,
}

#: The others learn, tokenize or link spans, which SQL does not express; they are tested
#: against brute force, exact round trips or held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op3_warc": OP3_SQL,
    "op6_chat_format": OP6_SQL,
    "op8_ngram_jaccard_join": OP8_SQL,
    "op13_source_divergence": OP13_SQL,
}
