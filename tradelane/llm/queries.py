"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tradelane.llm.chat_format import SQL as CHAT_SQL
from tradelane.llm.chat_format import op5_chat_formatting
from tradelane.llm.fingerprints import op1_document_fingerprints
from tradelane.llm.minhash_dedup import op9_minhash_near_dedup
from tradelane.llm.packing import op10_best_fit_packing
from tradelane.llm.periodic_runs import op13_periodic_runs
from tradelane.llm.quality_classifier import op4_quality_classifier
from tradelane.llm.quality_rules import SQL as RULES_SQL
from tradelane.llm.quality_rules import op3_quality_rules
from tradelane.llm.sentencepiece_viterbi import op7_sentencepiece_viterbi
from tradelane.llm.suffix_dedup import op2_suffix_array_dedup
from tradelane.llm.url_filter import SQL as URL_SQL
from tradelane.llm.url_filter import op6_url_filters
from tradelane.llm.vector_codes import SQL as CODES_SQL
from tradelane.llm.vector_codes import op11_vector_codes
from tradelane.llm.warc import SQL as WARC_SQL
from tradelane.llm.warc import op8_warc_segments
from tradelane.llm.window_dedup import SQL as WINDOWS_SQL
from tradelane.llm.window_dedup import op12_window_dedup

QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_suffix_array_dedup,
        op3_quality_rules,
        op4_quality_classifier,
        op5_chat_formatting,
        op6_url_filters,
        op7_sentencepiece_viterbi,
        op8_warc_segments,
        op9_minhash_near_dedup,
        op10_best_fit_packing,
        op11_vector_codes,
        op12_window_dedup,
        op13_periodic_runs,
    )
}

ORACLE: dict[str, str] = {
    "op3_quality_rules": RULES_SQL,
    "op5_chat_formatting": CHAT_SQL,
    "op6_url_filters": URL_SQL,
    "op8_warc_segments": WARC_SQL,
    "op11_vector_codes": CODES_SQL,
    "op12_window_dedup": WINDOWS_SQL,
}
