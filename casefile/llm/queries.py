"""The package's registered queries and, where SQL can state them, their oracles."""

from __future__ import annotations

from casefile.llm.chat_format import OP2_SQL, op2_chat_format
from casefile.llm.lang_id import op9_language_id
from casefile.llm.mil_quality import op1_quality
from casefile.llm.periodic_runs import op12_periodic_runs
from casefile.llm.phrase_index import OP7_SQL, op7_decontamination
from casefile.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from casefile.llm.sentencepiece_codec import op6_sentencepiece
from casefile.llm.simhash_dedup import op4_simhash
from casefile.llm.spot_signatures import OP13_SQL, op13_spot_signatures
from casefile.llm.suffix_rules import OP5_SQL, op5_repetition
from casefile.llm.toxicity import op10_toxicity
from casefile.llm.url_filter import op3_url_filter
from casefile.llm.weak_pii import op8_pii

QUERIES = {
    "op1_quality": op1_quality,
    "op2_chat_format": op2_chat_format,
    "op3_url_filter": op3_url_filter,
    "op4_simhash": op4_simhash,
    "op5_repetition": op5_repetition,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_decontamination": op7_decontamination,
    "op8_pii": op8_pii,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spot_signatures": op13_spot_signatures,
}
ORACLES = {
    "op2_chat_format": OP2_SQL,
    "op5_repetition": OP5_SQL,
    "op7_decontamination": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_spot_signatures": OP13_SQL,
}
