"""Registered queries of this package and their SQL."""

from __future__ import annotations

from trilayer.llm.chat import OP8_SQL, op8_chat_formatting
from trilayer.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from trilayer.llm.fingerprints import op2_fingerprints
from trilayer.llm.merkle import op11_merkle_manifest
from trilayer.llm.mixing import op9_mixing
from trilayer.llm.near_dedup import op10_near_dedup
from trilayer.llm.neighbours import op13_nearest_neighbours
from trilayer.llm.packing import op7_packing
from trilayer.llm.spelling import op12_spelling_variants
from trilayer.llm.token_count import op5_token_counts
from trilayer.llm.toxicity import op3_toxicity
from trilayer.llm.url_filter import OP1_SQL, op1_url_filter
from trilayer.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_mixing": op9_mixing,
    "op10_near_dedup": op10_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

#: Hashes of Spark's own, learned scores, the tokenizers and raking have no SQL.
ORACLE_SQL = {
    "op1_url_filter": OP1_SQL,
    "op4_warc": OP4_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op8_chat_formatting": OP8_SQL,
}
