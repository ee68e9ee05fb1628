"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from strataframe.llm import (
    op1_minhash, op2_jaccard_join, op3_substring_dedup, op4_url_lists, op5_transcripts, op6_bpe_automaton, op7_simple8b,
    op8_quality, op9_decontaminate, op10_pii, op11_secrets, op12_merkle_manifest, op13_periodic_runs,
)

QUERIES = {
    "op1_minhash": op1_minhash.query,
    "op2_jaccard_join": op2_jaccard_join.query,
    "op3_substring_dedup": op3_substring_dedup.query,
    "op4_url_lists": op4_url_lists.query,
    "op5_transcripts": op5_transcripts.query,
    "op6_bpe_automaton": op6_bpe_automaton.query,
    "op7_simple8b": op7_simple8b.query,
    "op8_quality": op8_quality.query,
    "op9_decontaminate": op9_decontaminate.query,
    "op10_pii": op10_pii.query,
    "op11_secrets": op11_secrets.query,
    "op12_merkle_manifest": op12_merkle_manifest.query,
    "op13_periodic_runs": op13_periodic_runs.query,
}
ORACLES: dict[str, str] = {"op4_url_lists": op4_url_lists.SQL, "op12_merkle_manifest": op12_merkle_manifest.SQL}
