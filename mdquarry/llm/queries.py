"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import (fingerprints, licenses, lm_scoring, ngram_join, packing, periods, substrings, token_files, tokens, topk,
               toxicity, whitening)

QUERIES = {f.__name__: f for f in (
    substrings.op1_substring_dedup,
    ngram_join.op2_ngram_jaccard_join,
    fingerprints.op3_fingerprints,
    tokens.op4_bpe_encode_decode,
    tokens.op5_token_counts,
    toxicity.op6_toxicity,
    packing.op7_best_fit_packing,
    licenses.op8_license_scan,
    topk.op9_exact_top_k,
    lm_scoring.op10_lm_scoring,
    whitening.op11_embedding_whitening,
    periods.op12_periodic_runs,
    token_files.op13_token_files,
)}

ORACLES = {"op2_ngram_jaccard_join": ngram_join.OP2_SQL, "op9_exact_top_k": topk.OP9_SQL}
