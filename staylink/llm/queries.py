"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (byte_bpe, embeddings, extract, jaccard, merkle, mixing, ngram_lm, quality, token_counts, token_files, toxicity,
               urls, whitening)

QUERIES = {
    "op1_near_dedup": embeddings.op1_near_dedup,
    "op2_url_filter": urls.op2_url_filter,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_extract": extract.op4_extract,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_lm_scores": ngram_lm.op6_lm_scores,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_ngram_jaccard": jaccard.op9_ngram_jaccard,
    "op10_mixing": mixing.op10_mixing,
    "op11_whitening": whitening.op11_whitening,
    "op12_token_files": token_files.op12_token_files,
    "op13_merkle": merkle.op13_merkle,
}
ORACLE = {"op2_url_filter": urls.oracle_sql(), "op10_mixing": mixing.ORACLE_SQL,
          "op13_merkle": merkle.oracle_sql()}
