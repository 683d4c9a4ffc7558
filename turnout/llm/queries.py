"""The queries of the training-data operators, and their SQL."""

from __future__ import annotations

from . import centroids, decontaminate, embeddings, jaccard, langid, licenses, logbilinear, mixing, pii, prefixtrie, substrings, tokens, warc

QUERIES = {
    "op1_ngram_jaccard_join": jaccard.query,
    "op2_embedding_near_dedup": embeddings.query,
    "op3_substring_dedup": substrings.query,
    "op4_token_counts": tokens.query,
    "op5_pii": pii.query,
    "op6_license_scan": licenses.query,
    "op7_benchmark_decontamination": decontaminate.query,
    "op8_source_mixing": mixing.query,
    "op9_language_id": langid.query,
    "op10_warc_zstd": warc.query,
    "op11_centroid_clustering": centroids.query,
    "op12_lm_scoring": logbilinear.query,
    "op13_prefix_trie": prefixtrie.query,
}
SQL = {
    "op1_ngram_jaccard_join": jaccard.SQL,
    "op2_embedding_near_dedup": embeddings.SQL,
    "op7_benchmark_decontamination": decontaminate.SQL,
    "op8_source_mixing": mixing.SQL,
    "op10_warc_zstd": warc.SQL,
    "op11_centroid_clustering": centroids.SQL,
    "op13_prefix_trie": prefixtrie.SQL,
}


def registry():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
