"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from framelight.llm import dedup, html_text, knn, language, mixing, packing, secret_scan, tokens, toxicity, vector_dedup

QUERIES = {
    "op1_voronoi_knn": knn.op1_voronoi_knn,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_html_extraction": html_text.op3_html_extraction,
    "op4_token_counts": tokens.op4_token_counts,
    "op5_minhash_dedup": dedup.op5_minhash_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_packing": packing.op7_packing,
    "op8_language_id": language.op8_language_id,
    "op9_embedding_dedup": vector_dedup.op9_embedding_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
}
ORACLE_SQL = {"op1_voronoi_knn": knn.OP1_SQL, "op5_minhash_dedup": dedup.OP5_SQL, "op6_mixing": mixing.OP6_SQL, "op9_embedding_dedup": vector_dedup.OP9_SQL}
