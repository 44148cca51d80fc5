"""The package's registered queries, ``(spark, folder) -> DataFrame``, and SQL for those SQL can express."""

from scorelake.llm import bpe, fixity, language, line_dedup, near_dedup, ngrams, packing, periods, pseudonyms, quality, resampling, shards, topk

QUERIES = {
    "op1_bag_minhash": near_dedup.op1_bag_minhash,
    "op2_backtracking_bpe": bpe.op2_backtracking_bpe,
    "op3_bit_sliced_topk": topk.op3_bit_sliced_topk,
    "op4_merkle_fixity": fixity.op4_merkle_fixity,
    "op5_feistel_pseudonyms": pseudonyms.op5_feistel_pseudonyms,
    "op6_compression_bands": quality.op6_compression_bands,
    "op7_exact_complement_packing": packing.op7_exact_complement_packing,
    "op8_kneser_ney": language.op8_kneser_ney,
    "op9_line_runs": line_dedup.op9_line_runs,
    "op10_feistel_shards": shards.op10_feistel_shards,
    "op11_head_tail_resampling": resampling.op11_head_tail_resampling,
    "op12_kneser_ney_scores": ngrams.op12_kneser_ney_scores,
    "op13_dyadic_runs": periods.op13_dyadic_runs,
}
ORACLE = {
    "op3_bit_sliced_topk": topk.ORACLE_SQL,
    "op4_merkle_fixity": fixity.ORACLE_SQL,
    "op9_line_runs": line_dedup.ORACLE_SQL,
    "op11_head_tail_resampling": resampling.ORACLE_SQL,
}
