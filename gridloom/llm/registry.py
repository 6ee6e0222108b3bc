"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import bpe, collocations, conversations, html, language, mixing, near_dedup, neighbours, pii, prefix_table, quality, token_counts, topk


def pipeline(spark, sf_dir):
    import corpus_pipeline  # at the repository's top, above this package

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_html_extraction": html.op1_html_extraction,
    "op2_exact_topk": topk.op2_exact_topk,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_pii": pii.op4_pii,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_bpe": bpe.op6_bpe,
    "op7_mixing": mixing.op7_mixing,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_language_id": language.op9_language_id,
    "op10_quality": quality.op10_quality,
    "op11_collocations": collocations.op11_collocations,
    "op12_sentencepiece": prefix_table.op12_sentencepiece,
    "op13_conversation_repair": conversations.op13_conversation_repair,
    "pipeline": pipeline,
}

SQL = {
    "op2_exact_topk": topk.OP2_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op11_collocations": collocations.OP11_SQL,
}
