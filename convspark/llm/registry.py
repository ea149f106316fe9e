"""Queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from . import chat_format, decontamination, exact_dedup, fill_in_middle, html_extraction, licences, line_dedup, mixing, ngram_join, prefix_trie, quality, suffix_tree, token_files


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_tree": suffix_tree.op1_suffix_tree,
    "op2_licence_scan": licences.op2_licence_scan,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_chat_round_trip": chat_format.op4_chat_round_trip,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_rule_ensemble": quality.op6_rule_ensemble,
    "op7_content_sort_dedup": exact_dedup.op7_content_sort_dedup,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op8_line_dedup_shortest_runs": line_dedup.op8_line_dedup_shortest_runs,
    "op9_water_filling": mixing.op9_water_filling,
    "op10_token_files": token_files.op10_token_files,
    "op11_html_extraction": html_extraction.op11_html_extraction,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
    "pipeline": pipeline,
}

ORACLE_SQL = {
    "op3_decontamination": decontamination.ORACLE,
    "op4_chat_round_trip": chat_format.ORACLE,
    "op5_ngram_join": ngram_join.ORACLE,
    "op7_content_sort_dedup": exact_dedup.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op8_line_dedup_shortest_runs": line_dedup.ORACLE_SHORTEST,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_fill_in_middle": fill_in_middle.ORACLE,
}
