"""The fourteen registered queries of this folder and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (
    block_ann, document_tree, exact_dedup, fill_in_middle, lattice_lm, line_quality, ngram_join, packing, pii, sentencepiece_codec, string_kernel, substring_dedup,
    suffix_levels,
)


def queries() -> dict:
    return {
        "op1_sentencepiece": sentencepiece_codec.query,
        "op2_block_ann": block_ann.query,
        "op3_substring_dedup": substring_dedup.query,
        "op4_pii": pii.query,
        "op5_ngram_join": ngram_join.query,
        "op6_best_fit_packing": packing.query,
        "op7_suffix_levels": suffix_levels.query,
        "op8_line_quality": line_quality.query,
        "op9_lattice_lm": lattice_lm.query,
        "op10_exact_dedup": exact_dedup.query,
        "op11_document_tree": document_tree.query,
        "op12_string_kernel": string_kernel.query,
        "op13_fill_in_middle": fill_in_middle.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return pipeline | {
        "op2_block_ann": block_ann.SQL,
        "op3_substring_dedup": substring_dedup.SQL,
        "op4_pii": pii.SQL,
        "op5_ngram_join": ngram_join.SQL,
        "op7_suffix_levels": suffix_levels.SQL,
        "op10_exact_dedup": exact_dedup.SQL,
        "op11_document_tree": document_tree.SQL,
        "op13_fill_in_middle": fill_in_middle.SQL,
    }
