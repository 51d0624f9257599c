"""Queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

import corpus_pipeline
from vesselflow.llm import fill_middle, html_text, image_match, jaccard, licenses, line_dedup, mixing, packing, quality, suffix_dedup, url_filter, wavelet, whitening


def queries():
    return {
        "op1_mix_sources": mixing.op1_mix_sources,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_best_fit_packing": packing.op4_best_fit_packing,
        "op5_quality_rules": quality.op5_quality_rules,
        "op6_image_copies": image_match.op6_image_copies,
        "op7_license_scan": licenses.op7_license_scan,
        "op8_html_text": html_text.op8_html_text,
        "op9_ngram_jaccard": jaccard.op9_ngram_jaccard,
        "op10_url_filter": url_filter.op10_url_filter,
        "op11_embedding_whitening": whitening.op11_embedding_whitening,
        "op12_token_files": wavelet.op12_token_files,
        "op13_fill_in_middle": fill_middle.op13_fill_in_middle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql():
    return {**url_filter.SQL, **fill_middle.SQL}
