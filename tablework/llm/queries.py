"""The queries of this folder, and those that SQL can say too."""

from __future__ import annotations

from tablework.llm import (
    decontaminate,
    filter_audit,
    jaccard_join,
    language,
    lexical,
    line_dedup,
    packing,
    paragraph_dedup,
    quality_model,
    quality_rules,
    secrets,
    token_files,
    toxicity,
)

QUERIES = {
    f.__name__: f
    for f in (
        decontaminate.op1_benchmark_decontamination,
        toxicity.op2_toxicity,
        line_dedup.op3_line_dedup,
        packing.op4_best_fit_packing,
        quality_model.op5_quality_classifier,
        secrets.op6_secret_scans,
        language.op7_language_id,
        quality_rules.op8_quality_rules,
        paragraph_dedup.op9_substring_dedup,
        jaccard_join.op10_ngram_jaccard_join,
        lexical.op11_ranked_lexical_search,
        token_files.op12_token_id_output,
        filter_audit.op13_filter_interaction_audit,
    )
}
SQL = {
    "op3_line_dedup": line_dedup.SQL,
    "op11_ranked_lexical_search": lexical.SQL,
    "op13_filter_interaction_audit": filter_audit.SQL,
}
