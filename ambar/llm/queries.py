"""The registered queries of this package, with their SQL counterparts."""

from __future__ import annotations

from ambar.llm import (
    alignment, decontaminate, hmm, html_text, language_id, near_dup, packing, quality_rules, site_quality, spelling, token_counts, toxicity, warc,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_language_id": language_id.op3_language_id,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_hmm_score": hmm.op5_hmm_score,
    "op6_warc": warc.op6_warc,
    "op7_site_quality": site_quality.op7_site_quality,
    "op8_packing": packing.op8_packing,
    "op9_near_dup": near_dup.op9_near_dup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_spelling": spelling.op11_spelling,
    "op12_html_text": html_text.op12_html_text,
    "op13_alignment": alignment.op13_alignment,
}
ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op6_warc": warc.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
}
