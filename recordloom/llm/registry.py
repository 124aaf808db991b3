"""The queries of this subpackage and, where SQL can express them, the same in SQL."""

from __future__ import annotations

from . import decontamination, html_extraction, jaccard_join, language_id, lm_scoring, mixing, quality, secret_scan, top_k, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_lm_scoring": lm_scoring.op2_lm_scoring,
        "op3_jaccard_join": jaccard_join.op3_jaccard_join,
        "op4_html_extraction": html_extraction.op4_html_extraction,
        "op5_secret_scan": secret_scan.op5_secret_scan,
        "op6_language_id": language_id.op6_language_id,
        "op7_mix_sources": mixing.op7_mix_sources,
        "op8_top_k": top_k.op8_top_k,
        "op9_decontamination": decontamination.op9_decontamination,
        "op10_quality": quality.op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.OP1_SQL, "op3_jaccard_join": jaccard_join.OP3_SQL, "op8_top_k": top_k.OP8_SQL, "op7_mix_sources": mixing.OP7_SQL}
