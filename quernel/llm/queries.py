"""The subpackage's entries for __spark_entry__: one query per operator and the pipeline, with SQL where SQL can express it."""

from __future__ import annotations

import corpus_pipeline
from quernel.llm import decontamination, html_extraction, language_id, license_scan, lm_scoring, packing, quality_rules, secret_scan, simhash_neardup, warc

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_html_extraction": html_extraction.query,
    "op3_warc": warc.query,
    "op4_secret_scan": secret_scan.query,
    "op5_decontamination": decontamination.query,
    "op6_quality_rules": quality_rules.query,
    "op7_simhash_neardup": simhash_neardup.query,
    "op8_language_id": language_id.query,
    "op9_packing": packing.query,
    "op10_lm_scoring": lm_scoring.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op3_warc": warc.ORACLE,
    "op5_decontamination": decontamination.ORACLE,
}
