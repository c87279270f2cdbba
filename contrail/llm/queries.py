"""Registered queries of this package and their SQL, by name."""

from __future__ import annotations

from contrail.llm import audit, decontam, extraction, jaccard, langid, licenses, maxent, mixing, omh, periodic, quality, suffix, warc

QUERIES = {
    "op1_warc": warc.query,
    "op2_quality": quality.query,
    "op3_order_minhash": omh.query,
    "op4_licenses": licenses.query,
    "op5_extraction": extraction.query,
    "op6_language": langid.query,
    "op7_suffix_dedup": suffix.query,
    "op8_mixing": mixing.query,
    "op9_jaccard_join": jaccard.query,
    "op10_decontamination": decontam.query,
    "op11_maxent": maxent.query,
    "op12_periodic_runs": periodic.query,
    "op13_filter_audit": audit.query,
}

ORACLES = {"op8_mixing": mixing.ORACLE, "op10_decontamination": decontam.ORACLE, "op13_filter_audit": audit.ORACLE}
