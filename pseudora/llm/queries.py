"""The registered queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from . import bits, fingerprints, mixing, packing, pii, quality, rules, simhash, urls, warc

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_fingerprints": fingerprints.op2_fingerprints,
    "op3_simhash": simhash.op3_simhash,
    "op4_quality": quality.op4_quality,
    "op5_quality_rules": rules.op5_quality_rules,
    "op6_pii": pii.op6_pii,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_url_filter": urls.op8_url_filter,
    "op9_token_ids": bits.op9_token_ids,
    "op10_warc": warc.op10_warc,
}
ORACLES = {"op1_mix_sources": mixing.ORACLE, "op5_quality_rules": rules.ORACLE, "op10_warc": warc.ORACLE}
