"""Queries of this subpackage: name -> ``fn(spark, sf_dir)``, and their SQL."""

from __future__ import annotations

from .decontam import op4_decontamination
from .hard_negatives import HARD_NEGATIVES_SQL, op11_hard_negatives
from .langid import op9_language_id
from .license_scan import op6_license_scan
from .lm_score import op8_lm_score
from .merkle import MERKLE_SQL, op13_merkle_manifest
from .mixing import MIXING_SQL, op1_mixing
from .ngram_join import op7_ngram_join
from .pii import op12_pii
from .quality_rules import op3_quality_rules
from .rule_ensemble import op10_rule_ensemble
from .tool_calls import TOOL_CALLS_SQL, op5_tool_calls
from .warc import WARC_SQL, op2_warc

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontamination": op4_decontamination,
    "op5_tool_calls": op5_tool_calls,
    "op6_license_scan": op6_license_scan,
    "op7_ngram_join": op7_ngram_join,
    "op8_lm_score": op8_lm_score,
    "op9_language_id": op9_language_id,
    "op10_rule_ensemble": op10_rule_ensemble,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pii": op12_pii,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = {
    "op1_mixing": MIXING_SQL,
    "op2_warc": WARC_SQL,
    "op5_tool_calls": TOOL_CALLS_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
