"""Registered queries of the subpackage and their SQL forms."""

from __future__ import annotations

from . import (
    decontaminate,
    licenses,
    line_dedup,
    line_quality,
    periodic,
    quality_rules,
    secrets,
    sentencepieces,
    sharding,
    simhash,
    spelling,
    token_counts,
    warc,
)

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_shards": sharding.op3_shards,
    "op4_licenses": licenses.op4_licenses,
    "op5_simhash": simhash.op5_simhash,
    "op6_sentencepieces": sentencepieces.op6_sentencepieces,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_line_quality": line_quality.op9_line_quality,
    "op10_warc": warc.op10_warc,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_spelling": spelling.op12_spelling,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}

ORACLE = {
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op7_quality_rules": quality_rules.OP7_SQL,
    "op10_warc": warc.OP10_SQL,
    "op12_spelling": spelling.OP12_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
