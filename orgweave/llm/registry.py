"""Queries of this subpackage, and the DuckDB text of those that SQL can express."""

from . import brown, decontaminate, exact, infill, licenses, lines, passages, periodic, pieces, pii, quality, simhash, toxicity

QUERIES = {
    "op1_quality_rules": quality.op1,
    "op2_toxicity": toxicity.op2,
    "op3_license_scan": licenses.op3,
    "op4_passage_dedup": passages.op4,
    "op5_decontaminate": decontaminate.op5,
    "op6_simhash": simhash.op6,
    "op7_brown_lm": brown.op7,
    "op8_sentencepiece": pieces.op8,
    "op9_line_dedup": lines.op9,
    "op10_pii": pii.op10,
    "op11_exact_dedup": exact.op11,
    "op12_fill_in_middle": infill.op12,
    "op13_periodic_runs": periodic.op13,
}
SQL = {
    "op1_quality_rules": quality.OP1_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op9_line_dedup": lines.OP9_SQL,
    "op11_exact_dedup": exact.OP11_SQL,
    "op12_fill_in_middle": infill.OP12_SQL,
}
