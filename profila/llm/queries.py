"""The registered queries of the training-data operators."""

from __future__ import annotations

from . import codes, decontaminate, licenses, lines, mixing, neighbours, pieces, runs, sanitise, sharding, simhash, substrings, toxicity

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_licenses": licenses.query,
    "op3_mixing": mixing.query,
    "op4_lines": lines.query,
    "op5_sharding": sharding.query,
    "op6_neighbours": neighbours.query,
    "op7_decontamination": decontaminate.query,
    "op8_sanitisation": sanitise.query,
    "op9_substrings": substrings.query,
    "op10_simhash": simhash.query,
    "op11_runs": runs.query,
    "op12_pieces": pieces.query,
    "op13_codes": codes.query,
}

#: The others have no SQL: learned scores, edit distances, alignments and
#: digests; tests/llm holds each against brute force.
ORACLE_SQL = {
    "op3_mixing": mixing.oracle_sql(),
    "op6_neighbours": neighbours.oracle_sql(),
    "op11_runs": runs.oracle_sql(),
    "op13_codes": codes.oracle_sql(),
}
