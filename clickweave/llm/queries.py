"""Registered queries of the subpackage and their DuckDB twins. Where SQL
cannot express an operator, tests/llm holds the query against a brute-force
version."""

from __future__ import annotations

from clickweave.llm import (
    divergence, infill, language, licences, minhash, mixing, neighbours, packing, quality, repeats, sharding, simhash, url_filter)

QUERIES = {f.__name__: f for f in (
    simhash.op1_simhash, minhash.op2_minhash, language.op3_language, licences.op4_licences,
    url_filter.op5_url_filter, packing.op6_packing, sharding.op7_sharding, neighbours.op8_neighbours, mixing.op9_mixing,
    repeats.op10_repeats, infill.op12_infill,
    divergence.op13_divergence, quality.op11_quality)}
ORACLE_SQL = {"op4_licences": licences.OP4_SQL, "op5_url_filter": url_filter.OP5_SQL, "op9_mixing": mixing.OP9_SQL,
              "op12_infill": infill.OP12_SQL, "op13_divergence": divergence.OP13_SQL}
