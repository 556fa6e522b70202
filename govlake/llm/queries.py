"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import functools

from . import alignment, automaton, ball_tree, contamination, jaccard, packing, pii, quality, secrets, sharding, substring, token_counts, warc
from .stage import importable


def _query(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        importable(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {
    "op1_secret_scan": secrets.q_op1,
    "op2_pack_documents": packing.q_op2,
    "op3_substring_dedup": substring.q_op3,
    "op4_hilbert_shards": sharding.q_op4,
    "op5_host_quality": quality.q_op5,
    "op6_pii_spans": pii.q_op6,
    "op7_token_counts": token_counts.q_op7,
    "op8_jaccard_components": jaccard.q_op8,
    "op9_benchmark_contamination": contamination.q_op9,
    "op10_warc_round_trip": warc.q_op10,
    "op11_ball_tree_search": ball_tree.q_op11,
    "op12_token_alignment": alignment.q_op12,
    "op13_bpe_automaton": automaton.q_op13,
}
QUERIES = {name: _query(fn) for name, fn in QUERIES.items()}

ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": substring.SQL_OP3,
    "op5_host_quality": quality.SQL_OP5,
    "op8_jaccard_components": jaccard.SQL_OP8,
    "op9_benchmark_contamination": contamination.SQL_OP9,
    "op11_ball_tree_search": ball_tree.SQL_OP11,
}
