"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run
from tetraframe.llm.fingerprints import op1_fingerprints
from tetraframe.llm.katz import op3_katz
from tetraframe.llm.langid import op6_language_id
from tetraframe.llm.long_matches import op4_suffix_dedup
from tetraframe.llm.merkle import OP13_SQL, op13_merkle
from tetraframe.llm.mixing import op8_mixing
from tetraframe.llm.near_dedup import op7_near_dedup
from tetraframe.llm.packing import op10_packing
from tetraframe.llm.periodic import op12_periodic_runs
from tetraframe.llm.sharding import op11_sharding
from tetraframe.llm.token_counts import op9_token_counts
from tetraframe.llm.topk import OP5_SQL, op5_topk_search
from tetraframe.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_toxicity": op2_toxicity,
    "op3_katz": op3_katz,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_topk_search": op5_topk_search,
    "op6_language_id": op6_language_id,
    "op7_near_dedup": op7_near_dedup,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_sharding": op11_sharding,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle": op13_merkle,
    "pipeline": run,
}
ORACLES: dict[str, str] = {"op5_topk_search": OP5_SQL, "op13_merkle": OP13_SQL}
if ORACLE_SQL is not None:
    ORACLES["pipeline"] = ORACLE_SQL
