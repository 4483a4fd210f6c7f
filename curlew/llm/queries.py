"""The queries of the training-data operators and their SQL, by name."""

from __future__ import annotations

from curlew.llm.decontaminate import op3_greedy_string_tiling
from curlew.llm.lm import op4_gru_lm
from curlew.llm.near_dups import op8_minhash_bayes
from curlew.llm.packing import op2_best_fit_packing
from curlew.llm.quality import OP10_SQL, op10_host_quality_rules
from curlew.llm.repeats import op5_repeated_strings
from curlew.llm.sharding import op7_minimax_sharding
from curlew.llm.token_store import op1_token_store
from curlew.llm.toxicity import op9_nb_toxicity
from curlew.llm.url_filter import OP6_SQL, op6_host_reputation

QUERIES = {f.__name__: f for f in (op1_token_store, op2_best_fit_packing, op3_greedy_string_tiling, op4_gru_lm, op5_repeated_strings, op6_host_reputation, op7_minimax_sharding, op8_minhash_bayes, op9_nb_toxicity, op10_host_quality_rules)}
ORACLE_SQL = {"op6_host_reputation": OP6_SQL, "op10_host_quality_rules": OP10_SQL}
