"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from velolake.llm.bpe import op10_bpe
from velolake.llm.decontamination import op9_decontamination
from velolake.llm.gru_lm import op7_gru_lm
from velolake.llm.language_id import op4_language_id
from velolake.llm.lexical_search import OP12_SQL, op12_lexical_search
from velolake.llm.line_dedup import OP5_SQL, op5_line_dedup
from velolake.llm.minhash import op2_fingerprint
from velolake.llm.quality import op11_quality
from velolake.llm.resampling import OP13_SQL, op13_importance_resampling
from velolake.llm.secrets import op1_secrets
from velolake.llm.simhash import op6_simhash
from velolake.llm.suffix_dedup import OP8_SQL, op8_suffix_dedup
from velolake.llm.token_counts import op3_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_fingerprint": op2_fingerprint,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_gru_lm": op7_gru_lm,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_quality": op11_quality,
    "op12_lexical_search": op12_lexical_search,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op5_line_dedup": OP5_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
