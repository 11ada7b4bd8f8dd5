"""The registered queries of the numbered operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, divergence, exact, forest, licenses, mixing, packing, pieces, private, quality, rules, tokens, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_forest": forest.op1_minhash_forest,
    "op2_exact_dedup": exact.op2_exact_dedup,
    "op3_url_filter": urls.op3_url_filter,
    "op4_token_ids": tokens.op4_token_ids,
    "op5_licenses": licenses.op5_licenses,
    "op6_pieces": pieces.op6_pieces,
    "op7_private": private.op7_private,
    "op8_quality": quality.op8_quality,
    "op9_quality_rules": rules.op9_quality_rules,
    "op10_mixing": mixing.op10_mixing,
    "op11_divergence": divergence.op11_divergence,
    "op12_packing": packing.op12_packing,
    "op13_alignment": alignment.op13_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_minhash_forest": forest.OP1_SQL,
    "op2_exact_dedup": exact.OP2_SQL,
    "op3_url_filter": urls.OP3_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_divergence": divergence.OP11_SQL,
}
