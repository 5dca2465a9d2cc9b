"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodeweave.llm import cuckoo, imatch, line_dedup, mixing, ngram_join, packing, ppm, quality, toxicity, wordpiece


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixture_pack": packing.op1_mixture_pack,
        "op2_gam_quality": quality.op2_gam_quality,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_weak_toxicity": toxicity.op4_weak_toxicity,
        "op5_imatch": imatch.op5_imatch,
        "op6_wordpiece_counts": wordpiece.op6_wordpiece_counts,
        "op7_cuckoo_dedup": cuckoo.op7_cuckoo_dedup,
        "op8_ngram_join": ngram_join.op8_ngram_join,
        "op9_ppm_language": ppm.op9_ppm_language,
        "op10_systematic_mix": mixing.op10_systematic_mix,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_cuckoo_dedup": cuckoo.ORACLE_OP7, "op10_systematic_mix": mixing.ORACLE_OP10}
