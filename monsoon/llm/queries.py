"""The registered queries of this subpackage, and the SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monsoon.llm import (
    codes,
    language,
    lines,
    minhash,
    mixing,
    oracle,
    packing,
    quality,
    rules,
    simhash,
    topk,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, Query]:
    return {
        "op1_mixing": mixing.mixing_query,
        "op2_toxicity": toxicity.toxicity_query,
        "op3_line_dedup": lines.lines_query,
        "op4_warc": warc.warc_query,
        "op5_language": language.language_query,
        "op6_quality": quality.quality_query,
        "op7_topk": topk.topk_query,
        "op8_packing": packing.pack_digest,
        "op9_rules": rules.rules_query,
        "op10_simhash": simhash.simhash_query,
        "op11_whitening": whitening.whitening_query,
        "op12_minhash": minhash.minhash_query,
        "op13_codes": codes.codes_query,
    }


def statements() -> dict[str, str]:
    return oracle.statements()
