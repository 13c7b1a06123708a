"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirework.llm import ann, bpe, jaccard, lm, packing, pii, quality, substring, topk, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ann": ann.op1,
        "op2_substring": substring.op2,
        "op3_packing": packing.op3,
        "op4_pii": pii.op4,
        "op5_lm": lm.op5,
        "op6_quality": quality.op6,
        "op7_warc": warc.op7,
        "op8_jaccard": jaccard.op8,
        "op9_topk": topk.op9,
        "op10_bpe": bpe.op10,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring": substring.OP2_SQL,
        "op5_lm": lm.OP5_SQL,
        "op7_warc": warc.OP7_SQL,
        "op8_jaccard": jaccard.OP8_SQL,
        "op9_topk": topk.OP9_SQL,
    }
