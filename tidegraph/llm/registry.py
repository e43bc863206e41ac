"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegraph.llm import alignment, audio, chat, completion, exact_dedup, merkle, mixing, packing, quality, simhash, tokens, toxicity, warc


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_chat_format": chat.op2_chat_format,
        "op3_mixing": mixing.op3_mixing,
        "op4_warc": warc.op4_warc,
        "op5_packing": packing.op5_packing,
        "op6_simhash": simhash.op6_simhash,
        "op7_chroma": audio.op7_chroma,
        "op8_token_counts": tokens.op8_token_counts,
        "op9_quality": quality.op9_quality,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_completion": completion.op11_completion,
        "op12_merkle": merkle.op12_merkle,
        "op13_alignment": alignment.op13_alignment,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.OP1_SQL,
        "op2_chat_format": chat.OP2_SQL,
        "op3_mixing": mixing.OP3_SQL,
        "op4_warc": warc.OP4_SQL,
        "op12_merkle": merkle.OP12_SQL,
    }
