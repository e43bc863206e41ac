"""The corpus pipeline: toxic documents go, then copies, then near copies; the rest is mixed and packed.

Stages take (spark, docs, sf_dir) and give a DataFrame, which run() writes as
Parquet in the shared folder and reads again for the next stage. In every stage
a null text counts as empty, whole texts count, however long, an empty table
gives an empty one, and other columns of docs, whatever their names, come
through the first four stages as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegraph.llm import exact_dedup, mixing, packing, similar, toxicity
from tidegraph.llm.common import materialise, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that score 0.3 or more go.

    Texts without words all have one score and go or stay together, and so do
    repeated rows. Rows with a null id are scored but never learnt from.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of equal texts the largest doc_id stays.

    A null id is below all others; of rows that repeat the largest id and the
    text, one stays. Null and empty texts are equal.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of texts that share 0.8 of their five-word shingles, over any chain, that with the least doc_id stays.

    Null ids are last. Texts without words are alike; shorter ones than five
    words are one shingle. Rows that repeat id and text stay or go together.
    """
    return similar.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as its source's target wants.

    Null sources are one source, the last. Rows that repeat id and text share
    a rank. Documents without words count nothing and come as their rank says.
    """
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the pieces of all documents in sequences of 4096 tokens.

    A text without words is one piece, the end id. Null ids stay null;
    repeated rows, which mixing makes, are packed each.
    """
    # workers of the stages before are still there, so they remember less than in packing alone
    return packing.pack(docs, remembered=150_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither a trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
