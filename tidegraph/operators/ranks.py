"""Places of rows in an order, without one task for a key that has very many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.shared import materialise


def placed(rows: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "_at") -> DataFrame:
    """rows with their place among those of the key, from 0.

    Rows are dealt by ranges of key and order and written; each task's first
    row and count of a key are then summed up, a row for each task that a key
    lies in.
    """
    key = list(key)
    dealt = rows.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order).withColumn("_row", F.monotonically_increasing_id())
    dealt = materialise(dealt, "placed").withColumn("_part", F.shiftright("_row", 33))
    each = dealt.groupBy(*key, "_part").agg(F.count("*").alias("_c"), F.min("_row").alias("_first"))
    before = F.sum("_c").over(W.partitionBy(*key).orderBy("_part")) - F.col("_c") - F.col("_first")
    shifts = each.select(*key, "_part", before.alias("_shift"))
    return dealt.join(shifts, [*key, "_part"]).withColumn(name, F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")
