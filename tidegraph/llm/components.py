"""Connected components by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegraph.llm.common import materialise, settled


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (vertex, root), root being the least vertex of the component.

    Only vertices with a link come back, the roots among them included. Each
    round rewires every vertex's larger neighbours, then its smaller ones, to
    the least it knows, which halves the depth; rounds end when the set of
    edges stays. Only a count and a checksum of the edges reach the driver,
    and only the result stays in the shared folder.
    """

    def build() -> DataFrame:
        now = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        seen, before = _signature(now), None
        while seen[0] and seen != before:
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            least = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(least, "a")
            small = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
            now = materialise(small.distinct(), "edges")
            seen, before = _signature(now), seen
        found = now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        return found.unionByName(now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())

    return settled(edges.sparkSession, "components", build)
