"""Property paths.

Fixed steps are joins. Closures have set semantics and end on cycles: with one
end bound the frontier is widened step by step; with both ends free powers of
the relation are joined, so the rounds grow with the logarithm of the depth. Each
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegraph.shared import materialise, settled


def inverse(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def sequence(first: DataFrame, second: DataFrame) -> DataFrame:
    """first / second, duplicates kept."""
    one = first.select("src", F.col("dst").alias("_via"))
    return one.join(second.select(F.col("src").alias("_via"), "dst"), "_via").select("src", "dst")


def alternative(*parts: DataFrame) -> DataFrame:
    out = parts[0].select("src", "dst")
    for part in parts[1:]:
        out = out.unionByName(part.select("src", "dst"))
    return out


def negated(edges: DataFrame, relations: list[str]) -> DataFrame:
    """!(a|b) over edges with a relation column."""
    return edges.where(~F.col("relation").isin(relations)).select("src", "dst")


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("n")).distinct()


def zero_length(edges: DataFrame) -> DataFrame:
    return nodes(edges).select(F.col("n").alias("src"), F.col("n").alias("dst"))


def zero_or_one(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").unionByName(zero_length(edges)).distinct()


def one_or_more(edges: DataFrame) -> DataFrame:
    """All pairs that a path of at least one edge connects.

    In round i, power has the pairs that 2^i edges connect and reach those of
    fewer; joining the two gives the pairs of up to 2^(i+1) - 1 edges, and only
    those that reach lacks are written. So a pair of a tree is made once, and
    rounds grow with the logarithm of the depth. Pairs at a longest distance
    have others at each shorter one, so a round without new pairs is the last.
    """

    def build() -> DataFrame:
        power = materialise(edges.select("src", "dst").distinct(), "closure")
        reach = [power]
        while True:
            power = materialise(sequence(power, power).distinct(), "power")
            known = reduce(lambda a, b: a.unionByName(b), reach)
            new = materialise(power.unionByName(sequence(power, known)).distinct().join(known, ["src", "dst"], "left_anti"), "closure")
            if new.isEmpty():
                return known
            reach.append(new)

    return settled(edges.sparkSession, "closure", build)


def zero_or_more(edges: DataFrame) -> DataFrame:
    return one_or_more(edges).unionByName(zero_length(edges)).distinct()


#: Rounds whose pairs are read as separate files before they are written as one.
KEPT_APART = 16


def reachable(edges: DataFrame, seeds: DataFrame, *, include_seeds: bool = False) -> DataFrame:
    """(seed, dst) for nodes that a path leads to from each seed (a column src).

    Each round writes only what it finds; what was found before is read.
    """
    step = edges.select(F.col("src").alias("_at"), F.col("dst").alias("_to")).distinct()
    start = seeds.select(F.col("src").alias("seed")).distinct()
    frontier = materialise(start.join(step, F.col("seed") == F.col("_at")).select("seed", F.col("_to").alias("dst")).distinct(), "frontier")
    found = [frontier]
    while not frontier.isEmpty():
        seen = reduce(lambda a, b: a.unionByName(b), found)
        if len(found) > KEPT_APART:
            seen = materialise(seen, "reach")
            found = [seen]
        new = frontier.join(step, F.col("dst") == F.col("_at")).select("seed", F.col("_to").alias("dst")).distinct()
        frontier = materialise(new.join(seen, ["seed", "dst"], "left_anti"), "frontier")
        found.append(frontier)
    seen = reduce(lambda a, b: a.unionByName(b), found)
    return seen.unionByName(start.select("seed", F.col("seed").alias("dst"))).distinct() if include_seeds else seen
