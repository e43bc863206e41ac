"""What edges entail: subclasses, subproperties, domains, ranges, inverses and transitive relations, to a fixpoint.

Rounds are semi-naive: only the edges that the last round found are held
against the rules, and of what follows only edges that no round had are kept,
so each edge is derived once, with the least number of steps, and cycles in the
hierarchy end. Rules with one premise are rows of one small table; the rules
come from the driver, so their number is known before they are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegraph.operators.ontology import Ontology
from tidegraph.shared import materialise
from tidegraph.sources.star import Graph

#: The relation from an entity to its class.
IS_A = "a"
#: Rules at most, since they are broadcast.
MOST_RULES = 10_000

Rule = tuple[str, str | None, str, str | None, bool]
_RULES = "on_relation string, on_dst string, to_relation string, to_dst string, turned boolean"


def subproperty(narrow: str, wide: str) -> Rule:
    return (narrow, None, wide, None, False)


def inverse(relation: str, other: str) -> list[Rule]:
    return [(relation, None, other, None, True), (other, None, relation, None, True)]


def subclass(narrow: str, wide: str) -> Rule:
    return (IS_A, narrow, IS_A, wide, False)


def domain(relation: str, kind: str) -> Rule:
    return (relation, None, IS_A, kind, False)


def range_(relation: str, kind: str) -> Rule:
    return (relation, None, IS_A, kind, True)


def rules_of(ontology: Ontology) -> list[Rule]:
    """An ontology's subclasses, subproperties and inverses, and the domains and ranges of relations that have one of each."""
    found = [subclass(name, parent) for name, parent in ontology.types.items() if parent is not None]
    found += [subproperty(name, wide) for name, wides in ontology.subproperties.items() for wide in wides]
    found += [rule for name, other in ontology.inverses.items() for rule in inverse(name, other)]
    for name, relation in ontology.relations.items():
        # of several domains, one would do for an edge, so none follows
        found += [domain(name, kind) for kind in relation.domains] if len(relation.domains) == 1 else []
        found += [range_(name, kind) for kind in relation.ranges] if len(relation.ranges) == 1 else []
    return found


def infer(edges: DataFrame, rules: Iterable[Rule], *, transitive: Sequence[str] = ()) -> DataFrame:
    """(src, relation, dst, depth): edges (src, relation, dst), depth 0, and all that follows from them, each once with the least number of rounds.

    Null ends follow rules like others; repeated edges are one.
    """
    spark, rows = edges.sparkSession, sorted(set(rules), key=str)
    if len(rows) > MOST_RULES:
        raise ValueError(f"{len(rows)} rules are more than {MOST_RULES}")
    table = F.broadcast(spark.createDataFrame(rows, _RULES))
    new = materialise(edges.select("src", "relation", "dst").distinct().withColumn("depth", F.lit(0)), "facts")
    known = [new]
    while not new.isEmpty():
        depth = len(known)
        met = new.join(table, (F.col("relation") == F.col("on_relation")) & (F.col("on_dst").isNull() | (F.col("dst") == F.col("on_dst"))))
        turned = lambda one, other: F.when(F.col("turned"), F.col(one)).otherwise(F.col(other))
        found = met.select(turned("dst", "src").alias("src"), F.col("to_relation").alias("relation"), F.coalesce("to_dst", turned("src", "dst")).alias("dst"))
        every = reduce(lambda a, b: a.unionByName(b), known)
        if transitive:
            chained = lambda d: d.where(F.col("relation").isin(list(transitive))).select("src", "relation", "dst")
            old = every.where(F.col("depth") < depth - 1)
            for first, second in ((chained(new), chained(every)), (chained(old), chained(new))):
                pairs = first.withColumnRenamed("dst", "_via").join(second.withColumnRenamed("src", "_via"), ["relation", "_via"])
                found = found.unionByName(pairs.select("src", "relation", "dst"))
        same = [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("src", "relation", "dst")]
        fresh = found.distinct().alias("f").join(every.alias("k"), reduce(lambda a, b: a & b, same), "left_anti")
        new = materialise(fresh.withColumn("depth", F.lit(depth)), "facts")
        known.append(new)
    return reduce(lambda a, b: a.unionByName(b), known)


def classes(graph: Graph, kinds: Iterable[str]) -> DataFrame:
    """Edges from entities of these types to their type."""
    frames = [graph.entities[k].select(F.col("id").alias("src"), F.lit(IS_A).alias("relation"), F.lit(k).alias("dst")) for k in kinds]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _needed(wanted: Iterable[str], rules: list[Rule]) -> set[str]:
    """The relations from which rules lead to the wanted ones."""
    need, before = set(wanted), set()
    while need != before:
        before = set(need)
        need |= {r[0] for r in rules if r[2] in need}
    return need


def reasoned(graph: Graph, ontology: Ontology, wanted: Iterable[str]) -> Graph:
    """The graph with what follows for the wanted relations; only the relations that lead there are read, and those to which no rule leads stay as they are."""
    rules = rules_of(ontology)
    derived = {r for r in wanted if any(rule[2] == r for rule in rules)}
    if not derived:
        return graph
    need = _needed(derived, rules)
    own = [graph.edges[r].select("src", F.lit(r).alias("relation"), "dst") for r in sorted(need & set(graph.edges))]
    if IS_A in need:
        own.append(classes(graph, sorted(graph.entities)))
    facts = infer(reduce(lambda a, b: a.unionByName(b), own), [r for r in rules if r[2] in need])
    out = Graph(graph.spark, dict(graph.edges), dict(graph.entities), {k: v for k, v in graph.parts.items() if k not in derived}, dict(graph.tables))
    for relation in derived:
        out.edges[relation] = facts.where(F.col("relation") == relation).select("src", "dst")
    return out
