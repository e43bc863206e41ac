import random

import pytest

from tidegraph.operators import ontology, reasoning
from tidegraph.operators.ontology import Ontology, Relation
from tidegraph.plans.structured import Request, run
from tidegraph.sources.star import Graph

EDGES = "src string, relation string, dst string"


def brute(facts, rules, transitive=()):
    depth, known = 0, {f: 0 for f in facts}
    while True:
        depth += 1
        found = set()
        for s, r, d in known:
            for on, kind, to, put, turned in rules:
                if r == on and kind in (None, d):
                    a, b = (d, s) if turned else (s, d)
                    found.add((a, to, put or b))
            if r in transitive:
                found |= {(s, r, z) for y, q, z in known if q == r and y == d}
        fresh = found - set(known)
        if not fresh:
            return known
        known |= {f: depth for f in fresh}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_what_follows_equals_a_naive_fixpoint(spark, seed):
    dice = random.Random(seed)
    names, kinds = ["p", "q", "r", "s"], ["A", "B", "C"]
    facts = {(f"n{dice.randrange(6)}", dice.choice(names), f"n{dice.randrange(6)}") for _ in range(9)}
    rules = [reasoning.subproperty(dice.choice(names), dice.choice(names)) for _ in range(3)] + reasoning.inverse("p", "s")
    rules += [reasoning.subclass(dice.choice(kinds), dice.choice(kinds)) for _ in range(3)] + [reasoning.domain("q", "A"), reasoning.range_("r", "B")]
    got = reasoning.infer(spark.createDataFrame(sorted(facts) * 2, EDGES), rules, transitive=["q"]).collect()
    assert len(got) == len({r[:3] for r in got}) and {tuple(r[:3]): r.depth for r in got} == brute(facts, rules, ["q"])


def test_cycles_end_and_nothing_follows_from_nothing(spark):
    empty = spark.createDataFrame([], EDGES)
    assert reasoning.infer(empty, [reasoning.subproperty("p", "q")]).count() == 0
    one = spark.createDataFrame([("a", "p", "b"), ("b", "p", "a"), (None, "p", "c")], EDGES)
    assert reasoning.infer(one, []).count() == 3
    looped = reasoning.infer(one, [reasoning.subproperty("p", "q"), reasoning.subproperty("q", "p")], transitive=["p"]).collect()
    assert sum(r.relation == "p" for r in looped) == sum(r.relation == "q" for r in looped) == 5
    with pytest.raises(ValueError):
        reasoning.infer(one, [reasoning.subproperty("p", str(i)) for i in range(reasoning.MOST_RULES + 1)])


def test_an_ontologys_rules_reach_patterns(spark):
    g = Graph(spark)
    g.edges = {"SON": spark.createDataFrame([("P/1", "P/2"), ("P/3", "P/2")], "src string, dst string"), "OTHER": spark.createDataFrame([("P/1", "Q/1")], "src string, dst string")}
    g.entities = {"P": spark.createDataFrame([("P/1",), ("P/2",), ("P/9",)], "id string")}
    rules = Ontology(types={"P": "AGENT", "AGENT": None}, relations={"OTHER": Relation(frozenset("P"), frozenset("Q")), "SON": Relation(frozenset("PX"), frozenset("P"))}, subproperties={"SON": ("CHILD",), "CHILD": ("KIN",)}, inverses={"CHILD": "PARENT_OF"})
    ask = lambda *patterns: sorted(map(tuple, run(g, Request(patterns=list(patterns), reason=rules)).distinct().collect()))
    assert ask(("?x", "KIN", "?y")) == [("P/1", "P/2"), ("P/3", "P/2")]
    assert ask(("?y", "PARENT_OF", "?x")) == [("P/2", "P/1"), ("P/2", "P/3")]
    assert ask(("?x", "OTHER", "?y")) == [("P/1", "Q/1")]
    # types are those of the entities, and what one domain or range says; of two domains none follows
    assert ask(("?x", "a", "AGENT")) == [("P/1",), ("P/2",), ("P/9",)]
    assert ask(("?x", "a", "Q")) == [("Q/1",)]


def test_definitions_keep_limits_and_rules():
    base = Ontology(relations={"r": Relation(frozenset("A"), frozenset("B"), 1)}, subproperties={"r": ("s",)})
    wider, changed = ontology.evolve(base, Ontology(relations={"r": Relation(frozenset("A"), frozenset("C"))}))
    assert changed and wider.relations["r"] == Relation(frozenset("A"), frozenset("BC"), 1)
    more, changed = ontology.evolve(base, Ontology(subproperties={"r": ("s", "t")}, inverses={"r": "q"}))
    assert changed and more.subproperties == {"r": ("s", "t")} and more.inverses == {"r": "q"} and ontology.define(more, base) == (more, False)
