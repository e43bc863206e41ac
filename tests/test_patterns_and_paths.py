import random

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import paths, patterns
from tidegraph.plans.structured import Compare, DateTime, Request, first_variable, literal, run
from tidegraph.sources.star import Graph, Part


@pytest.fixture(scope="module")
def small(spark):
    """a -p-> b -p-> c -p-> a, c -p-> d, and who likes whom."""
    edge = "src string, dst string"
    g = Graph(spark)
    g.edges["p"] = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], edge)
    g.edges["likes"] = spark.createDataFrame([("a", "d"), ("b", "b")], edge)
    g.entities["N"] = spark.createDataFrame([("a", 1, 1.5), ("b", 2, None), ("c", 3, 2.5)], "id string, size int, weight double")
    return g


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def test_match_joins_on_shared_variables(small):
    found = patterns.match(small, [("?x", "p", "?y"), ("?y", "p", "?z")])
    assert rows(found, "x", "y", "z") == [("a", "b", "c"), ("b", "c", "a"), ("b", "c", "d"), ("c", "a", "b")]
    assert rows(patterns.match(small, [("?x", "likes", "?x")])) == [("b",)]
    assert rows(patterns.match(small, [("?x", "p", "?y"), ("?x", "likes", "d")]), "x", "y") == [("a", "b")]


def test_unconnected_patterns_need_a_small_side(small, monkeypatch):
    unconnected = [("?x", "p", "?y"), ("?u", "likes", "?v")]
    assert len(rows(patterns.match(small, unconnected), "x", "y", "u", "v")) == 8
    monkeypatch.setattr(patterns, "PRODUCT", 1)
    with pytest.raises(ValueError):
        patterns.match(small, unconnected)


def test_optional_keeps_rows_and_filters_inside(small):
    left, right = patterns.match(small, [("?x", "p", "?y")]), patterns.match(small, [("?x", "likes", "?z")])
    assert rows(patterns.optional(left, right, ["x"]), "x", "y", "z") == [("a", "b", "d"), ("b", "c", "b"), ("c", "a", None), ("c", "d", None)]
    assert rows(patterns.optional(left, right, ["x"], F.col("z") == "b"), "x", "z") == [("a", None), ("b", "b"), ("c", None), ("c", None)]


def test_minus_and_not_exists_differ_without_shared_variables(small):
    left, other = patterns.match(small, [("?x", "p", "?y")]), patterns.match(small, [("?u", "likes", "?v")])
    assert patterns.minus(left, other).count() == 4
    assert patterns.not_exists(left, other, []).count() == 0
    assert rows(patterns.minus(left, patterns.match(small, [("?x", "likes", "?v")]).select("x")), "x", "y") == [("c", "a"), ("c", "d")]


def test_minus_counts_only_variables_that_both_bind(spark):
    left = spark.createDataFrame([(1, None), (1, 2), (None, None), (3, 4)], "a int, b int")
    right = spark.createDataFrame([(1, 2), (None, 4), (None, None)], "a int, b int")
    # (1, unbound) is compatible with (1, 2) and shares a; (3, 4) with (unbound, 4) by b; without a bound variable nothing goes
    assert rows(patterns.minus(left, right), "a", "b") == [(None, None)]
    assert rows(patterns.minus(left, right.where("a IS NULL")), "a", "b") == [(1, 2), (1, None), (None, None)]
    assert rows(patterns.minus(left, right, always_bound=True), "a", "b") == [(1, None), (3, 4), (None, None)]


def typed_graph(spark, folder):
    spark.createDataFrame([(i, i % 5) for i in range(1000)], "k long, owner int").write.parquet(f"{folder}/things")
    spark.createDataFrame([(i, f"o{i}") for i in range(5)], "k int, name string").write.parquet(f"{folder}/owners")
    things, owners = spark.read.parquet(f"{folder}/things"), spark.read.parquet(f"{folder}/owners")
    g = Graph(spark)
    g.add("OWNED_BY", Part(things, "THING", "k", "OWNER", "owner"), Part(owners.withColumn("boss", F.lit(0)), "OWNER", "k", "OWNER", "boss"))
    g.add("MADE", Part(things, "THING", "k", "THING", "owner"))
    g.tables["OWNER"] = (owners, "k", {"name": "name"})
    g.entities["OWNER"] = owners.select(F.concat(F.lit("OWNER/"), F.col("k").cast("string")).alias("id"), "name")
    return g


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_constants_reach_the_scan_and_types_leave_parts_out(spark, tmp_path):
    g = typed_graph(spark, tmp_path)
    found = patterns.match(g, [("?t", "OWNED_BY", "OWNER/3")])
    assert "EqualTo(owner,3)" in plan_of(found)
    assert len(rows(found, "t")) == 200
    found = patterns.match(g, [("THING/7", "OWNED_BY", "?o")], properties={"o": (["OWNER"], ["name"])})
    assert "EqualTo(k,7)" in plan_of(found) and rows(found, "o", "o_name") == [("OWNER/2", "o2")]
    # ?t is a THING in the second pattern, so owners of owners aren't read, and the join is on numbers
    found = patterns.match(g, [("?t", "OWNED_BY", "?o"), ("?t", "MADE", "?m")])
    assert "owners" not in plan_of(found) and "concat" not in plan_of(found).split("Join")[-1]
    assert found.count() == 1000 and set(found.columns) == {"t", "o", "m"}
    assert rows(patterns.match(g, [("?x", "OWNED_BY", "?x")]), "x") == [("OWNER/0",)]
    for nothing in ([("?t", "OWNED_BY", "OWNER/x")], [("?t", "OWNED_BY", "OTHER/3")], [("?t", "OWNED_BY", "?o"), ("?o", "MADE", "?m")], [("?t", "OWNED_BY", "OWNER/03")]):
        assert patterns.match(g, nothing).count() == 0


def test_compatible_join_with_unbound_variables(spark):
    left = spark.createDataFrame([("1", "a"), ("2", None)], "l string, k string")
    right = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "k string, r string")
    got = patterns.compatible_join(left, right, ["k"])
    assert rows(got, "l", "k", "r") == [("1", "a", "x"), ("1", "a", "z"), ("2", "a", "x"), ("2", "b", "y"), ("2", None, "z")]
    assert "NestedLoop" not in patterns.compatible_join(left.where("k IS NOT NULL"), right.where("k IS NOT NULL"), ["k"]).where("k = 'a'").limit(0)._jdf.queryExecution().optimizedPlan().toString()


def test_union_values_ask_and_pages(small):
    both = patterns.union(patterns.match(small, [("?x", "likes", "?y")]), patterns.match(small, [("?y", "likes", "?z")]))
    assert rows(both, "x", "y", "z") == [("a", "d", None), ("b", "b", None), (None, "a", "d"), (None, "b", "b")]
    assert rows(patterns.values(small, ["x", "n"], [("a", None)])) == [("a", None)]
    assert [patterns.ask(patterns.match(small, [(s, "p", "?y")])).first().answer for s in ("a", "d")] == [True, False]
    assert patterns.page_facts(611, 100, 600) == {"returned": 11, "total": 611, "offset": 600, "limit": 100, "has_more": False}
    assert patterns.page_facts(611, 100, 0)["next_offset"] == 100
    assert [r.id for r in patterns.after(small.entities["N"], "id", "a", 1).collect()] == ["b", "c"]


def test_aggregates_over_nothing_and_over_unbound(small):
    none = small.entities["N"].where("false")
    got = none.agg(F.count("*").alias("n"), patterns.sum_or_error("size").alias("s"), patterns.average_or_error("size").alias("a"), F.min("size").alias("m")).first()
    assert tuple(got) == (0, 0, 0.0, None)
    got = small.entities["N"].agg(patterns.sum_or_error("weight").alias("w"), patterns.sum_or_error("size").alias("s")).first()
    assert tuple(got) == (None, 6)


def test_closure_equals_brute_force(spark):
    dice = random.Random(5)
    for size, count in ((12, 18), (30, 25)):
        pairs = {(dice.randrange(size), dice.randrange(size)) for _ in range(count)}
        want, grown = set(), set(pairs)
        while grown != want:
            want, grown = grown, grown | {(a, d) for a, b in grown for c, d in pairs if b == c}
        edges = spark.createDataFrame(sorted(pairs), "src int, dst int")
        assert {tuple(r) for r in paths.one_or_more(edges).collect()} == want
    assert paths.one_or_more(edges.limit(0)).count() == 0


def test_paths_end_on_cycles(small):
    edges = small.scan("p")
    plus = rows(paths.one_or_more(edges), "src", "dst")
    assert plus == sorted((a, b) for a in "abc" for b in "abcd")
    assert rows(paths.zero_or_more(edges), "src", "dst") == sorted([*plus, ("d", "d")])
    assert rows(paths.zero_or_one(edges), "src", "dst") == sorted([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), *((n, n) for n in "abcd")])
    seeds = small.spark.createDataFrame([("b",), ("d",)], "src string")
    assert rows(paths.reachable(edges, seeds), "seed", "dst") == [("b", n) for n in "abcd"]
    assert ("d", "d") in rows(paths.reachable(edges, seeds, include_seeds=True), "seed", "dst")
    assert rows(paths.sequence(edges, edges), "src", "dst") == [("a", "c"), ("b", "a"), ("b", "d"), ("c", "b")]


def test_deep_chain_needs_few_rounds(spark):
    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(150)], "src string, dst string")
    assert paths.one_or_more(edges).count() == 150 * 151 // 2


def test_literals_of_structured_requests(spark):
    kinds = {c: t for c, t in spark.range(1).select(*(literal(v).alias(f"c{i}") for i, v in enumerate((True, 1, 1.0, 1.5, "2024-01-01", DateTime("2024-01-01T02:00:00+02:00"))))).dtypes}
    assert list(kinds.values()) == ["boolean", "bigint", "bigint", "double", "string", "timestamp_ntz"]
    assert str(spark.range(1).select(literal(DateTime("2024-01-01T02:00:00+02:00"))).first()[0]) == "2024-01-01 00:00:00"
    assert first_variable([("a", "p", "?y"), ("?z", "p", "b")]) == "y"
    assert first_variable([("a", "p", "b")]) == "entity"


def test_structured_request(small):
    request = Request(patterns=[("?x", "p", "?y")], properties={"x": ("N", ["size"])}, where=[Compare("size", "ge", 2), Compare("size", "lt", 3.0)], select=["x", "y"])
    assert rows(run(small, request)) == [("b", "c")]
    request = Request(patterns=[("?x", "p", "?y")], max_solutions=3)
    with pytest.raises(ValueError):
        run(small, request)


def test_an_offset_alone_is_no_single_task(spark):
    rows = spark.range(1_000, numPartitions=4).select((F.col("id") * 7919 % 1_000).alias("v"))
    found = patterns.page(rows, ["v"], offset=10)
    assert [r.v for r in found.collect()] == list(range(10, 1_000))
    assert "GlobalLimit" not in found._jdf.queryExecution().executedPlan().toString()
