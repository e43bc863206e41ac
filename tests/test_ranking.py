import math
import random

import pytest

from tidegraph.operators import ranking, signals
from tidegraph.operators.ranking import Comparison


def made(spark, n=60, seed=1):
    dice = random.Random(seed)
    rows = [(i, [round(dice.gauss(0, 1), 1) for _ in range(6)], dice.randrange(3) if i else 9) for i in range(n)] + [(n, [0.0] * 6, 0), (n + 1, [0.0] * 6, 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, dims, most):
    found = {}
    for q, x, own in rows:
        near = sorted((-round(sum(a * b for a, b in zip(x[:dims], y[:dims], strict=True)), 6), v) for v, y, _ in rows if v != q)[:most]
        labels = {v: label for v, _, label in rows}
        right = [labels[v] == own for _, v in near]
        room = min(sum(label == own for _, _, label in rows) - 1, most)
        ideal = sum(1 / math.log2(i + 1) for i in range(1, room + 1))
        dcg = sum(1 / math.log2(i + 1) for i, r in enumerate(right, 1) if r)
        found[q] = ([v for _, v in near], sum(right), round(sum(right) / room, 6) if room else 0.0, round(dcg / ideal, 6) if room else 0.0)
    return found


@pytest.mark.parametrize("block, part", [(1_024, 50_000), (7, 11)])
def test_measures_equal_brute_force(spark, block, part):
    rows, vectors = made(spark)
    for dims, most in ((6, 10), (2, 3)):
        want = brute(rows, dims, most)
        ranked = ranking.nearest(vectors, vectors, dims, most, block=block, part=part)
        got = {}
        for r in ranked.collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
        assert {q: [own[k] for k in sorted(own)] for q, own in got.items()} == {q: w[0] for q, w in want.items()}
        told = ranking.metrics(ranked, vectors.select("vec_id", "label"), most).collect()
        assert {r.query_id: (r.hits, r.recall, r.ndcg) for r in told} == {q: w[1:] for q, w in want.items()}


def test_no_queries_and_few_vectors(spark):
    _, vectors = made(spark, 3)
    assert ranking.nearest(vectors, vectors.limit(0), 6).count() == 0
    assert ranking.nearest(vectors.where("vec_id = 1"), vectors, 6).count() == 4


def test_a_bootstrap_tells_better_from_chance(spark):
    dice = random.Random(5)
    one = [(i, dice.random()) for i in range(200)]
    frame = lambda rows: spark.createDataFrame(rows, "query_id long, ndcg double")
    better = ranking.bootstrap(frame(one), frame([(i, x + 0.1 + dice.gauss(0, 0.2)) for i, x in one])).first()
    assert better.queries == 200 and 0 < better.low < better.difference < better.high < 0.2
    chance = ranking.bootstrap(frame(one), frame([(i, x + dice.gauss(0, 0.5)) for i, x in one])).first()
    assert chance.low < 0 < chance.high
    none = ranking.bootstrap(frame([]), frame([])).first()
    assert (none.queries, none.low) == (0, None)
    # resamples draw each query once on average
    total = spark.range(2000).select(ranking._times(ranking.F.col("id"), ranking.F.lit(3)).alias("t")).agg({"t": "sum"}).first()[0]
    assert 1800 < total < 2200


def test_promotion_wants_a_better_interval(spark):
    runs = spark.createDataFrame([("k", 1, "m1")], "kind string, run int, manifest string")
    none = spark.createDataFrame([], "kind string, run int, at long")
    for wrong in ([], [Comparison(9, 0.1, -0.1, 0.2)], [Comparison(9, 0.2, 0.1, 0.3), Comparison(0, None, None, None)]):
        with pytest.raises(ValueError):
            signals.promote(runs, none, "k", 1, 10, expected=None, comparisons=wrong)
    assert signals.promote(runs, none, "k", 1, 10, expected=None, comparisons=[Comparison(9, 0.2, 0.1, 0.3)]).count() == 1
    _, vectors = made(spark)
    assert not ranking.compare(vectors, vectors, 6, 2).better


def test_groups_grow_before_there_are_many(spark):
    assert [ranking._groups(n, 200) for n in (0, 1, 200, 201, 2_000, 120_000, 1_000_000)] == [1, 1, 1, 2, 8, 8, 62]
    assert ranking._groups(40_000, 50_000) == 1
