import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import intervals, temporal, timeline
from tidegraph.operators.ranks import placed

LOG = "edge_id string, commit_seq long, event_ord int, op string, valid_from timestamp_ntz, valid_to timestamp_ntz, price int"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def made(seed, edges, events, span=40):
    dice = random.Random(seed)
    rows = []
    for k in range(events):
        a = dice.randrange(span)
        to = dice.choice([None, None, a, a + 1, a + dice.randrange(1, span)])
        rows.append((dice.choice(edges), dice.randrange(30), k, dice.choice(["assert", "assert", "retract"]), day(a), None if to is None else day(to), k))
    return rows


def deciding(rows, edge, at):
    there = [r for r in rows if r[0] == edge and r[4] <= at and (r[5] is None or r[5] > at)]
    return max(there, key=lambda r: (r[1], r[2])) if there else None


def brute(rows):
    """(edge, from, to, price) of pieces, day by day."""
    found = []
    for edge in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == edge and (r[5] is None or r[4] < r[5])]
        points = sorted({r[4] for r in own} | {r[5] for r in own if r[5]})
        before = None
        for p, q in zip(points, [*points[1:], None], strict=True):
            top = deciding(own, edge, p)
            if top and top[3] == "assert":
                if before == top:
                    found[-1] = (*found[-1][:2], q, top[6])
                else:
                    found.append((edge, p, q, top[6]))
            before = top
    return sorted(found, key=str)


@pytest.mark.parametrize("most, edges", [(128, "abc"), (4, "abc"), (5, "aaaaaaab"), (1, "a")])
def test_pieces_equal_a_walk_over_the_days(spark, most, edges):
    rows = made(most, edges, 70)
    got = timeline.timeline(spark.createDataFrame(rows, LOG), most=most).collect()
    assert sorted(((r.edge_id, r.holds_from, r.holds_to, r.price) for r in got), key=str) == brute(rows)


def test_events_of_one_interval_do_not_fill_a_stretch(spark):
    rows = [("a", i, 0, "assert", day(1), day(5), i) for i in range(50)] + [("a", 60, i, "assert", day(i % 3), day(9), 100 + i) for i in range(30)]
    got = timeline.timeline(spark.createDataFrame(rows, LOG), most=4).collect()
    assert sorted(((r.edge_id, r.holds_from, r.holds_to, r.price) for r in got), key=str) == brute(rows)


def test_a_back_dated_assertion_leaves_later_times_alone(spark):
    log = spark.createDataFrame([("e", 1, 0, "assert", dt.datetime(2020, 1, 1), None, 1), ("e", 2, 0, "assert", dt.datetime(2018, 1, 1), dt.datetime(2019, 1, 1), 2), ("e", 3, 0, "retract", dt.datetime(2022, 1, 1), None, 1)], LOG)
    at = lambda t, **o: [r.price for r in temporal.state(log, valid_time=t, **o).collect()]
    assert [at(f"{y}-06-01") for y in (2017, 2018, 2019, 2021, 2023)] == [[], [2], [], [1], []]
    assert at("2023-06-01", commit_seq=2) == [1] and at("2018-06-01", commit_seq=1) == []
    pieces = [(r.holds_from.year, r.holds_to.year if r.holds_to else None) for r in timeline.timeline(log).orderBy("holds_from").collect()]
    assert pieces == [(2018, 2019), (2020, 2022)]
    assert [r.holds_to for r in timeline.timeline(log, commit_seq=2).orderBy("holds_from").collect()] == [dt.datetime(2019, 1, 1), None]


def test_the_state_is_the_piece_at_that_time(spark):
    rows = made(9, "abcd", 60)
    log = spark.createDataFrame(rows, LOG)
    pieces = timeline.timeline(log, most=6)
    for n in (0, 7, 20, 39, 90):
        there = pieces.where((F.col("holds_from") <= F.lit(day(n)).cast("timestamp_ntz")) & (F.col("holds_to").isNull() | (F.col("holds_to") > F.lit(day(n)).cast("timestamp_ntz"))))
        assert sorted((r.edge_id, r.price) for r in there.collect()) == sorted((r.edge_id, r.price) for r in temporal.state(log, valid_time=str(day(n))).collect())


def test_questions_find_what_decides_at_their_time(spark):
    rows = made(4, "aaab", 50)
    questions = [(e, day(n), n % 5) for e in "abz" for n in range(-2, 60, 3)] + [("a", day(3), 1), ("a", None, 2)]
    got = timeline.asked(spark.createDataFrame(rows, LOG), spark.createDataFrame(questions, "edge_id string, at timestamp_ntz, n int"), "at").collect()
    want = [(e, t, n, deciding(rows, e, t)) for e, t, n in questions if t]
    assert sorted((r.edge_id, r.at, r.n, r.decided.price) for r in got) == sorted((e, t, n, top[6]) for e, t, n, top in want if top)
    spoken = {(r.edge_id, r.at): r.spoken for r in got}
    assert all(n == sum(r[0] == e and r[4] <= t and (r[5] is None or r[5] > t) for r in rows) for (e, t), n in spoken.items())


def test_pieces_of_an_empty_log(spark):
    assert timeline.timeline(spark.createDataFrame([], LOG)).count() == 0
    assert timeline.timeline(spark.createDataFrame([("e", 1, 0, "assert", day(2), day(2), 1), ("e", 1, 0, "assert", None, day(2), 1)], LOG)).count() == 0


# ------------------------------------------------------------------ nodes


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_covers_are_exact_and_small(spark, levels):
    cells = 1 << (intervals.TOP_BITS + intervals.CHILD_BITS * (levels - 1))
    dice = random.Random(levels)
    some = [(0, cells - 1), (0, 0), (cells - 1, cells - 1), (7, 8), (8, 15), (1, cells - 2)] + [tuple(sorted((dice.randrange(cells), dice.randrange(cells)))) for _ in range(60)]
    rows = spark.createDataFrame(some, "a long, b long").select("a", "b", intervals.cover(F.col("a"), F.col("b"), levels).alias("n")).collect()
    for r in rows:
        held = sorted(c for node in r.n for c in range((node >> 4) << 3 * (node & 15), ((node >> 4) + 1) << 3 * (node & 15)))
        assert held == list(range(r.a, r.b + 1)) and len(r.n) <= 14 * (levels - 1) + 64
    one = spark.range(1).select(intervals.above(F.lit(cells - 1), levels).alias("n")).first().n
    assert [(n >> 4) << 3 * (n & 15) <= cells - 1 < ((n >> 4) + 1) << 3 * (n & 15) for n in one] == [True] * levels


def test_open_ends_and_a_range_over_everything(spark):
    dice = random.Random(11)
    rows = [(i, "hot" if i % 4 else f"k{i % 8}", day(dice.uniform(0, 300)), dice.choice([None, None, 1 / 24, 3, 200])) for i in range(240)]
    made_ = [(i, k, a, None if n is None else a + dt.timedelta(days=n)) for i, k, a, n in rows] + [(1000, "hot", day(-900), day(9000)), (1001, "hot", day(2), day(2)), (1002, None, day(1), None), (1003, "hot", None, None)]
    frame = spark.createDataFrame(made_, "id int, k string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    one, other = frame.where("id % 2 = 0"), frame.where("id % 2 = 1 OR id = 1000")
    end = lambda x: x[3] or dt.datetime.max
    sides = [[x for x in made_ if x[1] and x[2] and x[2] < end(x) and keep(x[0])] for keep in (lambda i: i % 2 == 0, lambda i: i % 2 == 1 or i == 1000)]
    want = {(x[0], y[0]) for x in sides[0] for y in sides[1] if x[1] == y[1] and x[2] < end(y) and y[2] < end(x)}
    got = [(r.id, r.r_id) for r in intervals.interval_join(one, other, ["k"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_ranges_of_any_length_and_odd_numbers(spark):
    dice = random.Random(2)
    inf, nan = float("inf"), float("nan")
    values = spark.createDataFrame([(i, v) for i, v in enumerate([dice.gauss(0, 100) for _ in range(150)] + [inf, -inf, nan, None, 0.0])], "i int, v double")
    bands = spark.createDataFrame([(j, a, a + w) for j, (a, w) in enumerate([(dice.gauss(0, 100), dice.choice([0, 1e-9, 5, 1e12])) for _ in range(60)] + [(-inf, inf), (-1e12, 2e12), (5.0, -1.0), (0.0, 0.0)])], "j int, low double, high double")
    brute_ = values.crossJoin(bands).where("v BETWEEN low AND high AND low <= high").select("i", "j")
    got = intervals.range_join(values, bands, "v", "low", "high").select("i", "j")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, brute_.collect())) != []
    keyed = intervals.range_join(values.withColumn("k", F.col("i") % 2), bands.withColumn("k", F.col("j") % 2), "v", "low", "high", on=["k"])
    assert sorted((r.i, r.j) for r in keyed.collect()) == sorted((r.i, r.j) for r in brute_.where("i % 2 = j % 2").collect())


def test_rows_grow_by_a_logarithm(spark):
    n = 20_000
    spans = intervals.Domain(0.0, float(n), 4)
    some = spark.range(n).select(spans.cell(F.col("id").cast("double")).alias("c"), F.rand(1).alias("w"))
    most = some.select(F.size(intervals.cover(F.col("c"), F.lit(spans.cells - 1).cast("long"), 4)).alias("n")).agg(F.max("n"), F.avg("n")).first()
    assert most[0] <= 7 * 3 + 64 and most[1] < 60


def test_places_of_a_hot_key(spark):
    rows = [("hot", i * 7 % 1009, i) for i in range(1009)] + [("cold", 1, 0), ("cold", 0, 1)]
    got = placed(spark.createDataFrame(rows, "k string, v int, n int").repartition(5), ["k"], ["v"]).collect()
    assert {(r.k, r.v): r._at for r in got} == {**{("hot", v): v for v in range(1009)}, ("cold", 0): 0, ("cold", 1): 1}


def test_rows_on_nodes_are_never_broadcast(spark):
    values, bands = spark.range(100).select(F.col("id").cast("double").alias("v")), spark.range(100).select(F.col("id").alias("low"), (F.col("id") + 1).alias("high"))
    found = intervals.range_join(values, bands, "v", "low", "high")
    assert found.count() == 199
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_many_small_keys_need_one_cell_and_a_large_one_many(spark):
    rows = spark.range(10_000).select((F.col("id") % 1_000).alias("k"), F.col("id").alias("at"))
    assert intervals.domain((rows, "at"), on=["k"]) == intervals.Domain(0.0, 9_999.0, 1, 0)
    hot = rows.withColumn("k", F.when(F.col("at") % 2 == 0, F.lit(7)).when(F.col("at") % 3 > 0, F.col("k")))
    assert intervals.domain((hot, "at"), on=["k"]).cells == 512
    nulls = rows.withColumn("k", F.lit(None).cast("long"))
    assert intervals.domain((nulls, "at"), on=["k"]) == intervals.Domain(0.0, 1.0, 1)


def test_ranges_meet_runs_of_points_and_not_each_point(spark):
    values = spark.range(4_000).select(F.concat(F.lit("ORDER/"), F.col("id") * 37 % 100_003).alias("o"), (F.col("id") * 7919 % 4_001 / 8).alias("v"))
    bands = spark.range(1_000).select(F.concat(F.lit("PART/"), F.col("id") * 41 % 100_003).alias("b"), (F.col("id") / 4).alias("low"), (F.col("id") / 4 + 200.3).alias("high"))
    found = intervals.range_join(values, bands, "v", "low", "high").select("o", "b")
    want = values.join(bands, F.col("v").between(F.col("low"), F.col("high"))).select("o", "b")
    told = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("o", "b").cast("decimal(38,0)"))).first())
    assert told(found) == told(want) and told(want)[0] > 1_500_000
    # a plan is told from its end, so pairs are unpacked after the join
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert -1 < plan.find("Generate inline(_points") < plan.find("SortMergeJoin")


def test_runs_keep_points_with_null_columns_and_keys_apart(spark):
    dice = random.Random(3)
    points = [(i, dice.choice(["a", "b", None]), dice.choice([None, "x"]), None if i % 50 == 0 else dice.randrange(40)) for i in range(900)]
    ranges = [(i, dice.choice(["a", "b", None]), low, low + dice.randrange(-1, 9)) for i in range(60) for low in (dice.randrange(40),)]
    p, r = spark.createDataFrame(points, "i int, k string, more string, v int"), spark.createDataFrame(ranges, "j int, k string, low int, high int")
    got = sorted((x.i, x.more or "", x.j) for x in intervals.range_join(p, r, "v", "low", "high", on=["k"]).collect())
    assert got == sorted((i, m or "", j) for i, k, m, v in points for j, k2, low, high in ranges if k is not None and k == k2 and v is not None and low <= v <= high)
